"""The ledger of downloads: cache key and time, as table or as a JSON map.

Downloads append small files.  ``compact_ledger`` puts what they hold into a version of the table (``versions``), in buckets
by key, with the latest entry of each key and without expired ones, and removes the files it has read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.schema import LEDGER_SCHEMA
from tidegate.sources import versions
from tidegate.sources.storage import children, path_exists, remove

BUCKETS = 16
_PART = "part"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger table, empty while none has been written; the latest entry of a key counts."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    version = versions.latest(spark, path)
    if version is not None:
        rows = rows.unionByName(versions.read_parts(spark, path, version.parts, LEDGER_SCHEMA))
    return latest_entries(rows)


def compact_ledger(spark: SparkSession, path: str, now: float, ttl: float, buckets: int = BUCKETS) -> int:
    """Rewrite the ledger without what has expired or been replaced; the number of entries that stay.

    The new content is seen at once, by one rename.  Entries appended meanwhile stay in files of their own and are met by
    the next call.  A call that fails leaves entries twice at worst, of which the latest counts; a repeat tidies up.
    """
    while True:
        appended = [f"{path}/{n}" for n in children(spark, path) if n.endswith(".parquet")]
        version = versions.latest(spark, path) or versions.Version(0, buckets, ("cache_key",), ("cache_key",))
        rows = versions.read_parts(spark, path, version.parts, LEDGER_SCHEMA)
        if appended:
            rows = rows.unionByName(spark.read.schema(LEDGER_SCHEMA).parquet(*appended))
        load = f"compact-{uuid.uuid4().hex}-v{version.number + 1}"
        bucket = F.pmod(F.xxhash64("cache_key"), F.lit(version.buckets)).cast("int")
        fresh = fresh_entries(latest_entries(rows), now, ttl).withColumns({_PART: F.lit("all"), versions.BUCKET: bucket})
        place = f"{path}/{versions.load_folder(load)}"
        fresh.repartition(version.buckets, versions.BUCKET).write.partitionBy(_PART, versions.BUCKET).parquet(place)
        parts = versions.written_parts(spark, path, load, _PART)
        if versions.commit(spark, path, version.changed(version.parts, parts, "compact", load)):
            for file in appended:
                remove(spark, file)
            versions.sweep(spark, path)
            return versions.read_parts(spark, path, parts, LEDGER_SCHEMA).count()


def read_ledger_json(spark: SparkSession, path: str) -> DataFrame:
    """Ledger kept as one JSON object; a document that is no JSON counts as empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,double>"))).toDF(*LEDGER_SCHEMA.names)


def append_ledger(entries: DataFrame, path: str) -> None:
    entries.select(*LEDGER_SCHEMA.names).write.mode("append").parquet(path)


def latest_entries(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("cache_key").agg(F.max("ts").alias("ts"))


def is_fresh(ts: Column, now: Column, ttl: Column) -> Column:
    """Age up to and including ``ttl`` seconds."""
    return now - ts <= ttl


def fresh_entries(ledger: DataFrame, now: float | Column, ttl: float) -> DataFrame:
    """Entries that have not expired; the rest is what a purge removes."""
    now = F.lit(float(now)) if isinstance(now, (int, float)) else now
    return ledger.where(is_fresh(F.col("ts"), now, F.lit(float(ttl))))
