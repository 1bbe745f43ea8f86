"""The keyed table on storage, and the other sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tidegate.operators.duplicates import validate_unique_key
from tidegate.operators.quality import QualityReport, report_documents
from tidegate.operators.surrogate import marked, numbered
from tidegate.operators.upsert import ACTION, INSERTED, KEPT, UPDATED, append, upsert
from tidegate.schema import KEY_COLUMNS, capacity_schema
from tidegate.sources import versions
from tidegate.sources.storage import path_exists, size_of

PARTITION = "measure_date"
# More touched days than this are matched by a join, not by a list.
LISTED_DAYS = 10_000
# Buckets of the keys of a day in a new table: what a load rewrites of a day it touches.
BUCKETS = 8
# Times a load begins again because another one changed the same parts meanwhile.
ATTEMPTS = 5


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, partition_by: str = PARTITION
) -> DataFrame:
    """The table at ``path``, created empty if absent; an existing one is never touched."""
    schema = schema or capacity_schema()
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.partitionBy(partition_by).parquet(path)
    return read_table(spark, path, schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The latest version of the table, as it is when this is called: later loads do not change the frame."""
    schema = schema or capacity_schema()
    version = versions.latest(spark, path)
    if version is None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return versions.read_parts(spark, path, version.parts, schema)


def touched_partitions(target: DataFrame, source: DataFrame, partition_by: str = PARTITION) -> DataFrame:
    """The part of the table that a load of ``source`` can change.

    The days of a load are few (one line per calendar day), so they become a
    static partition filter; a load over more days is matched by a semi join.
    """
    days = source.select(partition_by).distinct()
    listed = [r[0] for r in days.limit(LISTED_DAYS + 1).collect()]
    if len(listed) > LISTED_DAYS:
        day = days.withColumnRenamed(partition_by, "__day")
        return target.join(day, F.col(partition_by).eqNullSafe(F.col("__day")), "left_semi")
    known = [d for d in listed if d is not None]
    condition = F.col(partition_by).isin(known) if known else F.lit(False)
    if len(known) < len(listed):
        condition = condition | F.col(partition_by).isNull()
    return target.where(condition)


@dataclass(frozen=True)
class Rewritten:
    """What a load wrote: parts (a bucket of a day each), files, bytes and rows."""

    parts: int = 0
    files: int = 0
    bytes: int = 0
    rows: int = 0


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = KEY_COLUMNS,
    schema: T.StructType | None = None,
    partition_by: str = PARTITION,
    now: Column | None = None,
    batch: int | None = None,
    writer: str = "load",
    counters: Observation | None = None,
    identity: str | None = None,
    buckets: int = BUCKETS,
    number: str | None = None,
) -> Rewritten:
    """Upsert ``source`` into the table at ``path``.

    Only the parts of the table that the load touches, a bucket of the keys of a day each, are read and
    rewritten.  New content is written beside the old and becomes the table by one
    rename (``versions``): a reader sees all of a load or nothing.  Repeating a call with the same
    ``batch`` after a failure finishes the load instead of loading twice.  A batch is known by its number and
    its ``identity``, or by its rows where the caller has none; other rows under a number used before are a load of their own.
    Without a batch name a repeat is harmless for
    rows with a key.  ``partition_by`` must be a key column, so that no key
    changes its partition.  ``buckets`` counts for a new table.  ``number`` names a column of the table that
    gives each row a number of its own when it is inserted: 1, 2 and so on over all loads, without gaps.
    """
    if partition_by not in keys:
        raise ValueError(f"{partition_by} must be one of the key columns")

    def merge(touched: DataFrame) -> DataFrame:
        return upsert(touched, source, order_by, keys, now, with_action=True)

    change = _Change(path, source, schema or capacity_schema(), partition_by, tuple(keys), batch, writer, identity, buckets, number=number)
    return _apply(spark, change, merge, counters)


@dataclass(frozen=True)
class _Change:
    path: str
    source: DataFrame
    schema: T.StructType
    partition_by: str
    keys: tuple[str, ...]
    batch: int | None
    writer: str
    identity: str | None
    buckets: int
    adds: bool = False  # rows are added beside the parts that are there, which stay as they are
    number: str | None = None


def current_version(spark: SparkSession, path: str, schema: T.StructType, partition_by: str, keys: Sequence[str],
                    buckets: int = BUCKETS) -> versions.Version:
    """The latest version; for a table without manifests what lies there, as version 0."""
    found = versions.latest(spark, path)
    if found is None:
        ensure_table(spark, path, schema, partition_by)
        own = tuple(k for k in keys if k in schema.names)
        found = versions.Version(0, buckets, own, own, tuple(versions.plain_parts(spark, path, partition_by)))
    return found


def _bucket(version: versions.Version, schema: T.StructType, known: Sequence[str]) -> Column:
    """The bucket of a row; null where the row lacks a column that decides it."""
    if any(c not in known for c in version.bucket_by):
        return F.lit(None).cast("int")
    return F.pmod(F.xxhash64(F.lit(0), *(F.col(c).cast(schema[c].dataType) for c in version.bucket_by)), F.lit(version.buckets)).cast("int")


def _touched(version: versions.Version, change: _Change) -> list[versions.Part]:
    """The parts in which rows of the load can lie.  One line per part is collected, as many as a listing has."""
    day = F.col(change.partition_by).cast(change.schema[change.partition_by].dataType).cast("string")
    known = change.keys if set(version.bucket_by) <= set(change.keys) else ()  # else a key may be in any bucket
    found = change.source.select(day.alias("day"), _bucket(version, change.schema, known).alias("bucket")).distinct().collect()
    pairs, days = {(r["day"], r["bucket"]) for r in found}, {r["day"] for r in found}
    return [p for p in version.parts if p.day in days and (p.bucket is None or (p.day, p.bucket) in pairs or (p.day, None) in pairs)]


def _apply(spark: SparkSession, change: _Change, make: Callable[[DataFrame], DataFrame], counters: Observation | None) -> Rewritten:
    """Write what ``make`` makes of the touched parts and put it in their place."""
    path, schema = change.path.rstrip("/"), change.schema
    name = None
    if change.batch is not None:
        name = f"{change.writer}-{change.batch}-{change.identity or _digest(change.source)}"
    for _ in range(ATTEMPTS):
        version = current_version(spark, path, schema, change.partition_by, change.keys, change.buckets)
        touched = _touched(version, change)
        done = version.writers.get(change.writer, "")
        if name is not None and done.rsplit("-v", 1)[0] == name:
            own = versions.written_parts(spark, path, done, change.partition_by)
            return _outcome(spark, path, done, own, counters, [p for p in touched if p.load != done] if change.adds else [])
        load = f"{name or f'{change.writer}-{uuid.uuid4().hex}'}-v{version.number + 1}"
        place = f"{path}/{versions.load_folder(load)}"
        gone = [] if change.adds else touched
        if not path_exists(spark, f"{place}/_SUCCESS"):  # else a call that failed got as far as this
            # Rows of a part are brought together here, AQE evens out the parts.
            rows = make(versions.read_parts(spark, path, gone, schema))
            if change.number is not None:
                rows = _with_numbers(rows, change.number, version.highest, f"{path}__staging/{load}")
            rows = rows.withColumn(versions.BUCKET, _bucket(version, schema, schema.names))
            rows = rows.hint("rebalance", change.partition_by, versions.BUCKET)
            rows.write.mode("overwrite").partitionBy(change.partition_by, versions.BUCKET).parquet(place)
        new = _counted(spark, path, version, change, touched, versions.written_parts(spark, path, load, change.partition_by))
        numbers = 0 if change.number is None else _actions(spark, place).where(F.col(ACTION) == INSERTED).count()
        if versions.commit(spark, path, version.changed(gone, new, change.writer, load, numbers)):
            versions.sweep(spark, path)
            return _outcome(spark, path, load, new, counters, touched if change.adds else [])
    raise RuntimeError(f"other loads changed {path} during each of {ATTEMPTS} attempts")


def _actions(spark: SparkSession, place: str) -> DataFrame:
    """What a written load did to each of its rows."""
    return spark.read.schema(T.StructType([T.StructField(ACTION, T.StringType())])).parquet(place).select(ACTION)


def _with_numbers(rows: DataFrame, number: str, highest: int, at: str) -> DataFrame:
    """Rows of a load in which the inserted ones have numbers above ``highest``."""
    staged = stage(rows, f"{at}/rows")
    new = stage(marked(staged.where(F.col(ACTION) == INSERTED)), f"{at}/new")
    return staged.where(F.col(ACTION) != INSERTED).unionByName(numbered(new, number, highest).select(*staged.columns))


def _keyed_counts(rows: DataFrame, schema: T.StructType, partition_by: str, version: versions.Version, distinct: bool = True) -> dict[tuple, tuple[int, int]]:
    """Per day and bucket: rows with a whole key, and distinct keys among them."""
    day = F.col(partition_by).cast("string").alias("day")
    own = [F.col(k).alias(f"__{k}") for k in version.keys]
    keyed = rows.dropna(subset=list(version.keys)).select(*own, day, _bucket(version, schema, schema.names).alias("bucket"))
    if distinct:
        keyed = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))
    else:
        keyed = keyed.select("day", "bucket", F.lit(1).alias("n"))
    found = keyed.groupBy("day", "bucket").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("keys")).collect()  # a line per part
    return {(r["day"], r["bucket"]): (r["rows"], r["keys"]) for r in found}


def _counted(spark: SparkSession, path: str, version: versions.Version, change: _Change, touched: list[versions.Part],
             new: list[versions.Part]) -> list[versions.Part]:
    """New parts with their rows and keys.  An upsert leaves keys unique that were; where rows are added they are
    counted together with those that the day and bucket hold already."""
    if not new:
        return []
    schema, partition_by = change.schema, change.partition_by
    rows = versions.read_parts(spark, path, new, schema)
    place = [F.col(partition_by).cast("string").alias("day"), _bucket(version, schema, schema.names).alias("bucket")]
    sizes = {(r["day"], r["bucket"]): r["count"] for r in rows.groupBy(*place).count().collect()}  # a line per part
    still = not change.adds and set(change.keys) == set(version.keys) and all(p.keys == p.keyed >= 0 for p in touched)
    if change.adds:
        rows = versions.read_parts(spark, path, [*touched, *new], schema)
    counts = _keyed_counts(rows, schema, partition_by, version, not still)
    out = []
    for part in new:
        keyed, keys = counts.get((part.day, part.bucket), (0, 0))
        out.append(replace(part, rows=sizes.get((part.day, part.bucket), 0), keyed=keyed, keys=keys))
    return out


def _marked(spark: SparkSession, path: str, version: versions.Version, schema: T.StructType, partition_by: str) -> versions.Version:
    """The version with the keys of all parts counted: once for a table that was taken over as it lay."""
    unknown = [p for p in version.parts if p.keyed < 0]
    if not unknown:
        return version
    rows = versions.read_parts(spark, path, unknown, schema)
    sizes = {r["day"]: r["count"] for r in rows.groupBy(F.col(partition_by).cast("string").alias("day")).count().collect()}  # a line per part
    counts: dict[str | None, list[int]] = {}
    for (day, _), pair in _keyed_counts(rows, schema, partition_by, version).items():
        counts[day] = [a + b for a, b in zip(counts.get(day, (0, 0)), pair)]
    marked = [replace(p, rows=sizes.get(p.day, 0), keyed=counts.get(p.day, (0, 0))[0], keys=counts.get(p.day, (0, 0))[1]) for p in unknown]
    out = replace(version, number=version.number + 1, parts=tuple(p for p in version.parts if p.keyed >= 0) + tuple(marked))
    return out if versions.commit(spark, path, out) else versions.latest(spark, path)


def _outcome(spark: SparkSession, path: str, load: str, parts: list[versions.Part], counters: Observation | None,
             beside: list[versions.Part]) -> Rewritten:
    """What a load wrote, and its actions for the observer; ``beside``: touched parts that stayed as they were."""
    place = f"{path}/{versions.load_folder(load)}"
    if counters is not None:
        actions = _actions(spark, place).groupBy(ACTION).agg(F.count(F.lit(1)).alias("n"))
        kept = sum(p.rows for p in beside)
        if any(p.rows < 0 for p in beside):
            kept = spark.read.parquet(*(f"{path}/{p.folder}" for p in beside)).count()
        lines = actions.unionByName(spark.createDataFrame([(KEPT, kept)], f"{ACTION} string, n long"))
        sums = [F.coalesce(F.sum(F.when(F.col(ACTION) == name, F.col("n"))), F.lit(0)).alias(name) for name in (INSERTED, UPDATED, KEPT)]
        lines.observe(counters, *sums).collect()
    files, size = size_of(spark, place)
    return Rewritten(len(parts), max(0, files - 1), size, sum(max(p.rows, 0) for p in parts))


def _digest(rows: DataFrame) -> str:
    """Tells the content of one load from another, whatever the order of its rows."""
    line = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{line['n']}-{line['h'] or 0}"


def staging_path(path: str, batch: int | None, writer: str) -> str:
    """Where a load is staged.  Batches of one writer alternate between two slots.

    Two are enough: a batch is only repeated while it is the writer's latest.
    """
    slot = "once" if batch is None else str(batch % 2)
    return f"{path.rstrip('/')}__staging/{writer}-{slot}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write rows once and go on from the written table.

    Several branches (accepted, rejected, checks) then share one scan of the
    feed files, and all see the same rows.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_into(spark: SparkSession, path: str, source: DataFrame, schema: T.StructType | None = None,
                partition_by: str = PARTITION, order_by: Sequence[str] = (), now: Column | None = None,
                batch: int | None = None, writer: str = "load", counters: Observation | None = None,
                keys: Sequence[str] = KEY_COLUMNS, identity: str | None = None, buckets: int = BUCKETS) -> Rewritten:
    """Add all rows of ``source``: a load without a usable key.

    Nothing that is there is rewritten.  With a ``batch`` number a repeat adds nothing, as with ``merge_into``;
    without one it adds the rows again.  ``keys`` are what a new table is bucketed by.
    """
    schema = schema or capacity_schema()

    def add(_: DataFrame) -> DataFrame:
        return append(spark.createDataFrame([], schema), source, order_by, now, with_action=True)

    change = _Change(path, source, schema, partition_by, tuple(keys), batch, writer, identity, buckets, adds=True)
    return _apply(spark, change, add, counters)


def unique_keys(spark: SparkSession, path: str, keys: Sequence[str] = KEY_COLUMNS, schema: T.StructType | None = None,
                partition_by: str = PARTITION) -> bool:
    """Whether no key stands twice in the table; rows with a null key are left out of the question.

    The partition column is part of the key, so the answer is that of each part, and every load counts the parts
    that it writes.  Only for other keys than those the table was begun with is the whole table read.
    """
    schema = schema or capacity_schema()
    keys = [k for k in keys if k]
    if not keys or any(k not in schema.names for k in keys):
        return False
    version = current_version(spark, path, schema, partition_by, keys)
    if set(version.keys) != set(keys) or partition_by not in keys:
        return validate_unique_key(read_table(spark, path, schema).dropna(subset=keys), keys)[0]
    return all(p.keys == p.keyed for p in _marked(spark, path, version, schema, partition_by).parts)


def load(spark: SparkSession, path: str, source: DataFrame, order_by: Sequence[str],
         keys: Sequence[str] = KEY_COLUMNS, schema: T.StructType | None = None,
         partition_by: str = PARTITION, now: Column | None = None, batch: int | None = None,
         writer: str = "load", counters: Observation | None = None, identity: str | None = None) -> str:
    """Upsert if ``keys`` are unique in the whole table, else append; says which."""
    if unique_keys(spark, path, keys, schema, partition_by):
        merge_into(spark, path, source, order_by, keys, schema, partition_by, now, batch, writer, counters, identity)
        return "upsert"
    append_into(spark, path, source, schema, partition_by, order_by, now, batch, writer, counters, keys, identity)
    return "append"


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """Processed rows as CSV with a header, in a folder of their own; raw files stay as they are."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    if by:
        writer = writer.partitionBy(by)
    writer.csv(path)


def export_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, **properties: str) -> None:
    """Append rows to a table of an external database."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **properties).mode("append").save()


def stored_report(report: QualityReport, path: str) -> QualityReport:
    """The report with its affected rows, which may be long, computed once and kept at ``path``, for what is written more than once."""
    rows = stage(report.issue_rows, path)
    return replace(report, find_rows=lambda: rows)


def write_report(report: QualityReport, path: str, run_date: str, by: str = "file_name") -> None:
    """Reports of all files as JSON lines, one folder per run date; affected rows beside them."""
    dated = {"run_date": F.lit(run_date)}
    for name, table in (("reports", report_documents(report, by)), ("issue_rows", report.issue_rows)):
        (
            table.withColumns(dated)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_date")
            .json(f"{path}/{name}")
        )
