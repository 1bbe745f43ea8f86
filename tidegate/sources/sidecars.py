"""Sidecar metadata: one small JSON record per feed file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.functions.cycles import cycle_of_filename, is_allowed_cycle
from tidegate.functions.filenames import filename_of_response, safe_filename, scanned_name, stem
from tidegate.operators.duplicates import last_per_key
from tidegate.schema import SIDECAR_SCHEMA
from tidegate.sources.feed import LISTED_FILES, MIN_BYTES

SIDECAR_GLOB = "*.meta.json"


def read_sidecars(spark: SparkSession, path: str, of_files: DataFrame | None = None) -> DataFrame:
    """``stem``, the sidecar fields, ``date_is_text`` and ``readable`` per sidecar file.

    ``of_files`` (file_path) limits the read to the sidecars of those files: up
    to ``LISTED_FILES`` of them become a list that prunes the folder listing, so
    that a load of few files does not open the sidecars of all; more of them are
    matched by a semi join.  A sidecar that is not JSON is kept as unreadable: its
    feed file falls back to defaults, unlike a file without any sidecar.
    """
    raw = spark.read.option("pathGlobFilter", SIDECAR_GLOB).text(path, wholetext=True)
    if of_files is not None:
        wanted = F.regexp_replace(F.substring_index("file_path", "/", -1), r"(?<=.)\.[^.]+$", "")
        wanted_names = of_files.select(F.concat(wanted, F.lit(".meta.json")).alias("__name")).distinct()
        names = wanted_names.limit(LISTED_FILES + 1).collect()
        file_name = F.col("_metadata.file_name")
        if len(names) <= LISTED_FILES:
            raw = raw.where(file_name.isin([n[0] for n in names]))
        else:
            raw = raw.select("*", "_metadata").join(wanted_names, file_name == F.col("__name"), "left_semi")
    return parse_sidecars(raw.select(F.regexp_replace(scanned_name(), r"\.meta\.json$", "").alias("stem"), "value"))


def parse_sidecars(documents: DataFrame) -> DataFrame:
    """The sidecar fields of JSON texts (``stem``, ``value``); a text that is no JSON is not ``readable``."""
    fields = [
        F.try_variant_get("doc", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in SIDECAR_SCHEMA
    ]
    kind = F.schema_of_variant(F.try_variant_get("doc", "$.date", "variant"))
    return documents.select("stem", F.try_parse_json("value").alias("doc")).select(
        "stem",
        *fields,
        F.coalesce(kind == "STRING", F.lit(False)).alias("date_is_text"),
        F.col("doc").isNotNull().alias("readable"),
    )


def sidecars_of(manifest: DataFrame) -> DataFrame:
    """A manifest table (``SIDECAR_SCHEMA``) in the form of ``read_sidecars``.

    Of several records for one file the latest download counts, as it replaced
    the file.
    """
    named = manifest.select(stem(F.col("saved_filename")).alias("stem"), *SIDECAR_SCHEMA.names)
    return last_per_key(named, ["stem"], ["download_timestamp"]).withColumns({
        "date_is_text": F.col("date").isNotNull(),
        "readable": F.lit(True),
    })


def accepted_responses(responses: DataFrame, now: Column | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Manifest records for the responses that carry a usable feed file.

    ``responses``: endpoint, requested_cycle, day (date), disposition (header
    text or null), content_length, received (epoch seconds).  Kept are files of
    an allowed cycle that are not tiny.
    """
    original = filename_of_response(F.col("disposition"), F.col("endpoint"), F.col("day"))
    now = F.col("received") if now is None else now
    return (
        responses.withColumn("original_filename", original)
        .withColumn("cycle_name", cycle_of_filename(F.col("original_filename")))
        .where(is_allowed_cycle(F.col("cycle_name")))
        .where(F.col("content_length") >= min_bytes)
        .select(
            "endpoint",
            "requested_cycle",
            "cycle_name",
            F.date_format("day", "yyyyMMdd").alias("date"),
            "original_filename",
            safe_filename(F.col("original_filename"), now).alias("saved_filename"),
            F.date_format(F.timestamp_seconds("received"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("download_time"),
            F.col("received").cast("double").alias("download_timestamp"),
        )
    )


def append_manifest(records: DataFrame, path: str) -> None:
    records.select(*SIDECAR_SCHEMA.names).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SIDECAR_SCHEMA).parquet(path)
