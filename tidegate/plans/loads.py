"""From landing folder to keyed table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tidegate.functions.filenames import stem
from tidegate.operators.clean import nan_to_null, split_casts
from tidegate.operators.quality import refused_files, unreadable_files
from tidegate.operators.upsert import split_check
from tidegate.plans.recipes import Load, run_recipe
from tidegate.schema import KEY_COLUMNS, capacity_schema
from tidegate.session import materialise
from tidegate.sources.feed import (
    CSV_GLOB, FILE_COLUMNS, MIN_BYTES, SCAN, list_files, read_feed, read_layouts, scan_order, split_surplus, with_row_index,
)
from tidegate.sources.sidecars import read_sidecars
from tidegate.sources.soundness import check_folder
from tidegate.sources.tables import load as load_table, stage

# Files of one load follow each other by download time and name, rows by position.
ROW_ORDER = ("download_timestamp", "file_path", "row_id")


@dataclass(frozen=True)
class Prepared:
    """Typed rows ready for the table, and the rows that cannot go there.

    ``surplus``: the lines with more fields than their file's header;
    ``unreadable``: an issue per file that a sidecar announces but that is not
    there, and per file without a row.
    """

    accepted: DataFrame
    uncastable: DataFrame
    rejected: DataFrame
    surplus: DataFrame | None = None
    unreadable: DataFrame | None = None


def prepare(processed: DataFrame, schema: T.StructType | None = None) -> Prepared:
    """Typing and row checks of processed feed rows."""
    schema = schema or capacity_schema()
    origin = [c for c in (*FILE_COLUMNS, "row_id") if c in processed.columns]
    typed, uncastable = split_casts(processed, schema, keep=origin)
    accepted, rejected = split_check(nan_to_null(typed))
    helpers = [c for c in origin if c not in ROW_ORDER]
    return Prepared(accepted.drop(*helpers), uncastable, rejected)


def unreadable(announced: DataFrame, listed: DataFrame, rows: DataFrame, refused: DataFrame | None = None) -> DataFrame:
    """Issues of the announced files that are not listed, of the listed ones without rows, and of those ``refused``
    (``file_path``, ``error``) as a whole, by ``file_path``.

    A file that is not there is named by its stem; it has no path.
    """
    files = listed.select("file_path", stem(F.col("file_name")).alias("stem"))
    absent = announced.select("stem").distinct().join(files, "stem", "left_anti").select(
        F.concat("stem", F.lit(".csv")).alias("file_path"))
    counts = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("record_count"))
    expected = files.select("file_path").unionByName(absent)
    listed = files.select("file_path")
    if refused is None:
        return unreadable_files(expected, listed, counts, by="file_path")
    others = listed.join(refused.select("file_path"), "file_path", "left_anti")
    issues = unreadable_files(expected.join(refused.select("file_path"), "file_path", "left_anti"), others, counts, by="file_path")
    return issues.unionByName(refused_files(refused, by="file_path"))


def load_folder(
    spark: SparkSession,
    landing: str,
    sidecars: str,
    table: str,
    kind: str = "capacity",
    header: Sequence[str] | None = None,
    keys: Sequence[str] = KEY_COLUMNS,
    now: float | None = None,
    compat_dates: bool = False,
    batch: int | None = None,
    min_bytes: int = MIN_BYTES,
    counters: Observation | None = None,
) -> Prepared:
    """Load every file of ``landing`` into the table; returns what was loaded and set aside.

    Without a ``header`` every file is read by its own.  Lines with more fields
    than that are set aside with their file and row.  A file that cannot be read to its end, or is not UTF-8, is
    an issue and none of its rows is loaded; one pass over the lines finds that out and the headers.  The files are then parsed
    once: raw and processed rows are staged beside the table, in a
    folder of this load's own, and numbering, loading, quarantine and later quality checks
    read them from there.  The returned frames are good until it is removed.
    """
    place = f"{table.rstrip('/')}__staging/rows-{uuid.uuid4().hex}"
    checked = check_folder(spark, landing, f"{place}/checked", min_bytes, CSV_GLOB)
    refused = materialise(checked.refused)
    if header is None:
        rows = read_layouts(spark, landing, min_bytes=min_bytes, index=SCAN, headers=checked.sound)
    else:
        rows = scan_order(read_feed(spark, landing, header, min_bytes=min_bytes)).join(refused.select("file_path"), "file_path", "left_anti")
    announced = read_sidecars(spark, sidecars)
    listed = list_files(spark, landing).where(F.col("file_size") >= min_bytes)
    load = Load(sidecars=announced, files=listed, now=now, compat_dates=compat_dates)
    raw = with_row_index(stage(rows, f"{place}/raw"))
    fitting, surplus = split_surplus(raw)
    processed = stage(run_recipe(fitting, kind, load), f"{place}/processed")
    prepared = replace(prepare(processed), surplus=surplus, unreadable=unreadable(announced, listed, raw, refused))
    stamp = None if now is None else F.timestamp_seconds(F.lit(now))
    load_table(spark, table, prepared.accepted, ROW_ORDER, keys, now=stamp, batch=batch, counters=counters)
    return prepared
