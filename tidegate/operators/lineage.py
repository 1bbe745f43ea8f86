"""Where rows come from: cycle, measured day and download time of their file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.cycles import UNKNOWN_CYCLE, cycle_id, intraday_label
from tidegate.functions.dates import epoch_date, parse_date
from tidegate.functions.filenames import date_text_of_filename, stem
from tidegate.operators.duplicates import last_per_key
from tidegate.operators.skew import BROADCAST_ROWS
from tidegate.schema import LINEAGE_COLUMNS

# Rows of one file are joined in pieces of this many bytes of the file.
SEGMENT_BYTES = 256 * 1024 * 1024


def resolve_lineage(
    files: DataFrame,
    sidecars: DataFrame,
    now: float | Column | None = None,
    compat_dates: bool = False,
) -> DataFrame:
    """The lineage values of every file, with the fallbacks for what is missing.

    ``files``: file_name, file_modified and any other column; ``sidecars`` as
    from ``read_sidecars``.  A sidecar's values win; a file without one is read
    by its name; an unreadable sidecar leaves the defaults.  Of several sidecars of
    one stem the readable one of the latest download counts, so a file is never
    multiplied.  ``compat_dates``
    does not accept yyyyMMdd dates and replaces today's date, both by the day of
    the download.
    """
    if now is None:
        now = F.unix_micros(F.current_timestamp()) / 1e6
    elif not isinstance(now, Column):
        now = F.lit(float(now))
    today = epoch_date(now)
    fields = ("cycle_name", "date", "download_timestamp", "date_is_text", "readable")
    latest = last_per_key(
        sidecars.select("stem", *fields), ["stem"], ["readable", "download_timestamp", "cycle_name", "date", "date_is_text"]
    )
    side = latest.select(F.col("stem").alias("__stem"), *[F.col(c).alias(f"__{c}") for c in fields])
    joined = files.withColumn("__file_stem", stem(F.col("file_name"))).join(
        side, F.col("__file_stem") == F.col("__stem"), "left"
    )
    alone, usable = F.col("__stem").isNull(), F.coalesce(F.col("__readable"), F.lit(False))
    named = intraday_label(F.col("file_name"))

    cycle = (
        F.when(usable, F.coalesce(F.nullif(F.col("__cycle_name"), F.lit("")), named, F.lit(UNKNOWN_CYCLE)))
        .when(alone, F.coalesce(named, F.lit(UNKNOWN_CYCLE)))
        .otherwise(F.lit(UNKNOWN_CYCLE))
    )
    modified = F.unix_micros("file_modified") / 1e6
    downloaded = F.when(
        usable, F.coalesce(F.nullif(F.col("__download_timestamp"), F.lit(0.0)), modified)
    ).otherwise(now)
    download_day = epoch_date(downloaded)

    parsed = parse_date(F.col("__date"), compact=not compat_dates)
    if compat_dates:
        parsed = F.when(parsed != today, parsed)
    epoch = F.nullif(F.col("__date").try_cast("double"), F.lit(0.0))
    from_sidecar = F.coalesce(
        F.when(F.col("__date_is_text"), parsed).otherwise(epoch_date(epoch)), download_day
    )
    in_name = date_text_of_filename(F.col("file_name"))
    day = (
        F.when(usable, from_sidecar)
        .when(alone & in_name.isNotNull(), in_name.try_cast("date"))
        .otherwise(today)
    )
    return joined.select(
        *files.columns,
        day.alias("measure_date"),
        cycle_id(cycle).alias("cycle_id"),
        downloaded.cast("double").alias("download_timestamp"),
    )


def attach_lineage(
    rows: DataFrame, resolved: DataFrame, broadcast_files: int = BROADCAST_ROWS, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Rows with their file's lineage columns; left alone if they have all of them.

    ``resolved`` has one line per file (file_path, file_size, lineage).  Few
    files, checked by counting, are broadcast; else both sides are shuffled by
    file and segment of the file, so that a huge file is spread over many tasks.
    """
    if all(c in rows.columns for c in LINEAGE_COLUMNS):
        return rows
    rows = rows.drop(*LINEAGE_COLUMNS)
    per_file = resolved.select("file_path", "file_size", *LINEAGE_COLUMNS)
    if per_file.count() <= broadcast_files:
        return rows.join(F.broadcast(per_file.drop("file_size")), "file_path", "left").select(
            *rows.columns, *LINEAGE_COLUMNS
        )
    last = F.floor(F.greatest(F.col("file_size") - 1, F.lit(0)) / segment_bytes)
    pieces = per_file.withColumn("__segment", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("file_size")
    cut = rows.withColumn("__segment", F.floor(F.col("block_start") / segment_bytes))
    return cut.join(pieces, ["file_path", "__segment"], "left").select(*rows.columns, *LINEAGE_COLUMNS)


def files_of(rows: DataFrame) -> DataFrame:
    """The files rows come from, one line each."""
    return rows.select("file_path", "file_name", "file_size", "file_modified").distinct()
