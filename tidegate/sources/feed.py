"""Reading landing folders of feed files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidegate.functions.filenames import scanned_name
from tidegate.functions.text import null_if_na
from tidegate.session import materialise
from tidegate.sources.headers import clean_names, file_headers, split_header

# Plain and compressed files.
CSV_GLOB = "*.[cC][sS][vV]{,.gz}"
# Smaller files hold no more than a header.
MIN_BYTES = 200
# Files named in a filter at most; longer lists become a join.
LISTED_FILES = 10_000
# The whole line of a row with more fields than its header, null for every other row.
SURPLUS = "surplus_line"
# The place of a row in the scan, where rows are numbered after they are stored.
SCAN = "__scan"
# Columns that say where a row comes from.
FILE_COLUMNS = ("file_name", "file_path", "file_size", "file_modified", "block_start", SURPLUS)


def _metadata_columns() -> list:
    meta = F.col("_metadata")
    return [
        scanned_name().alias("file_name"),
        meta["file_path"].alias("file_path"),
        meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("file_modified"),
        meta["file_block_start"].alias("block_start"),
    ]


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _scan_schema(names: Sequence[str]) -> T.StructType:
    """``names``, and the line of every row that does not have exactly as many fields."""
    return text_schema([*names, SURPLUS])


def _fields_of(line: Column, sep: str) -> Column:
    """How many fields a line has; separators between quotes are none."""
    mark = re.escape(sep)
    bare = F.regexp_replace(line, rf'(^|{mark})\s*"(?:[^"]|"")*"', "$1")
    return F.floor((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep)) + 1


def split_surplus(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit their header, and where the others stand: origin columns and whole line.

    A row with more fields than its file has columns cannot be told apart from
    one that is shifted, so none of its values goes to a table.
    """
    origin = [c for c in (*FILE_COLUMNS, "row_id") if c in rows.columns]
    surplus = F.col(SURPLUS).isNotNull()
    return rows.where(~surplus).drop(SURPLUS), rows.where(surplus).select(*origin)


def landed_header(spark: SparkSession, path: str | list[str], sep: str = ",", min_bytes: int = MIN_BYTES) -> list[str]:
    """Column names of a landing folder, taken from the first line of one of its files."""
    first = (
        spark.read.option("pathGlobFilter", CSV_GLOB)
        .text(path)
        .where(F.col("_metadata.file_size") >= min_bytes)
        .select("value")
        .head(1)
    )
    return split_header(first[0]["value"], sep) if first else []


def _csv_options(sep: str, multi_line: bool, glob: str = CSV_GLOB) -> dict[str, object]:
    return {
        "header": True,
        "mode": "PERMISSIVE",
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "pathGlobFilter": glob,
        "columnNameOfCorruptRecord": SURPLUS,
    }


def shape_feed(
    raw: DataFrame, names: Sequence[str], min_bytes: int = MIN_BYTES, sep: str = ","
) -> DataFrame:
    """Missing-value texts of the ``names`` columns as null, origin columns added, tiny files dropped.

    Columns that stem from folder names are kept.  Works on a batch scan and on
    a stream alike.  Rows with more fields than ``names`` keep their line in
    ``SURPLUS``; shorter rows end in nulls.
    """
    columns = [null_if_na(F.col(c)).alias(c) if c in names else F.col(c) for c in raw.columns if c != SURPLUS]
    surplus = F.when(_fields_of(F.col(SURPLUS), sep) > len(names), F.col(SURPLUS)).alias(SURPLUS)
    return raw.where(F.col("_metadata.file_size") >= min_bytes).select(*columns, *_metadata_columns(), surplus)


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    header: Sequence[str] | None = None,
    sep: str = ",",
    multi_line: bool = False,
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """All CSV files below ``path`` as text columns, names made table-safe, plus ``FILE_COLUMNS``.

    Files that vanish or cannot be read are skipped, others go on.  Rows with more
    fields than columns are marked, see ``split_surplus``.  Give ``header`` where the layout is known; otherwise the first line of one file
    is looked up.  Big files are read as splits by many tasks unless fields hold
    line breaks (``multi_line``).
    """
    names = clean_names(header if header is not None else landed_header(spark, path, sep, min_bytes))
    raw = (
        spark.read.schema(_scan_schema(names))
        .options(**_csv_options(sep, multi_line))
        .option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True)
        .csv(path)
    )
    return shape_feed(raw, names, min_bytes, sep)


def _layouts(spark: SparkSession, path: str | list[str], sep: str, min_bytes: int, headers: DataFrame | None = None) -> tuple[DataFrame, list[list[str]]]:
    """Names of every file's columns in its order (``__path``, ``__names``), and all layouts there are."""
    headers = materialise(file_headers(spark, path, CSV_GLOB, min_bytes) if headers is None else headers.select("file_path", "header"))
    layouts = {r["header"]: clean_names(split_header(r["header"], sep)) for r in headers.select("header").distinct().collect()}
    named = spark.createDataFrame(list(layouts.items()), "header string, __names array<string>")
    return headers.join(named, "header").select(F.col("file_path").alias("__path"), "__names"), list(layouts.values())


def file_layouts(spark: SparkSession, path: str, sep: str = ",", min_bytes: int = MIN_BYTES) -> DataFrame:
    """One line per file with the columns it has: ``file_path``, ``file_columns``."""
    files, _ = _layouts(spark, path, sep, min_bytes)
    return files.select(F.col("__path").alias("file_path"), F.col("__names").alias("file_columns"))


def read_layouts(
    spark: SparkSession, path: str | list[str], sep: str = ",", multi_line: bool = False, min_bytes: int = MIN_BYTES,
    index: str | None = None, headers: DataFrame | None = None, glob: str = CSV_GLOB,
) -> DataFrame:
    """Like ``read_feed`` for a folder whose files do not share one header.

    One pass over the text finds the headers, one line per file; one scan then
    reads all files by position, and every file's own header says which column
    a position is.  A column that a file lacks is null, a row longer than its
    file's header is marked (``split_surplus``).  ``index`` adds the row
    position (``with_row_index``), which must be taken before files are matched; ``SCAN`` marks the rows so that it
    can be taken once they are stored (``scan_order``).  ``headers`` (file_path, header) spares the first
    pass, and only files that it names are read.
    """
    files, layouts = _layouts(spark, path, sep, min_bytes, headers)
    numbered = {None: lambda rows, _: rows, SCAN: lambda rows, _: scan_order(rows)}.get(index, with_row_index)
    if not layouts:
        return numbered(read_feed(spark, path, [], sep, multi_line, min_bytes), index)
    places = [f"__{i}" for i in range(max(map(len, layouts)))]
    raw = (
        spark.read.schema(_scan_schema(places))
        .options(**_csv_options(sep, multi_line, glob))
        .option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True)
        .csv(path)
    )
    rows = raw.where(F.col("_metadata.file_size") >= min_bytes).select(*raw.columns, *_metadata_columns())
    rows = numbered(rows, index)
    few = files.limit(LISTED_FILES + 1).count() <= LISTED_FILES
    rows = rows.join(F.broadcast(files) if few else files, F.col("file_path") == F.col("__path"))
    cells = F.array(*places)
    columns = [
        null_if_na(F.get(cells, F.array_position("__names", F.lit(name)).cast("int") - 1)).alias(name)
        for name in dict.fromkeys(n for names in layouts for n in names)
    ]
    # A row that fills all places has no line of its own: its fields make one up.
    fields = F.when(F.col(SURPLUS).isNull(), len(places)).otherwise(_fields_of(F.col(SURPLUS), sep))
    special = rf'["\r\n]|{re.escape(sep)}'
    quoted = F.transform(cells, lambda c: F.when(
        c.rlike(special), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c))
    line = F.coalesce(F.col(SURPLUS), F.array_join(quoted, sep, ""))
    surplus = F.when(fields > F.size("__names"), line).alias(SURPLUS)
    kept = [F.col(c) for c in rows.columns if c not in (*places, "__path", "__names", SURPLUS)]
    return rows.select(*columns, *kept, surplus)


def read_feed_stream(
    spark: SparkSession,
    path: str,
    header: Sequence[str],
    sep: str = ",",
    multi_line: bool = False,
    min_bytes: int = MIN_BYTES,
    max_files: int | None = None,
) -> DataFrame:
    """The landing folder as a stream: each file is delivered once per checkpoint."""
    names = clean_names(header)
    reader = spark.readStream.schema(_scan_schema(names)).options(**_csv_options(sep, multi_line))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return shape_feed(reader.csv(path), names, min_bytes, sep)


def read_files_stream(spark: SparkSession, path: str, min_bytes: int = MIN_BYTES, max_files: int | None = None, glob: str = CSV_GLOB) -> DataFrame:
    """The files of a landing folder as a stream, a line each (``path``, ``file_path`` as rows name it, ``file_size``).

    Contents are not opened; what is done with a file, its own header included, is up to the step that gets it.
    """
    listing = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(listing).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    found = reader.load(path).where(F.col("length") >= min_bytes)
    return found.select("path", F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"))


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Feeds of different layouts in one frame; a column one of them lacks is null there.

    Where the table must keep its values for such a column, load the layouts one
    after the other instead: an upsert writes nulls it is given.
    """
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def list_files(spark: SparkSession, path: str | list[str], glob: str = CSV_GLOB) -> DataFrame:
    """One line per file, from the listing only; contents are not opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            scanned_name().alias("file_name"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_modified"),
        )
    )


def scan_order(df: DataFrame) -> DataFrame:
    """Rows marked with their place in the scan, for ``with_row_index`` once they are stored.

    The files are then parsed once: rows are counted per split from the stored column.
    """
    return df.withColumn(SCAN, F.monotonically_increasing_id())


def with_row_index(df: DataFrame, name: str = "row_id") -> DataFrame:
    """0-based position of each row in its file.

    Rows are numbered inside their split first; the row counts of a file's
    splits, one line each, are summed up to give every split its start.  No
    task ever holds more than one split of a file, however big the file is.
    Apply it right after ``read_feed``, as the order is that of the scan, or to stored rows that ``scan_order`` marked.
    """
    split = ["file_path", "block_start"]
    scanned = df if SCAN in df.columns else scan_order(df)
    base = (
        scanned.groupBy(*split)
        .agg(F.min(SCAN).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    )
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = base.select(
        *split, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    position = F.col(SCAN) - F.col("__first") + F.col("__offset")
    columns = [c for c in df.columns if c != SCAN]
    return scanned.join(offsets, split, "left").withColumn(name, position).select(*columns, name)
