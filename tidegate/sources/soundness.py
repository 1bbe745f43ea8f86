"""Which files can be read from end to end, and which are refused as a whole."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

# A file that breaks while it is read, or is gone; anything else that fails is not the file's fault.
_FILE_FAULT = "FAILED_READ_FILE"
_GLOB_SIGNS = re.compile(r"([\[\]{}*?\\])")


@dataclass(frozen=True)
class Checked:
    """``files``: ``file_path``, ``header`` (first line), ``lines``, ``undecodable`` (lines that are no UTF-8) of the files read to
    their end; ``broken``: paths and errors of the others."""

    files: DataFrame
    broken: dict[str, str]

    @property
    def sound(self) -> DataFrame:
        return self.files.where("undecodable = 0")

    @property
    def refused(self) -> DataFrame:
        """``file_path`` and ``error`` of the files of which no row may be loaded."""
        text = F.concat(F.lit("not UTF-8: "), F.col("undecodable").cast("string"), F.lit(" lines"))
        lines = self.files.where("undecodable > 0").select("file_path", text.alias("error"))
        broken = self.files.sparkSession.createDataFrame(sorted(self.broken.items()), "file_path string, error string")
        return lines.unionByName(broken)


def literal(path: str) -> str:
    """A path that Spark reads as it stands, signs of patterns included."""
    return _GLOB_SIGNS.sub(r"\\\1", path)


def _scan(spark: SparkSession, paths: Sequence[str], min_bytes: int = 0, glob: str = "*") -> DataFrame:
    meta = F.col("_metadata")
    text = spark.read.option("ignoreCorruptFiles", False).option("ignoreMissingFiles", False).option("pathGlobFilter", glob).text(list(paths))
    lines = text.where(meta["file_size"] >= min_bytes).select(
        "value", meta["file_path"].alias("file_path"), F.when(meta["file_block_start"] == 0, F.monotonically_increasing_id()).alias("line"))
    return lines.groupBy("file_path").agg(
        F.min_by("value", "line").alias("header"), F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.is_valid_utf8("value")).alias("undecodable"))


def check_files(spark: SparkSession, paths: Sequence[str], at: str) -> Checked:
    """Read files, one pass over their lines, and tell those that break.

    All are read in one job.  If it fails on a file, the list is cut in half, again and again, until what breaks
    stands alone; the halves that are sound are not read again.  What is found is kept below ``at``.
    """
    at, parts, broken = f"{at}/{uuid.uuid4().hex}", [], {}
    waiting = [list(paths)] if paths else []
    while waiting:
        group = waiting.pop()
        place = f"{at}/{len(parts) + len(waiting)}-{uuid.uuid4().hex}"
        try:
            _scan(spark, [literal(p) for p in group]).write.parquet(place)
            parts.append(place)
        except (PySparkException, Py4JJavaError) as error:
            if _FILE_FAULT not in str(error) and "PATH_NOT_FOUND" not in str(error):
                raise
            if len(group) == 1:
                broken[group[0]] = _cause(str(error))
            else:
                waiting += [group[len(group) // 2 :], group[: len(group) // 2]]
    schema = "file_path string, header string, lines long, undecodable long"
    return Checked(spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema), broken)


def check_folder(spark: SparkSession, path: str, at: str, min_bytes: int, glob: str) -> Checked:
    """``check_files`` of all files of a folder; they are only listed one by one where one of them breaks."""
    place = f"{at}/{uuid.uuid4().hex}"
    try:
        _scan(spark, [path], min_bytes, glob).write.parquet(place)
    except (PySparkException, Py4JJavaError) as error:
        if _FILE_FAULT not in str(error):
            raise
        meta = F.col("_metadata")
        listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).where(F.col("length") >= min_bytes)
        urls = {r["path"]: r["url"] for r in listed.select("path", meta["file_path"].alias("url")).collect()}  # a line per file
        found = check_files(spark, list(urls), at)
        return Checked(found.files, {urls[p]: error for p, error in found.broken.items()})
    return Checked(spark.read.parquet(place), {})


def _cause(text: str) -> str:
    """The innermost reason of a failed job, in one line."""
    causes = re.findall(r"Caused by: ([^\n]+)", text)
    return (causes[-1] if causes else text.split("\n", 1)[0])[:500]
