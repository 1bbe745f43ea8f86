"""Column names of feed files.  Names only: no data passes through here."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from itertools import count

from pyspark.sql import DataFrame, SparkSession, functions as F

_NOT_WORD = re.compile(r"\W")


def distinct_names(header: Sequence[str]) -> list[str]:
    """Header as read: blanks become ``Unnamed: <i>``, repeats get ``.1``, ``.2``, ...

    A suffixed name never takes one that stands in the header itself.
    """
    filled = [name or f"Unnamed: {i}" for i, name in enumerate(header)]
    reserved, names = set(filled), []
    for name in filled:
        if name in names:
            name = next(c for c in (f"{name}.{n}" for n in count(1)) if c not in reserved)
            reserved.add(name)
        names.append(name)
    return names


def clean_name(name: str) -> str:
    """Lower case, only word characters, no digit in front."""
    clean = _NOT_WORD.sub("_", name.lower())
    return f"col_{clean}" if clean[:1].isdigit() else clean


def clean_names(names: Iterable[str]) -> list[str]:
    """``clean_name`` of every name; one already taken gets ``_1``, ``_2``, ..."""
    taken: dict[str, None] = {}
    for name in map(clean_name, names):
        variants = (f"{name}_{n}" if n else name for n in count())
        taken[next(v for v in variants if v not in taken)] = None
    return list(taken)


def sanitise_header(df: DataFrame) -> DataFrame:
    """``df`` with table-safe column names; a rename only, nothing is computed."""
    return df.toDF(*clean_names(df.columns))


def split_header(line: str, sep: str = ",") -> list[str]:
    """Field names of a header line, made distinct."""
    fields = next(csv.reader([line.lstrip("﻿").rstrip("\r\n")], delimiter=sep), [])
    return distinct_names(fields)


def file_headers(
    spark: SparkSession, path: str, glob: str = "*.[cC][sS][vV]", min_bytes: int = 0
) -> DataFrame:
    """First line of every file as ``(file_path, header)``: one pass over the text."""
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .text(path)
        .where(F.col("_metadata.file_size") >= min_bytes)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("start"),
            "value",
        )
        .withColumn("line", F.monotonically_increasing_id())
    )
    return lines.where("start = 0").groupBy("file_path").agg(F.min_by("value", "line").alias("header"))
