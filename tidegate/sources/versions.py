"""Versions of a keyed table: which folder holds each part of it, swapped by one rename.

A part is one day, or one bucket of the keys of a day.  A load writes the parts it changes into
a folder of its own and then puts a new manifest beside the earlier ones: a file that names the
folder of every part.  Until then readers see nothing of it, afterwards all of it.  The manifest also
keeps, per part, its rows, those with a whole key and their distinct keys, and per writer
its latest load.  It has a line per part, as long as a listing of the partitions.

Folders that no manifest of the latest ``KEEP`` versions names are removed after a load, so a reader has that many
loads' time.  A table without manifests, as another tool may have written it, is taken over as it lies.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

from tidegate.sources.storage import children, read_text, remove, write_new

KEEP = 3
BUCKET = "__bucket"
LOADS, VERSIONS = "_loads", "_versions"
_NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Part:
    """``keyed`` and ``keys`` are of all parts of the day and bucket up to this one; -1: not counted."""

    folder: str
    day: str | None
    bucket: int | None
    rows: int = -1
    keyed: int = -1
    keys: int = -1

    @property
    def load(self) -> str | None:
        """The load that wrote it; None for a part that was there before the first manifest."""
        return self.folder.split("/")[1].removeprefix("load=") if self.folder.startswith(f"{LOADS}/") else None


@dataclass(frozen=True)
class Version:
    number: int
    buckets: int
    bucket_by: tuple[str, ...]
    keys: tuple[str, ...]
    parts: tuple[Part, ...] = ()
    writers: dict[str, str] = field(default_factory=dict)
    highest: int = 0  # of the numbers given to rows

    def changed(self, gone: Iterable[Part], new: Iterable[Part], writer: str, load: str, numbers: int = 0) -> Version:
        gone = set(gone)
        kept = tuple(p for p in self.parts if p not in gone)
        writers = {**self.writers, writer: load}
        return replace(self, number=self.number + 1, parts=(*kept, *new), writers=writers, highest=self.highest + numbers)

    def groups(self) -> dict[tuple[str | None, int | None], list[Part]]:
        """Parts by day and bucket, the earliest first."""
        out: dict[tuple[str | None, int | None], list[Part]] = {}
        for part in self.parts:
            out.setdefault((part.day, part.bucket), []).append(part)
        return out


def _file(path: str, number: int) -> str:
    return f"{path}/{VERSIONS}/v{number:010d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[1:-5]) for n in children(spark, f"{path}/{VERSIONS}") if n.startswith("v")]


def _read(spark: SparkSession, path: str, number: int) -> Version:
    head, *lines = read_text(spark, _file(path, number)).splitlines()
    fields = json.loads(head)
    fields |= {name: tuple(fields[name]) for name in ("bucket_by", "keys")}
    return Version(parts=tuple(Part(**json.loads(line)) for line in lines), **fields)


def latest(spark: SparkSession, path: str) -> Version | None:
    """The version that readers see; None for a table without manifests."""
    numbers = _numbers(spark, path)
    return _read(spark, path, numbers[-1]) if numbers else None


def commit(spark: SparkSession, path: str, version: Version) -> bool:
    """Make a version the one that readers see; False if its number is taken by another load."""
    head = {"number": version.number, "buckets": version.buckets, "bucket_by": version.bucket_by, "keys": version.keys,
            "writers": version.writers, "highest": version.highest}
    text = "\n".join(json.dumps(x) for x in (head, *map(asdict, version.parts)))
    return write_new(spark, _file(path, version.number), text)


def _day(folder: str) -> str | None:
    value = folder.split("=", 1)[1]
    return None if value == _NULL else unquote(value)


def plain_parts(spark: SparkSession, path: str, partition_by: str) -> list[Part]:
    """The days of a table that has no manifest."""
    return [Part(name, _day(name), None) for name in children(spark, path) if name.startswith(f"{partition_by}=")]


def load_folder(load: str) -> str:
    """Where a load lies below its table; its name reads as a partition, so that folders of several loads read as one table."""
    return f"{LOADS}/load={load}"


def written_parts(spark: SparkSession, path: str, load: str, partition_by: str) -> list[Part]:
    """The parts that a load has written."""
    place = load_folder(load)
    return [
        Part(f"{place}/{day}/{bucket}", _day(day), int(bucket.split("=")[1]))
        for day in children(spark, f"{path}/{place}") if day.startswith(f"{partition_by}=")
        for bucket in children(spark, f"{path}/{place}/{day}") if bucket.startswith(f"{BUCKET}=")
    ]


def read_parts(spark: SparkSession, path: str, parts: Sequence[Part], schema: T.StructType) -> DataFrame:
    """The rows of some parts; partition filters still drop whole days."""
    out = None
    for base, own in ((path, [p for p in parts if p.load is None]), (f"{path}/{LOADS}", [p for p in parts if p.load is not None])):
        if own:
            folders = [f"{path}/{p.folder}" for p in own]
            rows = spark.read.schema(schema).option("basePath", base).parquet(*folders).select(*schema.names)
            out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out


def sweep(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove manifests before the latest ``keep``, and the folders that only these name."""
    numbers = _numbers(spark, path)
    if len(numbers) <= keep:
        return
    held = {p.folder for n in numbers[-keep:] for p in _read(spark, path, n).parts}
    for number in numbers[:-keep]:
        for part in _read(spark, path, number).parts:
            if part.folder not in held:
                remove(spark, f"{path}/{part.folder}")
        remove(spark, _file(path, number))
    used = {folder.split("/")[1] for folder in held if folder.startswith(f"{LOADS}/")}
    used |= {f"load={x}" for x in _read(spark, path, numbers[-1]).writers.values()}
    for folder in children(spark, f"{path}/{LOADS}"):
        # Left by loads that failed, too; one that is under way has the number of the version it will be.
        if folder not in used and int(folder.rsplit("-v", 1)[1]) <= numbers[-keep]:
            remove(spark, f"{path}/{LOADS}/{folder}")
