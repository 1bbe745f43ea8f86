"""The record of a micro-batch: what it is, written down before anything else is done for it.

A batch that is run again after a failure is the same batch with the same files and the same "now", whatever the
clock says by then; its loads are known by the identity that the record gives it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidegate.sources.storage import children, read_text, remove, write_new


@dataclass(frozen=True)
class BatchRecord:
    """``files``: the files that the batch delivered, each as it is read and as rows name it; ``now``: seconds since 1970."""

    place: str
    number: int
    identity: str
    now: float
    files: tuple[tuple[str, str], ...] = ()

    def note(self, spark: SparkSession, stage: str) -> object | None:
        """What was written down when the batch reached a stage; None if it has not."""
        path = f"{self.place}/{self.number}-{stage}.json"
        return json.loads(read_text(spark, path)) if path.rsplit("/", 1)[1] in children(spark, self.place) else None

    def reach(self, spark: SparkSession, stage: str, note: object = True) -> None:
        write_new(spark, f"{self.place}/{self.number}-{stage}.json", json.dumps(note))


def begin(spark: SparkSession, place: str, number: int, now: float | None = None, files: Sequence[Sequence[str]] = ()) -> BatchRecord:
    """The record of a batch, made on its first run and read on every other.

    A batch is only run again while it is the latest of its stream, so records of others in the place are removed.
    """
    name = f"{number}-record.json"
    names = children(spark, place)
    for other in names:
        if other.endswith(".json") and not other.startswith(f"{number}-"):
            remove(spark, f"{place}/{other}")
    if name not in names:
        record = {"identity": uuid.uuid4().hex, "now": time.time() if now is None else now, "files": list(files)}
        write_new(spark, f"{place}/{name}", json.dumps(record))
    held = json.loads(read_text(spark, f"{place}/{name}"))
    return BatchRecord(place, number, held["identity"], held["now"], tuple(map(tuple, held["files"])))
