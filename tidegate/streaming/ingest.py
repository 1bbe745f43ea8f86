"""Continuous ingestion: each landed file is loaded once and checked as it arrives."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from tidegate.operators import sketches
from tidegate.operators.clean import typed_leniently
from tidegate.operators.lineage import files_of
from tidegate.operators.quality import Checks, quality_report
from tidegate.plans.loads import ROW_ORDER, prepare
from tidegate.plans.recipes import Load, run_recipe
from tidegate.schema import KEY_COLUMNS, QUANTITY_COLUMNS, capacity_schema
from tidegate.sources.feed import SCAN, read_layouts, scan_order, split_surplus, with_row_index
from tidegate.sources.sidecars import read_sidecars
from tidegate.sources.soundness import check_files, literal
from tidegate.sources.tables import BUCKETS, Rewritten, merge_into, stage, staging_path, write_report
from tidegate.streaming.batches import BatchRecord, begin

BatchStep = Callable[[DataFrame, int], None]
# A file is known by its path; files of one name in two folders are two files.
PER_FILE = Checks(by="file_path", helpers=("file_name", "file_size", "file_modified", "block_start"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the query that owns a checkpoint; a new checkpoint has a new one."""
    line = spark.read.text(f"{checkpoint}/metadata").first()["value"]
    return json.loads(line)["id"]


def start(stream: DataFrame, step: BatchStep, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ``step`` per micro-batch: once over what has landed, or ``every`` interval."""
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def upsert_step(
    table: str,
    checkpoint: str,
    order_by: Sequence[str],
    keys: Sequence[str] = KEY_COLUMNS,
    schema: T.StructType | None = None,
    partition_by: str = "measure_date",
    now: float | None = None,
    buckets: int = BUCKETS,
    watch: Callable[[int, Rewritten], None] | None = None,
) -> BatchStep:
    """Upsert a micro-batch; a repeated batch is finished, never loaded twice.

    The batch is staged first: its days, its keyed and its keyless rows are then
    read from a table, and the source is scanned once.  ``watch`` is told what each batch rewrote.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        writer = stream_id(spark, checkpoint)
        place = staging_path(table, number, writer)
        record = begin(spark, place, number, now)
        rows = stage(batch, f"{place}-rows")
        stamp = F.timestamp_seconds(F.lit(record.now))
        done = merge_into(spark, table, rows, order_by, keys, schema, partition_by, stamp, number, writer, identity=record.identity, buckets=buckets)
        if watch is not None:
            watch(number, done)

    return run


@dataclass(frozen=True)
class _Outputs:
    """Where a feed stream writes, and how it treats its rows."""

    table: str
    sidecars: str
    kind: str
    keys: Sequence[str]
    reports: str | None
    quarantine: str | None
    checks: Checks
    sketches: str | None = None


def _load_rows(spark: SparkSession, out: _Outputs, record: BatchRecord, writer: str, place: str, raw: DataFrame) -> None:
    """Process staged rows of a batch, upsert them, set aside and report."""
    rows, surplus = split_surplus(with_row_index(raw))
    load = Load(sidecars=read_sidecars(spark, out.sidecars, files_of(rows)), now=record.now)
    processed = stage(run_recipe(rows, out.kind, load), f"{place}/processed")
    prepared = prepare(processed)
    stamp = F.timestamp_seconds(F.lit(record.now))
    merge_into(spark, out.table, prepared.accepted, ROW_ORDER, out.keys, now=stamp, batch=record.number, writer=writer, identity=record.identity)
    for name, frame in (("uncastable", prepared.uncastable), ("rejected", prepared.rejected), ("surplus", surplus)):
        _set_aside(out, record, writer, name, frame)
    typed = typed_leniently(processed, capacity_schema())
    if out.reports:
        write_report(quality_report(typed, out.checks), out.reports, f"{writer}-batch-{record.number}", out.checks.by)
    if out.sketches:
        numbers = [c for c in QUANTITY_COLUMNS if c in typed.columns]
        sketches.store(sketches.sketch(typed, ["file_path", "measure_date"], ["loc"], numbers), out.sketches, writer, record.number)


def _set_aside(out: _Outputs, record: BatchRecord, writer: str, name: str, frame: DataFrame) -> None:
    if out.quarantine:
        frame.write.mode("overwrite").parquet(f"{out.quarantine}/{name}/writer={writer}/batch={record.number}")


def feed_step(
    table: str,
    sidecars: str,
    checkpoint: str,
    kind: str = "capacity",
    keys: Sequence[str] = KEY_COLUMNS,
    now: float | None = None,
    reports: str | None = None,
    quarantine: str | None = None,
    checks: Checks = PER_FILE,
) -> BatchStep:
    """Process the rows of a micro-batch of ``read_feed_stream``, upsert them, and report on their quality.

    The sidecars of the batch's files are read with it, as they land together.
    Rows are staged once; every output is written under the stream's id and the
    batch number, so that a repeated batch replaces what it wrote before and no
    other stream's.  A file that breaks stops the stream; ``files_step`` goes on without it.
    """
    out = _Outputs(table, sidecars, kind, keys, reports, quarantine, checks)

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        writer = stream_id(spark, checkpoint)
        place = staging_path(table, number, writer)
        record = begin(spark, place, number, now)
        raw = stage(scan_order(batch), f"{place}-rows/raw")
        _load_rows(spark, out, record, writer, f"{place}-rows", raw)

    return run


def files_step(
    table: str,
    sidecars: str,
    checkpoint: str,
    kind: str = "capacity",
    keys: Sequence[str] = KEY_COLUMNS,
    now: float | None = None,
    reports: str | None = None,
    quarantine: str | None = None,
    checks: Checks = PER_FILE,
    sep: str = ",",
    sketch_path: str | None = None,
) -> BatchStep:
    """Like ``feed_step`` for ``read_files_stream``: the batch brings files, and each is read by its own header.

    Files are first read to their end.  One that breaks, or that is not UTF-8, is refused as a whole: the others are
    loaded, it stands in the quarantine under ``unreadable`` with its error, and the stream goes on.  Which files
    these are is written down, so a repeated batch refuses the same.  Below ``sketch_path`` the statistics of every file
    and day are kept in a form that can be merged (``operators.sketches``).
    """
    out = _Outputs(table, sidecars, kind, keys, reports, quarantine, checks, sketch_path)

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        writer = stream_id(spark, checkpoint)
        place = staging_path(table, number, writer)
        # A micro-batch's list of files is one that the stream itself holds on the driver.
        record = begin(spark, place, number, now, [list(r) for r in batch.select("path", "file_path").orderBy("path").collect()])
        urls = dict(record.files)
        refused, headers = record.note(spark, "checked") or (None, None)
        if refused is None:
            found = check_files(spark, list(urls), f"{place}-rows/checked")
            refused = {urls.get(r["file_path"], r["file_path"]): r["error"] for r in found.refused.collect()}
            headers = {r["file_path"]: r["header"] for r in found.sound.collect()}
            record.reach(spark, "checked", [refused, headers])
        _set_aside(out, record, writer, "unreadable", spark.createDataFrame(sorted(refused.items()), "file_path string, error string"))
        if not headers:
            return
        lines = spark.createDataFrame(list(headers.items()), "file_path string, header string")
        sound = [path for path, url in urls.items() if url in headers]
        raw = stage(read_layouts(spark, [literal(p) for p in sound], sep, min_bytes=0, index=SCAN, headers=lines, glob="*"), f"{place}-rows/raw")
        _load_rows(spark, out, record, writer, f"{place}-rows", raw)

    return run


def admit_once_within(stream: DataFrame, key: Sequence[str], arrival: str, ttl: str) -> DataFrame:
    """First row of a key; the key is admitted again once ``ttl`` has passed.

    State is dropped by the watermark on ``arrival``, so it stays bounded by the
    keys of one ``ttl``; expiry is exact to the micro-batch (to the microsecond: ``admit_exactly``).
    """
    return stream.withWatermark(arrival, ttl).dropDuplicatesWithinWatermark(list(key))


def admit_exactly(stream: DataFrame, key: Sequence[str], arrival: str, ttl: float, late: str) -> DataFrame:
    """First row of a key, and again every first one that arrives more than ``ttl`` seconds after the last admitted: key, ``arrival``.

    An age of exactly ``ttl`` is not admitted, the next microsecond is, also within one micro-batch.  Each key's state is
    the time it was admitted last; a timer drops it when the watermark (``late`` behind the latest arrival) has passed the
    end of its time.  Rows later than that are ignored, as are rows without an arrival.  A null key is a key.  The
    times of one key in one micro-batch are sorted in one task, eight bytes each; the size of a micro-batch bounds them.
    """
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    fields = ", ".join(f"`{k}` {kinds[k]}" for k in key)
    lifetime = round(ttl * 1e6)

    def admit(own: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = np.unique(np.concatenate([f["__at"].to_numpy(np.int64) for f in frames]))
        last, admitted = state.get[0] if state.exists else None, []
        at = 0 if last is None else int(np.searchsorted(times, last + lifetime, side="right"))
        while at < len(times):
            last = int(times[at])
            admitted.append(last)
            at = int(np.searchsorted(times, last + lifetime, side="right"))
        state.update((last,))
        state.setTimeoutTimestamp(max((last + lifetime) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({**{k: [v] * len(admitted) for k, v in zip(key, own)}, "__at": admitted})

    rows = stream.where(F.col(arrival).isNotNull()).withWatermark(arrival, late).select(*key, arrival, F.unix_micros(arrival).alias("__at"))
    found = rows.groupBy(*key).applyInPandasWithState(admit, f"{fields}, __at long", "last long", "append", "EventTimeTimeout")
    return found.select(*key, F.timestamp_micros("__at").alias(arrival))
