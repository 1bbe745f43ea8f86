"""Running sums over all rows of a table in a given order, without all rows of a group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm import common
from tidegate.session import scratch_path


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows from a fresh folder below the shared one: computed once, lineage cut."""
    rows.write.parquet(at := scratch_path(rows.sparkSession, name))
    return rows.sparkSession.read.parquet(at)


def running_sums(rows: DataFrame, order: list[Column], values: list[str]) -> DataFrame:
    """``rows``, range-sorted by ``order``, with ``before_<value>``: the sum of each value over all earlier rows.

    Each task adds up its own range; the totals of the tasks, one line each, shift it.  ``rows``
    are read twice, for the bounds of the ranges and for the sums, so they should be stored ones.
    Rows that are equal in ``order`` are told apart by their place in the input, so many equal rows
    still go to many tasks.  Nulls count as zero.
    """
    common.prepared(rows.sparkSession)
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order, "__place").sortWithinPartitions(*order, "__place").drop("__place")
    kinds = dict(rows.dtypes)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    fields += ["__part int", *(f"`before_{v}` {kinds[v]}" for v in values)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), dict.fromkeys(values, 0)
        for batch in batches:
            sums = []
            for v in values:
                own = batch.column(v).fill_null(0)
                numbers = own.to_numpy(zero_copy_only=False)
                upto = np.cumsum(numbers)
                sums.append(pa.array(upto - numbers + before[v], own.type))
                before[v] += upto[-1] if len(upto) else 0
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, *sums], [*batch.schema.names, "__part", *(f"before_{v}" for v in values)])

    added = written(placed.mapInArrow(add, ", ".join(fields)), "running")
    totals = added.groupBy("__part").agg(*(F.max(F.col(f"before_{v}") + F.coalesce(v, F.lit(0))).alias(v) for v in values))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("__part", *(F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"__base_{v}") for v in values))
    shifted = added.join(F.broadcast(bases), "__part")  # one line per task of the pass before
    return shifted.withColumns({f"before_{v}": (F.col(f"before_{v}") + F.col(f"__base_{v}")).cast(kinds[v]) for v in values}).drop(
        "__part", *(f"__base_{v}" for v in values))
