"""Dense numbers for new rows, in order of nothing, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_AT = "__at"
_TASK_BITS = 33  # a task numbers its rows in the lower bits


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their task and their place in it; store them before ``numbered``, which looks at them twice."""
    return rows.withColumn(_AT, F.monotonically_increasing_id())


def numbered(rows: DataFrame, column: str, after: int) -> DataFrame:
    """Stored ``marked`` rows with ``column`` as ``after`` + 1, ``after`` + 2 and so on, without a gap.

    The rows of each task are counted, one line per task, and the sums of the lines before shift its numbers.
    """
    task = F.shiftright(_AT, _TASK_BITS).alias("__task")
    sizes = rows.groupBy(task).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__task", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    place = F.col(_AT).bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    placed = rows.withColumn("__task", task).join(F.broadcast(starts), "__task")  # a line per task
    number = (F.lit(after + 1) + F.col("__start") + place).cast("long")
    return placed.withColumn(column, number).drop("__task", "__start", _AT)
