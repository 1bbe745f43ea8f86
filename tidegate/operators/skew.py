"""Joins of rows to per-group tables that hold up when one group is huge.

A group table has one line per group and the group's row count.  If it is
small, checked by counting it, it is broadcast and the rows are not shuffled.
Otherwise both sides are shuffled, and groups above ``HOT_ROWS`` rows are cut
into slices: their rows get a slice number, their single line is repeated per
slice.  The result is the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import sqltext as sql

# Rows of one group that one task may receive.
HOT_ROWS = 2_000_000
# Lists of hot groups up to this length are broadcast; a longer one is joined by a shuffle.
HOT_GROUPS = 10_000
# Group tables up to this many lines are broadcast.
BROADCAST_ROWS = 200_000

_SLICE = "__slice"


def _join(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str, small: bool) -> DataFrame:
    """Null-safe join on ``keys``; the columns of ``rows`` come first."""
    renamed = {k: f"__k_{k}" for k in keys}
    right = groups.withColumnsRenamed(renamed)
    joined = rows.join(F.broadcast(right) if small else right, F.expr(sql.same(renamed)), how)
    return joined.drop(*renamed.values())


def sliced_join(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    size: str,
    spread_by: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Shuffled join of ``rows`` to ``groups`` (unique on ``keys``), hot groups sliced.

    ``spread_by`` tells rows of one group apart, also exact copies (a row id);
    the slice depends on nothing else, so a recomputed task repeats it.
    """
    slices = F.greatest(F.ceil(F.col(size) / hot_rows), F.lit(1)).cast("int")
    hot = groups.where(F.col(size) > hot_rows).select(*keys, slices.alias("__slices"))
    few = hot.limit(HOT_GROUPS + 1).count() <= HOT_GROUPS
    marked = _join(rows, hot, keys, "left", small=few)
    cut = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("__slices"), F.lit(1))).cast("int")
    marked = marked.withColumn(_SLICE, cut).drop("__slices")
    repeated = groups.withColumn(_SLICE, F.explode(F.sequence(F.lit(0), slices - 1)))
    return _join(marked, repeated, [*keys, _SLICE], how, small=False).drop(_SLICE)


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    size: str,
    spread_by: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    lines: int | None = None,
) -> DataFrame:
    """Join rows to an already materialised group table, broadcast only if it is small.

    ``lines`` is the table's line count if the caller has counted it already.
    """
    if (groups.count() if lines is None else lines) <= broadcast_rows:
        return _join(rows, groups, keys, how, small=True)
    return sliced_join(rows, groups, keys, size, spread_by, how, hot_rows)

