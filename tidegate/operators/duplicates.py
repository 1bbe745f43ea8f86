"""Duplicate keys: collapsing, counting, flagging, and last or first writer.

Null rules differ on purpose: counting and flagging treat null keys as equal,
collapsing drops them, and the keyed table (see ``upsert``) never matches them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.operators.skew import sliced_join

DEFAULT_KEYS = ("date", "cycle", "location")
DEFAULT_MAXIMA = ("capacity", "available")


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def duplicate_groups(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """Keys that occur more than once, with their row count (null = null)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One line: rows, distinct keys and surplus rows (null = null)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, distinct = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return groups.agg(
        rows.alias("row_count"), distinct.alias("distinct_keys"), (rows - distinct).alias("duplicates")
    )


def flag_duplicates(
    df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, row_id: Sequence[str] = ("row_id",),
    flag: str = "is_duplicate", **limits: int,
) -> DataFrame:
    """Mark every member of a group with more than one row (null = null).

    Counts are pre-aggregated and joined back, so a group of any size is spread
    over many tasks; a window over the keys would gather it in one.
    """
    groups = duplicate_groups(df, keys, "__n")
    marked = sliced_join(df, groups, keys, "__n", row_id, how="left", **limits)
    return marked.withColumn(flag, F.col("__n").isNotNull()).drop("__n")


def _order(columns: Sequence[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def collapse_duplicates(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = DEFAULT_KEYS,
    maxima: Sequence[str] = DEFAULT_MAXIMA,
    scope: Sequence[str] = (),
    drop_null_keys: str | bool = "auto",
) -> DataFrame:
    """One row per key: the maximum of ``maxima``, the first non-null of the rest.

    ``scope`` (a file name) keeps rows of different files apart.  Rows with a
    null key are dropped where duplicates exist and kept where none do
    (``auto``), or always dropped (True) or always kept as they are (False).
    Columns come out as scope, keys, maxima, others; partial aggregation
    shrinks hot keys before the shuffle.
    """
    keys = _present(df, keys)
    if not keys:
        return df
    scope = list(scope)
    maxima = [c for c in maxima if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in [*scope, *keys, *maxima]]
    order = _order(order_by)
    columns = [*scope, *keys, *maxima, *rest]
    keyed = df.dropna(subset=keys)
    collapsed = keyed.groupBy(*scope, *keys).agg(
        *[F.max(c).alias(c) for c in maxima],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest],
    ) if maxima or rest else keyed.distinct()
    collapsed = collapsed.select(*columns)
    if drop_null_keys is True:
        return collapsed
    any_null = ~F.expr(" and ".join(f"`{k}` is not null" for k in keys))
    loose = df.where(any_null).select(*columns)
    if drop_null_keys == "auto":
        if scope:
            sizes = df.groupBy(*scope, *keys).agg(F.count(F.lit(1)).alias("__n"))
            per_scope = sizes.groupBy(*scope).agg(F.max("__n").alias("__most"), F.sum("__n").alias("__n"))
            repeated = per_scope.where(F.col("__most") > 1).drop("__most")
            loose = sliced_join(loose, repeated, scope, "__n", order_by, how="left_anti")
        else:
            # At most one row: is there any duplicate at all?
            hit = F.broadcast(duplicate_groups(df, keys).limit(1).select(F.lit(1).alias("__hit")))
            loose = loose.join(hit, F.col("__hit") == 1, "left_anti")
    return collapsed.unionByName(loose)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row that wrote each key last.

    Spark keeps one row per key and task before the shuffle (window group
    limit), so a hot key arrives as one row per map task.
    """
    return _ranked_first(df, keys, [F.col(c).desc() for c in order_by])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row that wrote each key first."""
    return _ranked_first(df, keys, [F.col(c).asc() for c in order_by])


def _ranked_first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def seen_once(df: DataFrame, keys: Sequence[str] = ("date", "cycle")) -> DataFrame:
    """The distinct keys of ``df``: what has been requested or processed already."""
    return df.select(*keys).distinct()


def validate_unique_key(df: DataFrame, keys: Sequence[str]) -> tuple[bool, DataFrame | None]:
    """Whether ``keys`` can serve as unique key, and the groups that forbid it.

    Empty names do not count; no key or an unknown column is a plain no.
    """
    keys = [k for k in keys if k]
    if not keys or any(k not in df.columns for k in keys):
        return False, None
    offending = duplicate_groups(df, keys)
    return offending.isEmpty(), offending
