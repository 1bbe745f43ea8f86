"""Keyed table maintenance composed from joins: upsert, insert-if-absent, append, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.duplicates import first_per_key, last_per_key
from tidegate.schema import CREATED_AT, KEY_COLUMNS, QUANTITY_COLUMNS

ACTION = "row_action"
INSERTED, UPDATED, KEPT = "inserted", "updated", "kept"


def non_negative(columns: Sequence[str] = QUANTITY_COLUMNS) -> Column:
    """Row check with SQL semantics: only a definitely negative value violates it."""
    check = F.lit(True)
    for c in columns:
        check = check & (F.col(c) >= 0)
    return F.coalesce(check, F.lit(True))


def split_check(df: DataFrame, check: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that pass the check and rows for quarantine."""
    if check is None:
        check = non_negative([c for c in QUANTITY_COLUMNS if c in df.columns])
    passes = F.coalesce(check, F.lit(True))
    return df.where(passes), df.where(~passes)


def _check_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], helpers: Sequence[str]) -> list[str]:
    if missing := [k for k in keys if k not in source.columns or k not in target.columns]:
        raise ValueError(f"key columns missing: {missing}")
    columns = [c for c in source.columns if c not in helpers or c in target.columns]
    if unknown := [c for c in columns if c not in target.columns]:
        raise ValueError(f"columns unknown to the table: {unknown}")
    return columns


def _has_key(keys: Sequence[str]) -> Column:
    return F.expr(" and ".join(f"`{k}` is not null" for k in keys))


def _as_new(rows: DataFrame, target: DataFrame, now: Column, created_at: str | None) -> DataFrame:
    """Source rows in the table's shape, absent columns defaulted."""
    def value(name: str, kind: object) -> Column:
        if name in rows.columns:
            return F.col(name).cast(kind)
        return (now if name == created_at else F.lit(None)).cast(kind)

    return rows.select(*[value(f.name, f.dataType).alias(f.name) for f in target.schema])


def upsert(
    target: DataFrame,
    source: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = KEY_COLUMNS,
    now: Column | None = None,
    created_at: str | None = CREATED_AT,
    with_action: bool = False,
) -> DataFrame:
    """The table after loading ``source``, unique on ``keys``, into ``target``.

    A matching row takes all source columns, nulls included, and keeps the
    others; the last source row by ``order_by`` wins.  A key holding a null
    matches nothing and is always inserted.  With nothing but key columns in the
    source, existing rows stay as they are.  ``with_action`` adds how each row
    came about.

    Both join sides are unique per key, so no key can be hot in the join, and
    the ranking before it leaves one row per key and map task.
    """
    keys = list(keys)
    now = F.current_timestamp() if now is None else now
    columns = _check_columns(target, source, keys, order_by)
    updates = [c for c in columns if c not in keys]
    pick = last_per_key if updates else first_per_key
    keyed = pick(source.where(_has_key(keys)), keys, order_by).select(*columns)
    keyless = _as_new(source.where(~_has_key(keys)).select(*columns), target, now, created_at)

    new = keyed.select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in updates], F.lit(True).alias("__in_source")
    )
    old = target.where(_has_key(keys)).withColumn("__in_target", F.lit(True))
    joined = old.join(new, keys, "full_outer")
    in_source, in_target = F.col("__in_source").isNotNull(), F.col("__in_target").isNotNull()

    def value(field) -> Column:
        name = field.name
        if name in keys:
            return F.col(name)
        if name in updates:
            return F.when(in_source, F.col(f"__new_{name}").cast(field.dataType)).otherwise(F.col(name))
        if name == created_at:
            return F.when(in_target, F.col(name)).otherwise(now.cast(field.dataType))
        return F.col(name)

    action = F.when(~in_target, INSERTED).when(in_source & F.lit(bool(updates)), UPDATED).otherwise(KEPT)
    merged = joined.select(*[value(f).alias(f.name) for f in target.schema], action.alias(ACTION))
    result = merged.unionByName(keyless.withColumn(ACTION, F.lit(INSERTED))).unionByName(
        target.where(~_has_key(keys)).withColumn(ACTION, F.lit(KEPT))
    )
    return result if with_action else result.drop(ACTION)


def insert_absent(
    target: DataFrame,
    source: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = KEY_COLUMNS,
    now: Column | None = None,
    created_at: str | None = CREATED_AT,
) -> DataFrame:
    """The table plus source rows whose key it lacks; the first source row of a key wins."""
    keys = list(keys)
    now = F.current_timestamp() if now is None else now
    columns = _check_columns(target, source, keys, order_by)
    keyed = first_per_key(source.where(_has_key(keys)), keys, order_by).select(*columns)
    absent = keyed.join(target.where(_has_key(keys)).select(*keys), keys, "left_anti")
    keyless = source.where(~_has_key(keys)).select(*columns)
    fresh = _as_new(absent.unionByName(keyless), target, now, created_at)
    return target.unionByName(fresh)


def append(
    target: DataFrame, source: DataFrame, order_by: Sequence[str] = (),
    now: Column | None = None, created_at: str | None = CREATED_AT, with_action: bool = False,
) -> DataFrame:
    """The table plus all source rows: what a load does without a unique key."""
    now = F.current_timestamp() if now is None else now
    columns = _check_columns(target, source, [], order_by)
    new = _as_new(source.select(*columns), target, now, created_at)
    if with_action:
        target, new = target.withColumn(ACTION, F.lit(KEPT)), new.withColumn(ACTION, F.lit(INSERTED))
    return target.unionByName(new)


def action_counts() -> list[Column]:
    """Counters for ``DataFrame.observe`` on a result that was made ``with_action``."""
    return [
        F.count_if(F.col(ACTION) == name).alias(name) for name in (INSERTED, UPDATED, KEPT)
    ]
