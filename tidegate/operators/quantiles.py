"""Exact quantiles per group without gathering a group's values in one task.

1. One aggregation per group: counts, and a sketch that brackets every wanted
   rank between two values.
2. One pass keeps only values inside a bracket, counted per distinct value; the
   values below it shrink to one number.  A bracket is cut into slices.
3. Running counts over the slices find the slice of each rank, running counts
   over its values the two neighbours of the rank, interpolated linearly.

A task sorts the distinct values of one slice at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import sqltext as sql
from tidegate.operators.skew import join_groups
from tidegate.session import materialise

ACCURACY = 10_000
# The sketch is off by at most one part in ACCURACY of the rows; a bracket is
# wider.  Groups below ACCURACY values are one bracket, their whole range.
_PAD = 3
SLICES = 4096


def bracket_aggregates(columns: Sequence[str], probabilities: Sequence[float], accuracy: int = ACCURACY) -> list[Column]:
    """Aggregates for step 1: non-null count and bracket ends per column."""
    ends = [p for q in probabilities for p in (max(q - _PAD / accuracy, 0.0), min(q + _PAD / accuracy, 1.0))]
    listed = ", ".join(f"{float(p)!r}D" for p in ends)
    aggregates = []
    for c in columns:
        column = sql.name(c)
        whole = ", ".join(f"min({column}), max({column})" for _ in probabilities)
        aggregates += [
            F.expr(f"count({column}) as {sql.name(f'__{c}_count')}"),
            F.expr(
                f"case when count({column}) < {accuracy} then array({whole})"
                f" else percentile_approx({column}, array({listed}), {accuracy}) end as {sql.name(f'__{c}_ends')}"
            ),
        ]
    return aggregates


def quantiles_within(
    df: DataFrame,
    brackets: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float],
    size: str,
    spread_by: Sequence[str],
    **limits: int,
) -> DataFrame:
    """Steps 2 and 3: one line per group with ``<column>_q<i>`` per probability.

    ``brackets`` must be materialised, so that both its uses agree.
    """
    by = list(by)
    needed = [c for x in columns for c in (f"__{x}_count", f"__{x}_ends")]
    spread = [c for c in spread_by if c not in by and c not in columns]
    rows = join_groups(
        df.select(*by, *columns, *spread), brackets.select(*by, size, *needed), by, size, spread_by, "inner", **limits
    )

    elements = ", ".join(_element(c, i) for c in columns for i in range(len(probabilities)))
    group = [*by, "column", "i", "total"]
    counted = (
        rows.select(*by, F.expr(f"explode(array_compact(array({elements}))) as e"))
        .select(*by, "e.*")
        .groupBy(*group, "slice", "value")
        .agg(F.expr("count(1) as n"))
    )
    wanted = " ".join(f"when {i} then {float(p)!r}D" for i, p in enumerate(probabilities))

    # The values below a bracket form its null slice, which comes first.
    slices = (
        counted.groupBy(*group, "slice")
        .agg(F.expr("sum(n) as n"))
        .withColumn("upto", _running(group, "slice"))
        .selectExpr(*map(sql.name, [*group, "slice"]), "upto", "upto - n as before",
                    f"(total - 1) * case i {wanted} end as position")
        .where("slice is not null and before <= ceil(position) and floor(position) < upto")
        .drop("upto")
    )
    spot = [*group, "slice"]
    right = {c: f"__r_{c}" for c in spot}
    # Null-safe on purpose: a plain comparison would push a filter below one of the
    # two uses of ``counted``, and the data would be read twice instead of once.
    hit = counted.join(slices.withColumnsRenamed(right), F.expr(sql.same(right))).drop(*right.values())
    ranked = hit.withColumn("upto", F.col("before") + _running([*spot, "before", "position"], "value"))

    found, results = [], []
    for c in columns:
        for i in range(len(probabilities)):
            place, result = f"column = {sql.text(c)} and i = {i}", f"{c}_q{i}"
            found.append(f"max(case when {place} then position end) as {sql.name(f'__{result}_at')}")
            for end, rank in (("lower", "floor(position)"), ("upper", "ceil(position)")):
                held = f"{place} and upto - n <= {rank} and {rank} < upto"
                found.append(f"max(case when {held} then value end) as {sql.name(f'__{result}_{end}')}")
            results.append(_interpolated(result))
    return ranked.groupBy(*by).agg(*map(F.expr, found)).selectExpr(*map(sql.name, by), *results)


def _running(over: Sequence[str], order: str) -> Column:
    partition = ", ".join(map(sql.name, over))
    return F.expr(
        f"sum(n) over (partition by {partition} order by {order} asc nulls first"
        " rows between unbounded preceding and current row)"
    )


def _element(c: str, i: int) -> str:
    """One value of column ``c`` as seen by probability ``i``: inside its bracket, below it, or nothing."""
    value, ends = f"cast({sql.name(c)} as double)", sql.name(f"__{c}_ends")
    low, high = f"cast({ends}[{2 * i}] as double)", f"cast({ends}[{2 * i + 1}] as double)"
    share = f"try_divide({value} - {low}, {high} - {low})"
    cut = f"case when {share} between 0 and 1 then floor({share} * {SLICES}) else 0 end"
    return (
        f"case when {value} <= {high} then named_struct('column', {sql.text(c)}, 'i', {i},"
        f" 'total', {sql.name(f'__{c}_count')}, 'slice', case when {value} >= {low} then {cut} end,"
        f" 'value', case when {value} >= {low} then {value} end) end"
    )


def _interpolated(result: str) -> str:
    at, lower, upper = (sql.name(f"__{result}_{x}") for x in ("at", "lower", "upper"))
    part, gap = f"({at} - floor({at}))", f"({upper} - {lower})"
    # A rank outside its bracket would mean a broken sketch: stop, do not go on with a wrong bound.
    return (
        f"case when {at} is null then null"
        f" when {lower} is null or {upper} is null then raise_error('quantile rank outside its bracket')"
        f" when {part} >= 0.5 then {upper} - {gap} * (1 - {part}) else {lower} + {gap} * {part} end"
        f" as {sql.name(result)}"
    )


def group_quantiles(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float],
    spread_by: Sequence[str],
    accuracy: int = ACCURACY,
    approximate: bool = False,
    **limits: int,
) -> DataFrame:
    """``<column>_q<i>`` per group, linear interpolation, nulls skipped.

    ``approximate`` stops after one pass with the sketch's own answers.
    """
    if approximate:
        return df.groupBy(*by).agg(
            *[
                F.percentile_approx(c, float(p), accuracy).cast("double").alias(f"{c}_q{i}")
                for c in columns
                for i, p in enumerate(probabilities)
            ]
        )
    size = "__rows"
    brackets = materialise(
        df.groupBy(*by).agg(
            F.count(F.lit(1)).alias(size), *bracket_aggregates(columns, probabilities, accuracy)
        )
    )
    found = quantiles_within(df, brackets, by, columns, probabilities, size, spread_by, **limits)
    # Groups without any value have no quantile but stay in the result.
    keys = {c: f"__g_{c}" for c in by}
    return brackets.select(*by).join(
        found.withColumnsRenamed(keys), F.expr(sql.same(keys)), "left"
    ).drop(*keys.values())
