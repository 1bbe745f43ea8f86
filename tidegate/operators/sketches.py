"""Statistics that are kept per file and merged over files, days and batches, without the rows.

A line holds a file's row count, a distinct-count sketch (HyperLogLog) of each column to be counted and a quantile
sketch (KLL) of each numeric one.  Merging lines gives what one pass over all their rows would.  Distinct counts of up to some
thousand values are exact but for rounding, above that the standard error is 1.04 / sqrt(2 ** ``LOG_BUCKETS``),
0.8 %; the rank of a quantile is off by at most 1 % of the rows, 99 times of 100.  Nulls count for nothing but rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Size of the sketches: 2 ** 14 buckets; items a quantile sketch keeps per level.
LOG_BUCKETS, ITEMS = 14, 400
_DISTINCT, _QUANTILES = "distinct_", "quantiles_"


def sketch(df: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """One line per group: ``by``, ``row_count`` and the sketches.  Partial sketches are merged in the shuffle, so no group is
    gathered."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        *(F.hll_sketch_agg(F.col(c).cast("string"), LOG_BUCKETS).alias(_DISTINCT + c) for c in distinct),
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), ITEMS).alias(_QUANTILES + c) for c in numbers),
    )


def _columns(df: DataFrame, prefix: str) -> list[str]:
    return [c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)]


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The lines of each group as one line, of the same form."""
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        *(F.hll_union_agg(_DISTINCT + c).alias(_DISTINCT + c) for c in _columns(sketches, _DISTINCT)),
        *(F.kll_merge_agg_double(_QUANTILES + c).alias(_QUANTILES + c) for c in _columns(sketches, _QUANTILES)),
    )


def estimates(sketches: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """What lines say: ``n_<column>``, the distinct values, and ``q_<column>``, the values at the ranks (null without values)."""
    at = F.array(*(F.lit(float(r)) for r in ranks))
    own = [c for c in sketches.columns if not c.startswith((_DISTINCT, _QUANTILES))]
    filled = {c: F.kll_sketch_get_n_double(_QUANTILES + c) > 0 for c in _columns(sketches, _QUANTILES)}
    return sketches.select(
        *own,
        *(F.hll_sketch_estimate(_DISTINCT + c).alias(f"n_{c}") for c in _columns(sketches, _DISTINCT)),
        *(F.when(some, F.kll_sketch_get_quantile_double(_QUANTILES + c, at)).alias(f"q_{c}") for c, some in filled.items()),
    )


def store(sketches: DataFrame, path: str, writer: str, batch: int) -> None:
    """Keep the lines of a load; a repeated load replaces its own."""
    sketches.write.mode("overwrite").parquet(f"{path}/writer={writer}/batch={batch}")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all loads."""
    return spark.read.parquet(path)
