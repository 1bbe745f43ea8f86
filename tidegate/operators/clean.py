"""Nulls, types and columns of feed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegate.functions.text import normalise_reason, null_if_na, null_if_nan

CAST_ERRORS = "cast_errors"


def normalise_reasons(df: DataFrame, column: str = "qty_reason") -> DataFrame:
    return df.withColumn(column, normalise_reason(F.col(column))) if column in df.columns else df


def named_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose name is empty."""
    if all(df.columns):
        return df
    names = [c if c else f"__unnamed_{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names).select(*[n for n, c in zip(names, df.columns) if c])


def na_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts of string columns become null."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chosen = [c for c in strings if columns is None or c in columns]
    return df.withColumns({c: null_if_na(F.col(c)) for c in chosen})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of floating columns becomes null, so later operators only meet null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: null_if_nan(F.col(c)) for c in floats}) if floats else df


def _failed_casts(df: DataFrame, schema: T.StructType) -> Column:
    """Names of the columns whose value is set but does not fit ``schema``.

    A column unknown to the schema is an error, as it has no place in the table.
    """
    known = {f.name: f.dataType for f in schema}
    unknown = [c for c in df.columns if c not in known]
    if unknown:
        raise ValueError(f"columns not in the target schema: {unknown}")
    return F.array_compact(
        F.array(*[
            F.when(F.col(c).isNotNull() & F.col(c).try_cast(known[c]).isNull(), F.lit(c))
            for c in df.columns
        ]).cast("array<string>")
    )


def split_casts(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, typed, and the other rows as they came plus ``cast_errors``.

    ``keep`` columns (row order, file name) are carried along unchanged.
    """
    wider = T.StructType([*schema.fields, *[df.schema[c] for c in keep if c not in schema.names]])
    checked = df.withColumn(CAST_ERRORS, _failed_casts(df, wider))
    accepted = checked.where(F.size(CAST_ERRORS) == 0).select(
        *[F.col(c).try_cast(wider[c].dataType).alias(c) for c in df.columns]
    )
    return accepted, checked.where(F.size(CAST_ERRORS) > 0)


def typed_leniently(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows, columns typed as ``schema`` says; what does not fit becomes null."""
    known = {f.name: f.dataType for f in schema}
    return df.withColumns({c: F.col(c).try_cast(known[c]) for c in df.columns if c in known})


def infer_types(df: DataFrame) -> DataFrame:
    """Type text columns by their content: bigint, double, boolean or string.

    One aggregation over all columns decides; a whole-number column with gaps
    becomes double, an empty one double, a boolean one with gaps stays text.
    Costs a pass over the data, so a fixed schema is preferred where known.
    """
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    logical = "(?i)^(true|false)$"
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"{i}_set") for i, c in enumerate(strings)],
        *[F.count(F.col(c).try_cast("bigint")).alias(f"{i}_long") for i, c in enumerate(strings)],
        *[F.count(F.col(c).try_cast("double")).alias(f"{i}_double") for i, c in enumerate(strings)],
        *[
            F.count(F.when(F.regexp_like(F.col(c), F.lit(logical)), 1)).alias(f"{i}_bool")
            for i, c in enumerate(strings)
        ],
    ).first()

    def kind(i: int) -> str:
        filled, whole = counts[f"{i}_set"], counts[f"{i}_set"] == counts["rows"]
        if counts[f"{i}_long"] == filled and whole and filled:
            return "bigint"
        if counts[f"{i}_double"] == filled:
            return "double"
        if counts[f"{i}_bool"] == filled and whole:
            return "boolean"
        return "string"

    return df.withColumns({c: F.col(c).try_cast(kind(i)) for i, c in enumerate(strings)})
