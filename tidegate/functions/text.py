"""Text clean-up of feed columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNAVAILABLE = "Unavailable"

# Field texts that stand for a missing value, the defaults of pandas.read_csv.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalise_reason(reason: Column) -> Column:
    """Any wording with "unavailable" becomes one literal; null stays null."""
    return F.when(F.lower(reason).contains("unavailable"), F.lit(UNAVAILABLE)).otherwise(reason)


def null_if_na(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def null_if_nan(number: Column) -> Column:
    return F.when(~F.isnan(number), number)
