"""Gas days, date parsing and date ranges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Date texts accepted in sidecars, tried in this order.
DATE_SHAPES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
)
COMPACT_SHAPE = (r"^\d{8}$", "yyyyMMdd")


def gas_day(day: Column) -> Column:
    """``MM/DD/YYYY`` with the slashes already percent-encoded."""
    return F.date_format(day, "MM'%2F'dd'%2F'yyyy")


def parse_date(text: Column, compact: bool = True) -> Column:
    """Date for the first matching shape, else null; ``compact`` also takes yyyyMMdd."""
    shapes = DATE_SHAPES + ((COMPACT_SHAPE,) if compact else ())
    return F.coalesce(*[
        F.when(F.regexp_like(text, F.lit(shape)), F.to_date(F.try_to_timestamp(text, F.lit(pattern))))
        for shape, pattern in shapes
    ])


def epoch_date(seconds: Column) -> Column:
    """Calendar day of an epoch timestamp in the session time zone."""
    return F.to_date(F.timestamp_seconds(seconds))


def recent_days(today: Column, days: Column | int) -> Column:
    """Today and the days before it, newest first; ``days`` entries."""
    count = F.lit(days) if isinstance(days, int) else days
    return F.when(
        count > 0, F.sequence(today, F.date_sub(today, count - 1), F.expr("interval -1 day"))
    ).otherwise(F.array().cast("array<date>"))


def backfill_days(today: Column, days: Column | int) -> Column:
    """The ``days`` days before today, newest first; today itself is polled instead."""
    return recent_days(F.date_sub(today, 1), days)
