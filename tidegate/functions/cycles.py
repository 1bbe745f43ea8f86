"""Nomination cycles: names found in file names, allowed names, expected names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidegate.functions.filenames import basename, bind

# The cycle names a feed may carry.
INTRADAY_1 = "Intraday 1"
INTRADAY_2 = "Intraday 2"
INTRADAY_3 = "Intraday 3"
TIMELY = "Timely"
EVENING = "Evening"
FINAL = "Final"
UNKNOWN_CYCLE = "Unknown_Cycle"
ALLOWED_CYCLES = (INTRADAY_1, INTRADAY_2, INTRADAY_3, EVENING)


def cycle_of_filename(name: Column) -> Column:
    """The cycle a file name stands for, or null.

    One digit follows ``intraday``; anything but 1 to 3 falls through to the
    other names.
    """
    def named(base: Column) -> Column:
        digit = F.right(F.regexp_substr(base, F.lit(r"(?U)intraday\s*\d")), F.lit(1))
        return (
            F.when(base.contains("intraday") & digit.isin("1", "2", "3"), F.concat(F.lit("Intraday "), digit))
            .when(base.contains("timely"), F.lit(TIMELY))
            .when(base.contains("evening"), F.lit(EVENING))
            .when(base.contains("final"), F.lit(FINAL))
        )

    return bind(F.lower(basename(name)), named)


def intraday_label(name: Column) -> Column:
    """``Intraday <digits>`` with every digit kept, or null; used for lineage."""
    found = F.regexp_substr(F.lower(name), F.lit(r"(?U)intraday\s*\d+"))
    return F.regexp_replace(found, r"(?U)^intraday\s*", "Intraday ")


def cycle_id(cycle_name: Column) -> Column:
    return F.replace(cycle_name, F.lit(" "), F.lit("_"))


def is_allowed_cycle(cycle_name: Column, allowed: Sequence[str] = ALLOWED_CYCLES) -> Column:
    """True for names in ``allowed``; null and empty names are never allowed."""
    named = [a for a in allowed if a]
    return F.coalesce(cycle_name.isin(*named), F.lit(False)) if named else F.lit(False)


def expected_cycles(ts: Column) -> Column:
    """The cycles that should have been published by the hour of ``ts``."""
    hour = F.hour(ts)

    def names(*values: str) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return (
        F.when(hour.between(15, 19), names(INTRADAY_1))
        .when(hour.between(20, 22), names(INTRADAY_1, INTRADAY_2))
        .when((hour == 23) | (hour < 3), names(INTRADAY_1, INTRADAY_2, INTRADAY_3, EVENING))
        .otherwise(names())
    )
