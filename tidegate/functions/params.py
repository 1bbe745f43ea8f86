"""Request parameters: parsing ``key=value`` texts, lists, and their combinations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_pairs(pairs: Column) -> Column:
    """``array<string>`` of ``key=value`` to a map.

    Splits at the first ``=``, skips texts without one; the last value of a
    repeated key wins.
    """
    wellformed = F.filter(pairs, lambda p: p.contains("="))
    entries = F.transform(wellformed, lambda p: F.split(p, "=", 2))
    keys = F.transform(entries, lambda e: e[0])
    last = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e[0]),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e[0], e[1])))


def parse_list(value: Column) -> Column:
    """``[a, 1]`` to its trimmed items, any other text to one item.

    Whole numbers lose leading zeros, as if read as integers.
    """
    inner = F.substring(value, F.lit(2), F.length(value) - 2)
    items = F.transform(
        F.split(inner, ","), lambda v: F.regexp_replace(v, r"(?U)^\s+|\s+$", "")
    )
    numbers = F.transform(
        items,
        lambda v: F.when(F.regexp_like(v, F.lit("^[0-9]+$")), F.regexp_replace(v, "^0+(?=.)", "")).otherwise(v),
    )
    return F.when(is_list(value), numbers).otherwise(F.array(value))


def is_list(value: Column) -> Column:
    return (F.length(value) >= 2) & value.startswith("[") & value.endswith("]")


def combinations(params: Column) -> Column:
    """Every way to pick one value per key from ``map<string, array<string>>``.

    The product stays inside the row, so no join is needed; explode the result.
    An empty value list leaves no combination.
    """
    start = F.array(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    return F.aggregate(
        F.map_entries(params),
        start,
        lambda acc, entry: F.flatten(
            F.transform(
                acc,
                lambda chosen: F.transform(
                    entry["value"], lambda v: F.map_concat(chosen, F.create_map(entry["key"], v))
                ),
            )
        ),
    )


def first_values(params: Column) -> Column:
    """One value per key, the first of each list."""
    return F.transform_values(params, lambda _, v: F.try_element_at(v, F.lit(1)))


def non_empty(params: Column) -> Column:
    """Entries with a value; nulls and empty texts are dropped."""
    return F.map_filter(params, lambda _, v: v.isNotNull() & (v != ""))


def sorted_text(params: Column) -> Column:
    """``k=v`` of the non-empty parameters, by key, joined with ``_``."""
    entries = F.array_sort(F.map_entries(non_empty(params)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "_"
    )
