"""Request addresses, cache keys and the table an endpoint loads into."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from tidegate.functions.dates import gas_day
from tidegate.functions.params import sorted_text


def quote_value(text: Column) -> Column:
    """Form encoding that keeps ``%`` and ``~`` and encodes ``*``."""
    encoded = F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))
    encoded = F.replace(encoded, F.lit("%7E"), F.lit("~"))
    return F.replace(encoded, F.lit("%25"), F.lit("%"))


def request_url(
    endpoint: Column,
    day: Column,
    cycle: Column | None = None,
    params: Column | None = None,
    *,
    base_url: str,
    routing_path: str = "",
    asset_id: str = "",
    fmt: str = "csv",
    search_type: str = "ALL",
) -> Column:
    """Address of one feed file; ``params`` (map of texts) override the defaults in place."""
    defaults = {
        "f": F.lit(fmt),
        "extension": F.lit(fmt),
        "asset": F.lit(asset_id),
        "gasDay": gas_day(day),
        "searchType": F.lit(search_type),
        "searchString": F.lit(""),
        "locType": F.lit("ALL"),
        "locZone": F.lit("ALL"),
    }

    def item(key: Column, value: Column) -> Column:
        return F.concat(quote_value(key), F.lit("="), quote_value(F.coalesce(value, F.lit("None"))))

    # One expression per known key, so that constant items are folded at planning.
    items = []
    for key, value in defaults.items():
        known = item(F.lit(key), value)
        if params is not None:
            known = F.when(F.map_contains_key(params, key), item(F.lit(key), params[key])).otherwise(known)
        items.append(known)
    placed = list(defaults)
    if cycle is not None:
        known = F.concat(F.lit("cycle="), cycle.cast("string"))
        if params is not None:
            known = F.when(F.map_contains_key(params, "cycle"), item(F.lit("cycle"), params["cycle"])).otherwise(known)
        items.append(known)
        placed.append("cycle")
    if params is not None:
        extra = F.filter(F.map_entries(params), lambda e: ~e["key"].isin(*placed))
        items.append(F.transform(extra, lambda e: item(e["key"], e["value"])))
    # concat_ws leaves out nulls: the cycle of a request without one.
    query = F.concat_ws("&", *items)
    return F.concat(F.lit(base_url + routing_path + asset_id), endpoint, F.lit("?"), query)


def cache_key(
    endpoint: Column,
    day: Column,
    cycle: Column | None = None,
    cycle_name: Column | None = None,
    params: Column | None = None,
) -> Column:
    """``<endpoint>_<yyyyMMdd><cycle>_<params>``; a cycle name wins over a number."""
    part = F.lit("")
    if cycle is not None:
        part = F.when(cycle.isNotNull(), F.concat(F.lit("_cycle"), cycle.cast("string"))).otherwise(part)
    if cycle_name is not None:
        named = F.concat(F.lit("_"), F.replace(F.lower(cycle_name), F.lit(" "), F.lit("_")))
        part = F.when(F.coalesce(cycle_name, F.lit("")) != "", named).otherwise(part)
    tail = F.lit("") if params is None else F.coalesce(sorted_text(params), F.lit(""))
    return F.concat(key_start(endpoint, day), part, F.lit("_"), tail)


def key_start(endpoint: Column, day: Column) -> Column:
    """The part of a cache key that all cycles of a day share."""
    return F.concat(endpoint, F.lit("_"), F.date_format(day, "yyyyMMdd"))


def cache_key_parts(key: Column) -> Column:
    """Endpoint, date text and cycle part of a key; null when it has under three parts.

    An endpoint that itself holds ``_`` is cut at its first one.
    """
    parts = F.split(key, "_")
    return F.when(
        F.size(parts) >= 3,
        F.struct(
            F.replace(parts[0], F.lit("/"), F.lit("_")).alias("endpoint"),
            F.get(parts, 1).alias("date"),
            F.get(parts, 2).alias("cycle"),
        ),
    )


def table_of_endpoint(endpoint: Column, mapping: Mapping[str, str]) -> Column:
    """Table for an endpoint: mapped as is, with ``/`` as ``_``, with ``_`` as ``-``, else derived."""
    derived = F.translate(endpoint, "/-", "__")
    if not mapping:
        return derived
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(
        table[endpoint],
        table[F.replace(endpoint, F.lit("/"), F.lit("_"))],
        table[F.replace(endpoint, F.lit("_"), F.lit("-"))],
        derived,
    )
