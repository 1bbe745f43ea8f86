"""Which files to ask for: request grids, what is cached, what is still pending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import sqltext as sql
from tidegate.functions.cycles import ALLOWED_CYCLES, is_allowed_cycle
from tidegate.functions.dates import backfill_days
from tidegate.functions.filenames import endpoint_folder
from tidegate.functions.params import combinations
from tidegate.functions.requests import key_start
from tidegate.sources.feed import MIN_BYTES
from tidegate.sources.ledger import is_fresh, latest_entries

CYCLES = tuple(range(1, 9))
REQUEST_KEY = ("endpoint", "day", "cycle", "param_text")


def request_grid(days: DataFrame, cycles: Sequence[int] = CYCLES) -> DataFrame:
    """Every cycle for every line of ``days``."""
    return days.withColumn("cycle", F.explode(F.array(*[F.lit(c) for c in cycles])))


def backfill_grid(endpoints: DataFrame, today: Column, history: int | Column = 3, cycles: Sequence[int] = CYCLES) -> DataFrame:
    """The last ``history`` days before today, all cycles, for every line of ``endpoints``."""
    return request_grid(endpoints.withColumn("day", F.explode(backfill_days(today, history))), cycles)


def expand_params(requests: DataFrame, column: str = "params") -> DataFrame:
    """One request per combination of multi-valued parameters."""
    return requests.withColumn(column, F.explode(combinations(F.col(column))))


def not_seen(requests: DataFrame, seen: DataFrame, keys: Sequence[str] = ("day", "cycle")) -> DataFrame:
    """Requests whose key has not been handled before."""
    return requests.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def _available(manifest: DataFrame, listing: DataFrame, allowed: Sequence[str], min_bytes: int) -> DataFrame:
    """Manifest records of allowed cycles whose file is stored and not tiny."""
    identity = ["endpoint", "date", "requested_cycle", "cycle_name", "saved_filename"]
    records = (
        manifest.where(is_allowed_cycle(F.col("cycle_name"), allowed))
        .where(F.col("saved_filename") != "")
        .select(*identity)
        .distinct()
        .withColumn("folder", endpoint_folder(F.col("endpoint")))
        .withColumnRenamed("saved_filename", "file_name")
    )
    stored = listing.where(F.col("file_size") >= min_bytes).select("folder", "file_name", "file_size").distinct()
    return records.join(stored, ["folder", "file_name"])


def _fresh_keys(requests: DataFrame, ledger: DataFrame, now: float | Column, ttl: float, allowed: Sequence[str]) -> DataFrame:
    """Requests with the cycle names they may be answered by and whose ledger entry is fresh.

    A request has as many keys as there are allowed names; each is looked up in
    the ledger before any file is matched.
    """
    now = F.lit(float(now)) if isinstance(now, (int, float)) else now
    names = [
        F.struct(F.lit(a).alias("cycle_name"), F.lit(f"_{a.lower().replace(' ', '_')}_").alias("ending"))
        for a in allowed
        if a
    ]
    asked = (
        requests.select(*REQUEST_KEY)
        .withColumn("start", key_start(F.col("endpoint"), F.col("day")))
        .withColumn("date", F.substring_index("start", "_", -1))
        .withColumn("name", F.explode(F.array(*names)))
        .withColumn("cache_key", F.concat("start", "name.ending", "param_text"))
        .select(*REQUEST_KEY, "date", "name.cycle_name", "cache_key")
    )
    fresh = latest_entries(ledger).where(is_fresh(F.col("ts"), now, F.lit(float(ttl))))
    return asked.join(fresh, "cache_key")


def _answers(asked: DataFrame, available: DataFrame, how: str) -> DataFrame:
    """Match by endpoint, day, cycle name and the cycle number asked for.

    Each file also stands under a null number, which is what a request for any
    cycle asks for: one equi-join serves both kinds of request.
    """
    either = F.explode(F.array("requested_cycle", F.lit(None).cast("int")))
    offered = available.withColumn("requested_cycle", either).distinct()
    keys = {"endpoint": "__endpoint", "date": "__date", "cycle_name": "__cycle_name", "cycle": "requested_cycle"}
    renamed = {k: v for k, v in keys.items() if k != "cycle"}
    return asked.join(offered.withColumnsRenamed(renamed), F.expr(sql.same(keys)), how)


def cached_files(
    requests: DataFrame,
    manifest: DataFrame,
    ledger: DataFrame,
    listing: DataFrame,
    now: float | Column,
    ttl: float,
    allowed: Sequence[str] = ALLOWED_CYCLES,
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """The stored files that answer a request.

    ``requests``: endpoint, day, cycle (null for any), param_text.
    ``manifest``: sidecar records; ``ledger``: cache_key, ts; ``listing``:
    folder, file_name, file_size.  A file counts if its cycle is allowed, its
    ledger entry is not older than ``ttl`` seconds, and it is stored and not tiny.
    """
    asked = _fresh_keys(requests, ledger, now, ttl, allowed)
    matched = _answers(asked, _available(manifest, listing, allowed, min_bytes), "inner")
    return matched.select(
        *REQUEST_KEY, "cycle_name", "folder", "file_name", "file_size", "cache_key", "ts"
    )


def pending_requests(
    requests: DataFrame,
    manifest: DataFrame,
    ledger: DataFrame,
    listing: DataFrame,
    now: float | Column,
    ttl: float,
    allowed: Sequence[str] = ALLOWED_CYCLES,
    min_bytes: int = MIN_BYTES,
    caching: bool = True,
) -> DataFrame:
    """Requests no cached file answers; with ``caching`` off all of them.

    Only asks whether an answer exists, so files are not listed per request.
    """
    if not caching:
        return requests
    kinds = _available(manifest, listing, allowed, min_bytes).select(
        "endpoint", "date", "cycle_name", "requested_cycle"
    ).distinct()
    answered = _answers(_fresh_keys(requests, ledger, now, ttl, allowed), kinds, "left_semi")
    renamed = {k: f"__{k}" for k in REQUEST_KEY}
    done = answered.select(*REQUEST_KEY).distinct().withColumnsRenamed(renamed)
    return requests.join(done, F.expr(sql.same(renamed)), "left_anti")
