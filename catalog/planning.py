"""Request planning over downloads derived from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import table
from tidegate.functions.filenames import endpoint_folder
from tidegate.functions.requests import cache_key
from tidegate.plans import requests as plan
from tidegate.session import materialise, scratch_path
from tidegate.sources.ledger import append_ledger, compact_ledger, fresh_entries, latest_entries, read_ledger
from tidegate.sources.sidecars import accepted_responses

# 2000-01-01 and two years in seconds.
NOW, TTL = 946684800.0, 2 * 365 * 86400.0


def downloads(spark, sf_dir):
    """Every order as a downloaded file: endpoint by priority, cycle by customer, name by status."""
    key = F.col("o_custkey").cast("string")
    name = F.when(F.col("o_orderstatus") == "O", "Intraday 1").when(F.col("o_orderstatus") == "F", "Evening").otherwise("Timely")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("zone/"), "o_orderpriority").alias("endpoint"),
        F.to_date("o_orderdate").alias("day"),
        F.substring(key, 1, 1).cast("int").alias("requested_cycle"),
        name.alias("cycle_name"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
        F.concat(F.lit("oac_"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("saved_filename"),
        (seconds + F.col("o_custkey")).cast("double").alias("download_timestamp"),
        F.col("o_custkey").alias("file_size"),
    )


def _parts(spark, sf_dir):
    done = downloads(spark, sf_dir)
    ledger = done.select(
        cache_key(F.col("endpoint"), F.col("day"), cycle_name=F.col("cycle_name")).alias("cache_key"),
        F.col("download_timestamp").alias("ts"),
    )
    listing = done.select(endpoint_folder(F.col("endpoint")).alias("folder"), F.col("saved_filename").alias("file_name"), "file_size")
    grid = plan.request_grid(done.select("endpoint", "day").distinct().withColumn("param_text", F.lit("")))
    anything = done.select("endpoint", "day").distinct().select(
        "endpoint", "day", F.lit("").alias("param_text"), F.lit(None).cast("int").alias("cycle")
    )
    return grid.unionByName(anything), done, ledger, listing


_DOWNLOADS = """
with downloads as (
  select concat('zone/', o_orderpriority) as endpoint, cast(o_orderdate as date) as day,
    cast(cast(o_custkey as varchar)[1] as integer) as requested_cycle,
    case o_orderstatus when 'O' then 'Intraday 1' when 'F' then 'Evening' else 'Timely' end as cycle_name,
    concat('oac_', o_orderkey, '.csv') as file_name, epoch(o_orderdate) + o_custkey as ts, o_custkey as file_size
  from orders
),
keyed as (
  select *, concat(endpoint, '_', strftime(day, '%Y%m%d'), '_', replace(lower(cycle_name), ' ', '_'), '_') as cache_key from downloads
),
ledger as (select cache_key, cast(max(ts) as double) as ts from keyed group by cache_key),
fresh as (select * from ledger where 946684800 - ts <= 63072000),
grid as (
  select endpoint, day, '' as param_text, cast(c as integer) as cycle
  from (select distinct endpoint, day from downloads), unnest(range(1, 9)) t(c)
  union all select distinct endpoint, day, '', null from downloads
),
usable as (
  select k.*, f.ts as fresh_ts from keyed k join fresh f on f.cache_key = k.cache_key where k.cycle_name <> 'Timely' and k.file_size >= 200
),
offers as (  -- cycle 0: a request for any cycle
  select *, requested_cycle as offered from usable union all select *, 0 as offered from usable
),
asked as (select *, coalesce(cycle, 0) as wanted from grid),
cached as (
  select g.endpoint, g.day, g.cycle, g.param_text, d.cycle_name, replace(d.endpoint, '/', '_') as folder, d.file_name,
    d.file_size, d.cache_key, d.fresh_ts as ts
  from asked g join offers d on d.endpoint = g.endpoint and d.day = g.day and d.offered = g.wanted
),
answered as (select distinct endpoint, day, offered from offers)
"""


@query("request_grid", _DOWNLOADS + "select * from grid where cycle is not null")
def request_grid(spark, sf_dir):
    days = downloads(spark, sf_dir).select("endpoint", "day").distinct().withColumn("param_text", F.lit(""))
    return plan.request_grid(days)


@query("cached_files", _DOWNLOADS + "select * from cached")
def cached_files(spark, sf_dir):
    asked, manifest, ledger, listing = _parts(spark, sf_dir)
    return plan.cached_files(asked, manifest, ledger, listing, NOW, TTL)


@query("pending_requests", _DOWNLOADS + """
select endpoint, day, param_text, cycle from asked g
where not exists (select 1 from answered a where a.endpoint = g.endpoint and a.day = g.day and a.offered = g.wanted)
""")
def pending_requests(spark, sf_dir):
    asked, manifest, ledger, listing = _parts(spark, sf_dir)
    return plan.pending_requests(asked, manifest, ledger, listing, NOW, TTL)


@query("fresh_ledger", _DOWNLOADS + "select * from fresh")
def fresh_ledger(spark, sf_dir):
    _, _, ledger, _ = _parts(spark, sf_dir)
    return fresh_entries(latest_entries(ledger), NOW, TTL)


@query("backfill_requests", """
with days as (select distinct o_orderpriority as endpoint, cast(o_orderdate as date) as today from orders),
grid as (
  select endpoint, today, today - cast(i as integer) as day, cast(c as integer) as cycle
  from days, unnest(range(1, 4)) t(i), unnest(range(1, 9)) u(c)
)
select * from grid g where not exists (
  select 1 from orders o where cast(o.o_orderdate as date) = g.day and cast(cast(o.o_custkey as varchar)[1] as integer) = g.cycle)
""")
def backfill_requests(spark, sf_dir):
    """From every order day the three days before it, all cycles, unless that day and cycle was seen."""
    orders = table(spark, sf_dir, "orders")
    today = orders.select(F.col("o_orderpriority").alias("endpoint"), F.to_date("o_orderdate").alias("today")).distinct()
    seen = downloads(spark, sf_dir).select("day", F.col("requested_cycle").alias("cycle"))
    return plan.not_seen(plan.backfill_grid(today, F.col("today"), 3), seen)


@query("accepted_responses", """
with answered as (
  select *, case o_orderstatus when 'O' then concat('oac intraday ', o_custkey, '.csv')
      when 'F' then concat('C:\\out\\oac_EVENING:', o_custkey, '.csv')
      else concat('zone_', o_orderpriority, '_', strftime(o_orderdate, '%Y%m%d'), '.csv') end as original_filename
  from orders
),
named as (
  select *, case when o_orderstatus = 'F' then 'Evening'
    when o_orderstatus = 'O' and cast(o_custkey as varchar)[1] in ('1', '2', '3') then concat('Intraday ', cast(o_custkey as varchar)[1])
    end as cycle_name
  from answered
)
select concat('zone/', o_orderpriority) as endpoint, cast(length(cast(o_custkey as varchar)) as integer) as requested_cycle, cycle_name,
  strftime(o_orderdate, '%Y%m%d') as date, original_filename,
  case o_orderstatus when 'F' then concat('oac_EVENING_', o_custkey, '.csv') else original_filename end as saved_filename,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') as download_time, cast(epoch(o_orderdate) as double) as download_timestamp
from named where cycle_name is not null and o_custkey >= 200
""")
def accepted_responses_query(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    header = F.when(
        F.col("o_orderstatus") == "O", F.concat(F.lit('attachment; filename="oac intraday '), key, F.lit('.csv"'))
    ).when(F.col("o_orderstatus") == "F", F.concat(F.lit('attachment; filename="C:\\out\\oac_EVENING:'), key, F.lit('.csv"')))
    answered = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("zone/"), "o_orderpriority").alias("endpoint"),
        F.length(key).alias("requested_cycle"),
        F.to_date("o_orderdate").alias("day"),
        header.alias("disposition"),
        F.col("o_custkey").alias("content_length"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("received"),
    )
    return accepted_responses(answered)


@query("compacted_ledger", _DOWNLOADS + "select * from fresh")
def compacted_ledger(spark, sf_dir):
    """A ledger appended to in three loads and compacted in between: what is left, without a filter, is what is fresh."""
    _, done, ledger, _ = _parts(spark, sf_dir)
    path, entries = scratch_path(spark, "ledger"), materialise(ledger)
    for third in range(3):
        append_ledger(entries.where(F.pmod(F.xxhash64("cache_key", "ts"), F.lit(3)) == third), path)
        if third != 1:
            compact_ledger(spark, path, NOW, TTL)
    return read_ledger(spark, path)
