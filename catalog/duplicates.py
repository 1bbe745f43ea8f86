"""Duplicate handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import FEED_SQL, feed, table, with_sql
from tidegate.operators import duplicates as dup

KEYS = list(dup.DEFAULT_KEYS)


@query("dedup_collapse", with_sql(FEED_SQL) + """
select date, cycle, location, max(capacity) as capacity, max(available) as available,
  min(row_id) as row_id, min(file_name) as file_name,
  arg_min(note, row_id) filter (where note is not null) as note
from feed where date is not null and cycle is not null and location is not null
group by date, cycle, location
""")
def dedup_collapse(spark, sf_dir):
    return dup.collapse_duplicates(feed(spark, sf_dir), ["row_id"])


@query("dedup_collapse_per_file", with_sql(FEED_SQL) + """,
grouped as (select file_name, date, location, count(*) as n from feed group by all),
files as (select file_name, max(n) > 1 as repeated from grouped group by file_name),
collapsed as (
  select file_name, date, location, max(capacity) as capacity, max(available) as available,
    min(row_id) as row_id, min(cycle) as cycle, arg_min(note, row_id) filter (where note is not null) as note
  from feed where date is not null and location is not null group by file_name, date, location
)
select * from collapsed
union all
select f.file_name, date, location, capacity, available, row_id, cycle, note
from feed f join files using (file_name) where not repeated and (date is null or location is null)
""")
def dedup_collapse_per_file(spark, sf_dir):
    return dup.collapse_duplicates(feed(spark, sf_dir), ["row_id"], keys=["date", "location"], scope=["file_name"])


@query("dedup_keep_null_keys", with_sql(FEED_SQL) + """
select date, cycle, location, max(capacity) as capacity, max(available) as available, min(row_id) as row_id
from feed where location is not null group by date, cycle, location
union all
select date, cycle, location, capacity, available, row_id from feed where location is null
""")
def dedup_keep_null_keys(spark, sf_dir):
    rows = feed(spark, sf_dir).select(*KEYS, "capacity", "available", "row_id")
    return dup.collapse_duplicates(rows, ["row_id"], drop_null_keys=False)


@query("key_counts", with_sql(FEED_SQL) + """
select cast(sum(n) as bigint) as row_count, count(*) as distinct_keys,
  cast(sum(n) - count(*) as bigint) as duplicates
from (select count(*) as n from feed group by date, cycle, location)
""")
def key_counts(spark, sf_dir):
    return dup.key_counts(feed(spark, sf_dir), KEYS)


@query("dup_groups", with_sql(FEED_SQL) + """
select date, cycle, location, count(*) as n from feed group by date, cycle, location having count(*) > 1
""")
def dup_groups(spark, sf_dir):
    return dup.duplicate_groups(feed(spark, sf_dir), KEYS)


@query("dup_members", with_sql(FEED_SQL) + """
select row_id, count(*) over (partition by date, cycle, location) > 1 as is_duplicate from feed
""")
def dup_members(spark, sf_dir):
    return dup.flag_duplicates(feed(spark, sf_dir), KEYS).select("row_id", "is_duplicate")


_LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


def _line_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""
select * from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by {order}) = 1
"""


@query("last_writer", _line_sql("desc"))
def last_writer(spark, sf_dir):
    return dup.last_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query("first_writer", _line_sql("asc"))
def first_writer(spark, sf_dir):
    return dup.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)


@query("seen_set", "select distinct cast(ts as date) as date, event_type as cycle from events")
def seen_set(spark, sf_dir):
    return dup.seen_once(feed(spark, sf_dir))


@query("unique_key_check", """
select l_orderkey, l_linenumber, count(*) as n, false as usable
from lineitem group by l_orderkey, l_linenumber having count(*) > 1
""")
def unique_key_check(spark, sf_dir):
    usable, offending = dup.validate_unique_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return offending.withColumn("usable", F.lit(usable))
