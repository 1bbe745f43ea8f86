"""Keyed table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from catalog import query
from catalog.views import FEED_SQL, feed, table, with_sql
from tidegate.operators import clean, upsert as up
from tidegate.operators.duplicates import collapse_duplicates, last_per_key
from tidegate.session import scratch_path
from tidegate.sources.tables import ensure_table, load, merge_into, read_table

KEYS = ["loc", "measure_date", "cycle_id"]
NOW, BEFORE = "2024-03-01 00:00:00", "2024-02-01 00:00:00"
SCHEMA = T.StructType([
    T.StructField("loc", T.StringType()),
    T.StructField("measure_date", T.DateType()),
    T.StructField("cycle_id", T.StringType()),
    T.StructField("dc", T.DoubleType()),
    T.StructField("oac", T.DoubleType()),
    T.StructField("note", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])


def now():
    return F.lit(NOW).cast("timestamp")


def readings(spark, sf_dir):
    return feed(spark, sf_dir).select(
        F.col("location").alias("loc"), F.col("date").alias("measure_date"), F.col("cycle").alias("cycle_id"),
        F.col("capacity").alias("dc"), F.col("available").alias("oac"), "note", "row_id",
    )


def loaded_before(spark, sf_dir):
    """Table content: the first twenty days, one row per key, rows without a key as they came."""
    first = readings(spark, sf_dir).where(F.col("measure_date") <= F.lit("2024-01-20").cast("date"))
    keyed = last_per_key(first.where("loc is not null"), KEYS, ["row_id"])
    rows = keyed.unionByName(first.where("loc is null"))
    return rows.drop("row_id").withColumn("created_at", F.lit(BEFORE).cast("timestamp"))


def arriving(spark, sf_dir):
    """A load that overlaps the table by eleven days and has no notes."""
    later = readings(spark, sf_dir).where(F.col("measure_date") >= F.lit("2024-01-10").cast("date"))
    return later.drop("note")


_TABLES = """,
readings as (
  select location as loc, date as measure_date, cycle as cycle_id, capacity as dc, available as oac, note, row_id from feed
),
old as (
  select loc, measure_date, cycle_id, dc, oac, note, timestamp '2024-02-01 00:00:00' as created_at
  from readings where measure_date <= date '2024-01-20' and loc is not null
  qualify row_number() over (partition by loc, measure_date, cycle_id order by row_id desc) = 1
),
old_loose as (
  select loc, measure_date, cycle_id, dc, oac, note, timestamp '2024-02-01 00:00:00' as created_at
  from readings where measure_date <= date '2024-01-20' and loc is null
),
new as (select loc, measure_date, cycle_id, dc, oac, row_id from readings where measure_date >= date '2024-01-10'),
last as (select * from new where loc is not null
  qualify row_number() over (partition by loc, measure_date, cycle_id order by row_id desc) = 1),
merged as (
  select coalesce(s.loc, t.loc) as loc, coalesce(s.measure_date, t.measure_date) as measure_date,
    coalesce(s.cycle_id, t.cycle_id) as cycle_id,
    case when s.loc is not null then s.dc else t.dc end as dc, case when s.loc is not null then s.oac else t.oac end as oac,
    t.note as note, coalesce(t.created_at, timestamp '2024-03-01 00:00:00') as created_at,
    case when t.loc is null then 'inserted' when s.loc is not null then 'updated' else 'kept' end as row_action
  from old t full join last s using (loc, measure_date, cycle_id)
  union all select *, 'kept' from old_loose
  union all select loc, measure_date, cycle_id, dc, oac, null, timestamp '2024-03-01 00:00:00', 'inserted' from new where loc is null
)
"""


@query("feed_to_table", with_sql(FEED_SQL) + _TABLES + """,
collapsed as (
  select location as loc, date as measure_date, cycle as cycle_id, max(capacity) as dc, max(available) as oac,
    arg_min(note, row_id) filter (where note is not null) as note
  from feed where location is not null and date >= date '2024-01-10' group by location, date, cycle
),
fit as (select * from collapsed where coalesce(dc >= 0 and dc - oac >= 0, true))
select coalesce(s.loc, t.loc) as loc, coalesce(s.measure_date, t.measure_date) as measure_date, coalesce(s.cycle_id, t.cycle_id) as cycle_id,
  case when s.loc is not null then s.dc else t.dc end as dc, case when s.loc is not null then s.oac else t.oac end as oac,
  case when s.loc is not null then s.note else t.note end as note,
  coalesce(t.created_at, timestamp '2024-03-01 00:00:00') as created_at
from old t full join fit s on s.loc = t.loc and s.measure_date = t.measure_date and s.cycle_id = t.cycle_id
union all select * from old_loose
""")
def feed_to_table(spark, sf_dir):
    """A load from end to end: collapse duplicates, keep rows that fit, upsert into the table."""
    late = feed(spark, sf_dir).where(F.col("date") >= F.lit("2024-01-10").cast("date")).drop("file_name")
    collapsed = collapse_duplicates(late, ["row_id"]).select(
        F.col("location").alias("loc"), F.col("date").alias("measure_date"), F.col("cycle").alias("cycle_id"),
        F.col("capacity").alias("dc"), F.col("available").alias("oac"), "note", "row_id",
    )
    accepted, _ = up.split_check(collapsed, (F.col("dc") >= 0) & (F.col("dc") - F.col("oac") >= 0))
    return up.upsert(loaded_before(spark, sf_dir), accepted, ["row_id"], KEYS, now())


@query("upsert", with_sql(FEED_SQL) + _TABLES + "select * exclude (row_action) from merged")
def upsert(spark, sf_dir):
    return up.upsert(loaded_before(spark, sf_dir), arriving(spark, sf_dir), ["row_id"], KEYS, now())


@query("upsert_actions", with_sql(FEED_SQL) + _TABLES + """
select row_action, count(*) as row_count from merged group by row_action
""")
def upsert_actions(spark, sf_dir):
    done = up.upsert(
        loaded_before(spark, sf_dir), arriving(spark, sf_dir), ["row_id"], KEYS, now(), with_action=True
    )
    return done.groupBy("row_action").agg(F.count(F.lit(1)).alias("row_count"))


@query("upsert_lineitem", """
with ranked as (
  select *, row_number() over (partition by l_linestatus, l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc,
    l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc) as r
  from lineitem
),
t as (select * from ranked where l_linestatus = 'O' and r = 1),
s as (select * from ranked where l_linestatus = 'F' and r = 1)
select coalesce(s.l_orderkey, t.l_orderkey) as l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) as l_linenumber,
  case when s.r is not null then s.l_quantity else t.l_quantity end as l_quantity,
  case when s.r is not null then s.l_shipdate else t.l_shipdate end as l_shipdate,
  t.l_partkey as l_partkey
from t full join s on s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber
""")
def upsert_lineitem(spark, sf_dir):
    """Two issues of the same lines: the second overwrites quantity and date, the part is kept."""
    keys = ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    lines = table(spark, sf_dir, "lineitem")
    target = last_per_key(lines.where("l_linestatus = 'O'"), keys, order).select(
        *keys, "l_quantity", "l_shipdate", "l_partkey"
    )
    fresh = last_per_key(lines.where("l_linestatus = 'F'"), keys, order).select(*keys, "l_quantity", "l_shipdate")
    return up.upsert(target, fresh.withColumn("line", F.lit(0)), ["line"], keys, created_at=None)


@query("insert_ignore", with_sql(FEED_SQL) + _TABLES + """,
first as (select * from new where loc is not null
  qualify row_number() over (partition by loc, measure_date, cycle_id order by row_id) = 1)
select * from old union all select * from old_loose
union all
select loc, measure_date, cycle_id, dc, oac, null, timestamp '2024-03-01 00:00:00' from first
where not exists (select 1 from old t where t.loc = first.loc and t.measure_date = first.measure_date and t.cycle_id = first.cycle_id)
union all
select loc, measure_date, cycle_id, dc, oac, null, timestamp '2024-03-01 00:00:00' from new where loc is null
""")
def insert_ignore(spark, sf_dir):
    return up.insert_absent(loaded_before(spark, sf_dir), arriving(spark, sf_dir), ["row_id"], KEYS, now())


@query("plain_append", with_sql(FEED_SQL) + _TABLES + """
select * from old union all select * from old_loose
union all select loc, measure_date, cycle_id, dc, oac, null, timestamp '2024-03-01 00:00:00' from new
""")
def plain_append(spark, sf_dir):
    return up.append(loaded_before(spark, sf_dir), arriving(spark, sf_dir), ["row_id"], now())


@query("stored_upsert", with_sql(FEED_SQL) + _TABLES + "select * exclude (row_action) from merged")
def stored_upsert(spark, sf_dir):
    """The upsert against a partitioned table on storage; only touched days are rewritten."""
    path = scratch_path(spark, "capacity")
    ensure_table(spark, path, SCHEMA)
    loaded_before(spark, sf_dir).write.mode("append").partitionBy("measure_date").parquet(path)
    merge_into(spark, path, arriving(spark, sf_dir), ["row_id"], KEYS, SCHEMA, now=now(), batch=1)
    return read_table(spark, path, SCHEMA)


@query("numbered_rows", with_sql(FEED_SQL) + _TABLES + """,
keys as (select distinct loc, measure_date, cycle_id from readings where loc is not null),
loose as (select count(*) as n from readings where loc is null)
select (select count(*) from keys) + n as row_count, 1 as least, (select count(*) from keys) + n as most,
  (select count(*) from keys) + n as numbers, 0 as changed
from loose
""")
def numbered_rows(spark, sf_dir):
    """Three loads into a table whose rows are numbered when they are inserted: no gap, none twice, none changed by an update."""
    path, day = scratch_path(spark, "numbered"), F.dayofmonth("measure_date")
    schema = T.StructType([T.StructField("id", T.LongType()), *SCHEMA.fields])
    rows = readings(spark, sf_dir)
    before = None
    for own in (rows.where(day <= 10), rows.where(day > 10), rows.where((day <= 15) & F.col("loc").isNotNull())):  # the last one updates
        before = None if before is None else read_table(spark, path, schema)
        merge_into(spark, path, own, ["row_id"], KEYS, schema, now=now(), number="id")
        before = read_table(spark, path, schema) if before is None else before
    after = read_table(spark, path, schema)
    both = after.join(before.withColumnsRenamed({"id": "old", "loc": "l", "measure_date": "m", "cycle_id": "c"}).select("old", "l", "m", "c"),
                      (F.col("loc") == F.col("l")) & (F.col("measure_date") == F.col("m")) & (F.col("cycle_id") == F.col("c")), "left")  # keys are unique
    return both.agg(F.count(F.lit(1)).alias("row_count"), F.min("id").cast("int").alias("least"), F.max("id").alias("most"), F.countDistinct("id").alias("numbers"),
                    F.count_if(F.col("id") != F.col("old")).cast("int").alias("changed"))


@query("stored_load_without_key", with_sql(FEED_SQL) + _TABLES + """
select *, 'append' as how from (
  select loc, measure_date, cycle_id, dc, oac, note, timestamp '2024-02-01 00:00:00' as created_at
  from readings where measure_date <= date '2024-01-20'
  union all select loc, measure_date, cycle_id, dc, oac, null, timestamp '2024-03-01 00:00:00' from new
)
""")
def stored_load_without_key(spark, sf_dir):
    """A table that already holds duplicate keys cannot be merged into: the load appends."""
    path = scratch_path(spark, "unkeyed")
    ensure_table(spark, path, SCHEMA)
    early = readings(spark, sf_dir).where(F.col("measure_date") <= F.lit("2024-01-20").cast("date"))
    early.drop("row_id").withColumn("created_at", F.lit(BEFORE).cast("timestamp")).write.mode("append").partitionBy("measure_date").parquet(path)
    how = load(spark, path, arriving(spark, sf_dir), ["row_id"], KEYS, SCHEMA, now=now())
    return read_table(spark, path, SCHEMA).withColumn("how", F.lit(how))


@query("check_split", """
select c_custkey, c_acctbal as dc, case when c_mktsegment = 'BUILDING' then null else cast(c_nationkey as double) - 1 end as opc,
  coalesce(c_acctbal >= 0 and (case when c_mktsegment = 'BUILDING' then null else cast(c_nationkey as double) - 1 end) >= 0, true) as accepted
from customer
""")
def check_split(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_acctbal").alias("dc"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey") - F.lit(1.0)).alias("opc"),
    )
    accepted, rejected = up.split_check(rows)
    return accepted.withColumn("accepted", F.lit(True)).unionByName(rejected.withColumn("accepted", F.lit(False)))


@query("cast_quarantine", """
select event_id, case when event_type <> 'error' then value end as dc,
  case when event_type not in ('error', 'view') then cast(ts as date) end as measure_date,
  case event_type when 'error' then 'dc,measure_date' when 'view' then 'measure_date' else '' end as problems
from events
""")
def cast_quarantine(spark, sf_dir):
    """Text columns typed for the table; rows that do not fit are set aside and named."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", F.lit("n.v.")).otherwise(F.col("value").cast("string")).alias("dc"),
        F.when(kind.isin("error", "view"), F.lit("2024-13-45"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("measure_date"),
    )
    accepted, failed = clean.split_casts(rows, SCHEMA, keep=["event_id"])
    problems = F.array_join(clean.CAST_ERRORS, ",")
    typed = failed.select(
        "event_id",
        F.col("dc").try_cast("double").alias("dc"),
        F.col("measure_date").try_cast("date").alias("measure_date"),
        problems.alias("problems"),
    )
    # "view" rows keep their valid number here only to show which column failed.
    return accepted.withColumn("problems", F.lit("")).unionByName(typed)
