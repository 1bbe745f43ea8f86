"""Scalar expressions over file names, dates, parameters and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.views import NAMES_SQL, names, table, with_sql
from tidegate.functions import cycles, dates, filenames, numbers, params, requests, text
from tidegate.operators.clean import normalise_reasons
from tidegate.plans.requests import expand_params
from tidegate.sources.sidecars import parse_sidecars

_CYCLE_SQL = """,
based as (select *, lower(regexp_extract(name, '[^/]*$')) as base from names),
digits as (select *, regexp_extract(base, 'intraday\\s*([0-9]+)', 1) as digits from based),
labelled as (
  select *, case when digits[1] in ('1', '2', '3') then concat('Intraday ', digits[1])
    when contains(base, 'timely') then 'Timely' when contains(base, 'evening') then 'Evening'
    when contains(base, 'final') then 'Final' end as cycle_name
  from digits
)
"""


@query("cycle_name", with_sql(NAMES_SQL) + _CYCLE_SQL + """
select o_orderkey, name, cycle_name, case when digits <> '' then concat('Intraday ', digits) end as lineage_cycle,
  replace(cycle_name, ' ', '_') as cycle_id,
  coalesce(cycle_name in ('Intraday 1', 'Intraday 2', 'Intraday 3', 'Evening'), false) as allowed
from labelled
""")
def cycle_name(spark, sf_dir):
    found = names(spark, sf_dir).withColumn("cycle_name", cycles.cycle_of_filename(F.col("name")))
    return found.select(
        "o_orderkey", "name", "cycle_name",
        cycles.intraday_label(F.col("name")).alias("lineage_cycle"),
        cycles.cycle_id(F.col("cycle_name")).alias("cycle_id"),
        cycles.is_allowed_cycle(F.col("cycle_name")).alias("allowed"),
    )


@query("allowed_cycles", with_sql(NAMES_SQL) + _CYCLE_SQL + """
select o_orderkey, cycle_name from labelled where cycle_name in ('Intraday 1', 'Intraday 2', 'Intraday 3', 'Evening')
""")
def allowed_cycles(spark, sf_dir):
    found = names(spark, sf_dir).select(
        "o_orderkey", cycles.cycle_of_filename(F.col("name")).alias("cycle_name")
    )
    return found.where(cycles.is_allowed_cycle(F.col("cycle_name")))


@query("expected_cycles", """
select event_id, unnest(case when hour(ts) between 15 and 19 then ['Intraday 1']
  when hour(ts) between 20 and 22 then ['Intraday 1', 'Intraday 2']
  when hour(ts) = 23 or hour(ts) < 3 then ['Intraday 1', 'Intraday 2', 'Intraday 3', 'Evening'] else [] end) as cycle
from events
""")
def expected_cycles(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.explode(cycles.expected_cycles(F.col("ts"))).alias("cycle"))


@query("sanitize_filename", """
with raw as (
  select o_orderkey, o_custkey, case
    when o_orderstatus = 'O' then concat('in/', o_orderpriority, ':', o_custkey, '?.csv')
    when o_orderstatus = 'F' then concat('C:\\in\\', o_orderpriority, '*"', o_custkey, '|.csv')
    when o_orderpriority like '5%' then '' when o_orderpriority like '4%' then null
    else concat('in/.', o_custkey) end as raw
  from orders
)
select o_orderkey, case when raw is null or raw = '' then 'unnamed_file.csv'
  when raw like 'in/.%' then concat('unnamed_', o_custkey, '.csv')
  else regexp_replace(regexp_extract(raw, '[^/\\\\]*$'), '[<>:"/|?*]', '_', 'g') end as saved
from raw
""")
def sanitize_filename(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    raw = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("in/"), "o_orderpriority", F.lit(":"), key, F.lit("?.csv")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("C:\\in\\"), "o_orderpriority", F.lit('*"'), key, F.lit("|.csv")))
        .when(F.col("o_orderpriority").startswith("5"), F.lit(""))
        .when(F.col("o_orderpriority").startswith("4"), F.lit(None))
        .otherwise(F.concat(F.lit("in/."), key))
    )
    saved = filenames.safe_filename(raw, F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", saved.alias("saved"))


@query("file_stems", with_sql(NAMES_SQL) + """,
based as (select *, regexp_extract(name, '[^/]*$') as base from names)
select o_orderkey, base as file_name, regexp_replace(base, '\\.csv$', '') as stem,
  regexp_replace(base, '\\.csv$', '.meta.json') as sidecar,
  replace(concat('zone/', o_orderpriority), '/', '_') as folder
from based
""")
def file_stems(spark, sf_dir):
    name = F.col("name")
    return names(spark, sf_dir).select(
        "o_orderkey",
        filenames.basename(name).alias("file_name"),
        filenames.stem(name).alias("stem"),
        filenames.sidecar_name(name).alias("sidecar"),
        filenames.endpoint_folder(F.concat(F.lit("zone/"), "o_orderpriority")).alias("folder"),
    )


@query("response_filename", """
select o_orderkey, case o_orderstatus when 'F' then concat('oac_EVENING_', o_custkey, '.csv')
  when 'O' then concat('oac intraday ', o_custkey, '.csv')
  else concat('zone_', o_orderpriority, '_', strftime(o_orderdate, '%Y%m%d'), '.csv') end as file_name
from orders
""")
def response_filename(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    header = F.when(
        F.col("o_orderstatus") == "F", F.concat(F.lit('attachment; filename="oac_EVENING_'), key, F.lit('.csv"'))
    ).when(F.col("o_orderstatus") == "O", F.concat(F.lit("attachment; filename=oac intraday "), key, F.lit(".csv")))
    name = filenames.filename_of_response(header, F.concat(F.lit("zone/"), "o_orderpriority"), F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name"))


@query("filename_date", """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as date_text, cast(o_orderdate as date) as day from orders
""")
def filename_date(spark, sf_dir):
    found = filenames.date_text_of_filename(F.col("name"))
    return names(spark, sf_dir).select("o_orderkey", found.alias("date_text"), found.try_cast("date").alias("day"))


@query("gas_day", "select o_orderkey, strftime(o_orderdate, '%m%%2F%d%%2F%Y') as gas_day from orders")
def gas_day(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.gas_day(F.col("o_orderdate")).alias("gas_day"))


@query("date_ranges", """
select o_orderkey, 'recent' as kind, cast(o_orderdate as date) - cast(i as integer) as day
from orders, unnest(range(0, 3)) t(i)
union all
select o_orderkey, 'backfill', cast(o_orderdate as date) - cast(i as integer) from orders, unnest(range(1, 4)) t(i)
""")
def date_ranges(spark, sf_dir):
    day = F.to_date("o_orderdate")
    kinds = F.array(
        F.struct(F.lit("recent").alias("kind"), dates.recent_days(day, 3).alias("days")),
        F.struct(F.lit("backfill").alias("kind"), dates.backfill_days(day, 3).alias("days")),
    )
    listed = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(kinds).alias("k"))
    return listed.select("o_orderkey", "k.kind", F.explode("k.days").alias("day"))


@query("parse_dates", """
select o_orderkey, case when o_orderpriority = '5-LOW' then null else cast(o_orderdate as date) end as day,
  case when o_orderpriority = '5-LOW' or (o_orderpriority <> '1-URGENT' and o_orderstatus = 'P') then null
    else cast(o_orderdate as date) end as strict_day
from orders
""")
def parse_dates(spark, sf_dir):
    def as_text(pattern):
        return F.date_format("o_orderdate", pattern)

    written = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("soon"))
        .when(F.col("o_orderpriority") == "1-URGENT", as_text("d-M-yyyy"))
        .when(F.col("o_orderstatus") == "O", as_text("yyyy-M-d"))
        .when(F.col("o_orderstatus") == "F", as_text("M/d/yyyy"))
        .otherwise(as_text("yyyyMMdd"))
    )
    # d-M-yyyy reads as written only by the third shape, which the first two leave alone.
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.parse_date(written).alias("day"),
        dates.parse_date(written, compact=False).alias("strict_day"),
    )


@query("epoch_day", "select event_id, cast(ts as date) as day from events")
def epoch_day(spark, sf_dir):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, sf_dir, "events").select("event_id", dates.epoch_date(seconds).alias("day"))


_URL_SQL = """
with asked as (
  select *, concat('zone/', lower(replace(o_orderpriority, ' ', '-'))) as endpoint,
    case when o_orderstatus <> 'P' then cast(o_custkey as varchar)[1] end as cycle,
    concat(o_orderpriority, ' & 100% /', o_custkey, '=é') as note
  from orders
)
select o_orderkey, concat('https://feeds.example.org/api/A1/', endpoint, '?f=csv&extension=csv&asset=A1%2F&gasDay=',
  strftime(o_orderdate, '%m%%2F%d%%2F%Y'), '&searchType=NOM&searchString=&locType=ALL&locZone=',
  replace(url_encode(o_orderpriority), '%20', '+'),
  case when cycle is not null then concat('&cycle=', cycle) else '' end, '&note=',
  replace(replace(url_encode(note), '%20', '+'), '%25', '%')) as url
from asked
"""


@query("build_url", _URL_SQL)
def build_url(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    note = F.concat("o_orderpriority", F.lit(" & 100% /"), key, F.lit("=é"))
    chosen = F.create_map(
        F.lit("searchType"), F.array(F.lit("NOM"), F.lit("ALL")),
        F.lit("locZone"), F.array("o_orderpriority"),
        F.lit("note"), F.array(note),
    )
    url = requests.request_url(
        F.concat(F.lit("zone/"), F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit("-")))),
        F.col("o_orderdate"),
        F.when(F.col("o_orderstatus") != "P", F.substring(key, 1, 1).cast("int")),
        params.first_values(chosen),
        base_url="https://feeds.example.org", routing_path="/api/", asset_id="A1/",
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", url.alias("url"))


_KEY_SQL = """
with keyed as (
  select o_orderkey, concat('zone/', o_orderpriority, '_', strftime(o_orderdate, '%Y%m%d'),
    case o_orderstatus when 'F' then '_evening_cycle' when 'O' then concat('_cycle', length(cast(o_custkey as varchar))) else '' end,
    '_', 'loc=', o_custkey, '_zone=', o_orderpriority) as cache_key
  from orders
)
"""


def _keyed(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    given = F.create_map(
        F.lit("zone"), F.col("o_orderpriority"), F.lit("loc"), key, F.lit("empty"), F.lit(""),
        F.lit("none"), F.lit(None).cast("string"),
    )
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        requests.cache_key(
            F.concat(F.lit("zone/"), "o_orderpriority"),
            F.col("o_orderdate"),
            F.when(status != "P", F.length(key)),
            F.when(status == "F", F.lit("Evening Cycle")).when(status == "O", F.lit("")),
            given,
        ).alias("cache_key"),
    )


@query("cache_key", _KEY_SQL + "select * from keyed")
def cache_key(spark, sf_dir):
    return _keyed(spark, sf_dir)


@query("cache_key_parts", _KEY_SQL + """
select o_orderkey, replace(split_part(cache_key, '_', 1), '/', '_') as endpoint, split_part(cache_key, '_', 2) as date,
  split_part(cache_key, '_', 3) as cycle
from keyed
""")
def cache_key_parts(spark, sf_dir):
    return _keyed(spark, sf_dir).select(
        "o_orderkey", requests.cache_key_parts(F.col("cache_key")).alias("p")
    ).select("o_orderkey", "p.*")


@query("param_pairs", """
select p_partkey, 'brand' as key, p_type as value from part
union all select p_partkey, 'name', concat('a=', p_name) from part
union all select p_partkey, '', p_brand from part
""")
def param_pairs(spark, sf_dir):
    pairs = F.array(
        F.concat(F.lit("brand="), "p_brand"), F.col("p_type"), F.concat(F.lit("name=a="), "p_name"),
        F.concat(F.lit("brand="), "p_type"), F.concat(F.lit("="), "p_brand"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(params.parse_pairs(pairs)))


@query("param_lists", """
with listed as (
  select p_partkey, case when p_type = 'ECONOMY' then [p_name]
    else [cast(p_size as varchar), p_brand, cast(p_size as varchar), '']  end as items
  from part
)
select p_partkey, unnest(range(0, len(items))) as pos, unnest(items) as item from listed
""")
def param_lists(spark, sf_dir):
    size = F.col("p_size").cast("string")
    given = F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(
        F.concat(F.lit("["), size, F.lit(", "), "p_brand", F.lit(" ,  00"), size, F.lit(",]"))
    )
    items = F.posexplode(params.parse_list(given)).alias("pos", "item")
    return table(spark, sf_dir, "part").select("p_partkey", items).withColumn("pos", F.col("pos").cast("bigint"))


@query("param_combinations", """
select p_partkey, concat('brand=', b, '_size=', p_size, '_zone=', z) as combination
from part, unnest([p_brand, p_type]) t(b), unnest(['N', 'S', p_name]) u(z)
""")
def param_combinations(spark, sf_dir):
    given = F.create_map(
        F.lit("zone"), F.array(F.lit("N"), F.lit("S"), F.col("p_name")),
        F.lit("size"), F.array(F.col("p_size").cast("string")),
        F.lit("brand"), F.array("p_brand", "p_type"),
        F.lit("empty"), F.array(F.lit("")),
    )
    asked = expand_params(table(spark, sf_dir, "part").select("p_partkey", given.alias("params")))
    return asked.select("p_partkey", params.sorted_text(F.col("params")).alias("combination"))


@query("table_name", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 'urgent_table' when '2-HIGH' then 'high_table'
  when '3-MEDIUM' then 'medium_table' else concat('zone_', replace(o_orderpriority, '-', '_')) end as table_name
from orders
""")
def table_name(spark, sf_dir):
    mapping = {"zone/1-URGENT": "urgent_table", "zone_2-HIGH": "high_table", "zone/3-MEDIUM": "medium_table"}
    endpoint = F.concat(F.lit("zone/"), F.when(
        F.col("o_orderpriority") == "3-MEDIUM", F.lit("3_MEDIUM")).otherwise(F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", requests.table_of_endpoint(endpoint, mapping).alias("table_name")
    )


@query("reason_normalise", """
select event_id, case event_type when 'error' then 'Unavailable' when 'view' then 'Unavailable'
  when 'click' then 'Available' when 'purchase' then null else props end as qty_reason
from events
""")
def reason_normalise(spark, sf_dir):
    kind = F.col("event_type")
    reason = (
        F.when(kind == "error", F.lit("Capacity UNAVAILABLE today"))
        .when(kind == "view", F.lit("unavailable"))
        .when(kind == "click", F.lit("Available"))
        .when(kind == "purchase", F.lit(None))
        .otherwise(F.col("props"))
    )
    return normalise_reasons(table(spark, sf_dir, "events").select("event_id", reason.alias("qty_reason")))


@query("na_texts", """
select event_id, case when event_type in ('error', 'view', 'signup') then null else props end as text,
  case when event_type <> 'click' then value end as number
from events
""")
def na_texts(spark, sf_dir):
    kind = F.col("event_type")
    raw = F.when(kind == "error", "N/A").when(kind == "view", "").when(kind == "signup", "#N/A N/A").otherwise(F.col("props"))
    number = F.when(kind == "click", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select(
        "event_id", text.null_if_na(raw).alias("text"), text.null_if_nan(number).alias("number")
    )


@query("rounding", """
select event_id, round(value / 7, 4) as four, round(sqrt(value), 2) as two, round_even(value, 0) as whole
from events
""")
def rounding(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        numbers.round_exact(value / 7, 4).alias("four"),
        numbers.round_exact(F.sqrt(value), 2).alias("two"),
        numbers.round_exact(value, 0).alias("whole"),
    )


@query("sidecar_json", """
select cast(o_orderkey as varchar) as stem, case when ok then o_orderpriority end as endpoint,
  case when ok then cast(o_custkey as integer) end as requested_cycle,
  case when ok then case when o_orderstatus = 'P' then cast(o_custkey as varchar) else strftime(o_orderdate, '%Y%m%d') end end as date,
  ok and o_orderstatus <> 'P' as date_is_text, ok as readable
from (select *, o_orderpriority <> '5-LOW' as ok from orders)
""")
def sidecar_json(spark, sf_dir):
    """Sidecar texts: dates as text and as number, and documents that end too early."""
    day = F.date_format("o_orderdate", "yyyyMMdd")
    fields = [F.col("o_orderpriority").alias("endpoint"), F.col("o_custkey").alias("requested_cycle")]
    whole = F.when(
        F.col("o_orderstatus") == "P", F.to_json(F.struct(*fields, F.col("o_custkey").alias("date")))
    ).otherwise(F.to_json(F.struct(*fields, day.alias("date"))))
    cut = F.when(F.col("o_orderpriority") == "5-LOW", F.expr("left(whole, length(whole) - 1)")).otherwise(F.col("whole"))
    documents = table(spark, sf_dir, "orders").withColumn("whole", whole).select(
        F.col("o_orderkey").cast("string").alias("stem"), cut.alias("value")
    )
    return parse_sidecars(documents).select("stem", "endpoint", "requested_cycle", "date", "date_is_text", "readable")
