"""Landing folders: files written from events, read back, loaded, streamed."""

from __future__ import annotations

import gzip

from pyspark.sql import Window, functions as F, types as T

from catalog import query
from catalog.views import NAMES_SQL, names, table, with_sql
from tidegate.functions.filenames import stem
from tidegate.operators import lineage, quality as q, sketches
from tidegate.operators.clean import infer_types
from tidegate.plans.loads import load_folder, prepare
from tidegate.plans.recipes import Load, run_recipe
from tidegate.session import materialise, scratch_path
from tidegate.sources import feed as source, tables
from tidegate.sources.sidecars import append_manifest, read_manifest, sidecars_of
from tidegate.streaming import ingest

RAW = ["Loc", "Loc Name", "DC", "OAC", "Qty Reason", "Event"]
NOW = 1706745600.0  # 2024-02-01


def readings(spark, sf_dir):
    """Events under the headings of a raw capacity file."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("user_id").cast("string").alias("Loc"),
        F.concat(F.lit("user, "), F.col("user_id").cast("string")).alias("Loc Name"),
        F.when(F.col("event_type") == "view", F.lit("N/A")).otherwise(F.col("value").cast("string")).alias("DC"),
        k.alias("OAC"),
        F.when(F.col("event_type") == "error", F.lit('said "UNAVAILABLE" twice')).alias("Qty Reason"),
        F.col("event_id").cast("string").alias("Event"),
        F.to_date("ts").alias("day"),
        F.col("event_type").alias("kind"),
    )


def land(rows, path: str) -> None:
    """Write CSV files per day and kind, each a run of events in order."""
    (
        rows.repartitionByRange(F.col("Event").cast("long"))
        .sortWithinPartitions("day", "kind", F.col("Event").cast("long"))
        .write.mode("append").option("header", True).option("escape", '"').partitionBy("day", "kind").csv(path)
    )


def landed(spark, sf_dir) -> str:
    path = scratch_path(spark, "landing")
    land(readings(spark, sf_dir), path)
    return path


_READINGS = """
with readings as (
  select cast(user_id as varchar) as loc, concat('user, ', user_id) as loc_name,
    case when event_type <> 'view' then value end as dc,
    cast(regexp_extract(props, '"k": ([0-9]+)', 1) as double) as oac,
    case when event_type = 'error' then 'said "UNAVAILABLE" twice' end as qty_reason,
    event_id as event, cast(ts as date) as day, event_type as kind
  from events
)
"""


@query("landing_rows", _READINGS + """
select loc, loc_name, dc, oac, qty_reason, cast(event as varchar) as event, true as in_order from readings
""")
def landing_rows(spark, sf_dir):
    """Scan of a landing folder with cleaned names, missing values and row positions.

    ``in_order`` compares the row position with the rank of the event in its file.
    """
    rows = source.with_row_index(source.read_feed(spark, landed(spark, sf_dir), RAW, min_bytes=0))
    rank = F.row_number().over(Window.partitionBy("file_path").orderBy(F.col("event").cast("long"))) - 1
    return rows.select(
        "loc", "loc_name", F.col("dc").try_cast("double").alias("dc"), F.col("oac").try_cast("double").alias("oac"),
        "qty_reason", "event", (F.col("row_id") == rank).alias("in_order"),
    )


@query("landing_header", """
select column_name, count(*) as row_count from events, unnest(['loc', 'loc_name', 'dc', 'oac', 'qty_reason', 'event']) t(column_name)
group by column_name
""")
def landing_header(spark, sf_dir):
    """Column names taken from the landed files themselves."""
    rows = source.read_feed(spark, landed(spark, sf_dir), min_bytes=0).drop(*source.FILE_COLUMNS, "day", "kind")
    return rows.select(F.explode(F.array(*[F.lit(c) for c in rows.columns])).alias("column_name")).groupBy(
        "column_name"
    ).agg(F.count(F.lit(1)).alias("row_count"))


@query("landing_inventory", _READINGS + """
select day, kind, count(*) as row_count, true as consistent from readings group by day, kind
""")
def landing_inventory(spark, sf_dir):
    """Files by listing, their rows by scan, tiny files left out of both counts alike."""
    path = landed(spark, sf_dir)
    listing = source.list_files(spark, path)
    counted = source.read_feed(spark, path, RAW, min_bytes=0).groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    kept = source.read_feed(spark, path, RAW, min_bytes=400).groupBy("file_path").agg(F.count(F.lit(1)).alias("kept"))
    both = listing.join(counted, "file_path", "left").join(kept, "file_path", "left")
    expected = F.when(F.col("file_size") >= 400, F.col("n"))
    return both.select(
        F.regexp_extract("file_path", "day=([^/]+)/", 1).cast("date").alias("day"),
        F.regexp_extract("file_path", "kind=([^/]+)/", 1).alias("kind"),
        "n",
        expected.eqNullSafe(F.col("kept")).alias("ok"),
    ).groupBy("day", "kind").agg(F.sum("n").alias("row_count"), F.bool_and("ok").alias("consistent"))


def _lineage_files(spark, sf_dir):
    """Orders as files; orders of status F have a sidecar, those of status O by LOW an unreadable one."""
    files = names(spark, sf_dir).select(
        F.col("name").alias("file_path"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("_"), F.element_at(F.split("name", "/"), -1)).alias("file_name"),
        F.lit(1000).cast("long").alias("file_size"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("interval 36 hours")).alias("file_modified"),
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate",
    )
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double") + 86400
    urgent = F.col("o_orderpriority") == "1-URGENT"
    high = F.col("o_orderpriority") == "2-HIGH"
    medium = F.col("o_orderpriority") == "3-MEDIUM"
    sidecars = files.where("o_orderstatus = 'F' or (o_orderstatus = 'O' and o_orderpriority = '5-LOW')").select(
        stem(F.col("file_name")).alias("stem"),
        F.when(urgent, F.lit("")).otherwise(F.lit("Evening Late")).alias("cycle_name"),
        F.when(high, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(medium, seconds.cast("long").cast("string"))
        .when(~urgent, F.lit("someday")).alias("date"),
        F.when(~high, seconds).alias("download_timestamp"),
        (~medium).alias("date_is_text"),
        (F.col("o_orderstatus") == "F").alias("readable"),
    )
    return files, sidecars


def _lineage_sql(compat: bool) -> str:
    high = "cast(o_orderdate as date) + 1" if compat else "cast(o_orderdate as date)"
    return with_sql(NAMES_SQL) + f""",
labelled as (
  select *, regexp_extract(lower(name), 'intraday ([0-9]+)', 1) as digits,
    case when o_orderstatus = 'F' then 'sidecar' when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then 'broken' else 'none' end as how
  from names
)
select o_orderkey,
  case when how = 'sidecar' and o_orderpriority <> '1-URGENT' then 'Evening_Late'
    when how = 'none' and digits <> '' then concat('Intraday_', digits) else 'Unknown_Cycle' end as cycle_id,
  case how when 'none' then cast(o_orderdate as date) when 'broken' then date '2024-02-01'
    else case when o_orderpriority = '2-HIGH' then {high} else cast(o_orderdate as date) + 1 end end as measure_date,
  case how when 'sidecar' then epoch(o_orderdate) + case when o_orderpriority = '2-HIGH' then 129600.0 else 86400.0 end
    else 1706745600.0 end as download_timestamp
from labelled
"""


@query("lineage", _lineage_sql(compat=False))
def lineage_of_files(spark, sf_dir):
    files, sidecars = _lineage_files(spark, sf_dir)
    return lineage.resolve_lineage(files, sidecars, NOW).select("o_orderkey", *tables_lineage())


@query("lineage_compat_dates", _lineage_sql(compat=True))
def lineage_compat_dates(spark, sf_dir):
    files, sidecars = _lineage_files(spark, sf_dir)
    return lineage.resolve_lineage(files, sidecars, NOW, compat_dates=True).select("o_orderkey", *tables_lineage())


def tables_lineage() -> list[str]:
    return ["measure_date", "cycle_id", "download_timestamp"]


_ROW_LINEAGE = """
select l_orderkey, l_linenumber, l_partkey, cast(o_orderdate as date) as measure_date, 'Unknown_Cycle' as cycle_id,
  cast(1706745600 as double) as download_timestamp
from lineitem left join orders on l_orderkey = o_orderkey
"""


def _lineitem_rows(spark, sf_dir):
    """Lines as rows of one file per order; the line number stands for the place in the file."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_orderkey").cast("string").alias("file_path"),
        F.col("l_linenumber").cast("long").alias("block_start"),
    )
    files = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("file_path"),
        F.date_format("o_orderdate", "'x_'MM-dd-yyyy'.csv'").alias("file_name"),
        F.lit(9).cast("long").alias("file_size"),
        F.lit(None).cast("timestamp").alias("file_modified"),
    )
    none = files.where(F.lit(False)).select(
        F.lit("").alias("stem"), F.lit("").alias("cycle_name"), F.lit("").alias("date"),
        F.lit(0.0).alias("download_timestamp"), F.lit(True).alias("date_is_text"), F.lit(True).alias("readable"),
    )
    return lines, lineage.resolve_lineage(files, none, NOW)


@query("lineage_rows", _ROW_LINEAGE)
def lineage_rows(spark, sf_dir):
    lines, resolved = _lineitem_rows(spark, sf_dir)
    return lineage.attach_lineage(lines, resolved).drop("file_path", "block_start")


@query("lineage_rows_segmented", _ROW_LINEAGE)
def lineage_rows_segmented(spark, sf_dir):
    """The same for more files than may be broadcast: joined by file and segment of the file."""
    lines, resolved = _lineitem_rows(spark, sf_dir)
    return lineage.attach_lineage(lines, resolved, broadcast_files=0, segment_bytes=3).drop("file_path", "block_start")


def _manifest(spark, listing):
    """A record per landed file: cycle and day from its folder, download at noon of the next day."""
    day = F.regexp_extract("file_path", "day=([^/]+)/", 1).cast("date")
    noon = F.unix_seconds(day.cast("timestamp")) + 129600
    return listing.select(
        F.lit("capacity").alias("endpoint"),
        F.lit(1).alias("requested_cycle"),
        F.regexp_extract("file_path", "kind=([^/]+)/", 1).alias("cycle_name"),
        F.date_format(day, "yyyyMMdd").alias("date"),
        F.col("file_name").alias("original_filename"),
        F.concat(F.regexp_replace("file_name", r"\.csv$", ""), F.lit("-"), F.date_format(day, "yyyyMMdd")).alias("saved"),
        F.date_format(F.timestamp_seconds(noon), "yyyy-MM-dd'T'HH:mm:ss").alias("download_time"),
        noon.cast("double").alias("download_timestamp"),
        "file_path", "file_size", "file_modified", "file_name",
    )


@query("folder_to_table", _READINGS + """
select loc, loc_name, cast(null as varchar) as loc_zn, dc, oac, case when kind = 'error' then 'Unavailable' end as qty_reason,
  day as measure_date, kind as cycle_id, cast(epoch(day) + 129600 as double) as download_timestamp,
  timestamp '2024-02-01 00:00:00' as created_at
from readings
qualify row_number() over (partition by loc, loc_name, day, kind order by event desc) = 1
""")
def folder_to_table(spark, sf_dir):
    """A whole load: scan, names, nulls, lineage from a stored manifest, typing, checks, stored upsert."""
    path = landed(spark, sf_dir)
    rows = source.with_row_index(source.read_feed(spark, path, RAW, min_bytes=0))
    manifest_path = scratch_path(spark, "manifest")
    listing = _manifest(spark, source.list_files(spark, path))
    # Spark names files of one task alike in every folder, so the day is added to tell them apart.
    records = listing.withColumn("saved_filename", F.concat("saved", F.lit("-"), "cycle_name", F.lit(".csv")))
    append_manifest(records, manifest_path)
    named = records.select("file_path", F.col("saved_filename").alias("file_name"), "file_size", "file_modified")
    resolved = lineage.resolve_lineage(named, sidecars_of(read_manifest(spark, manifest_path)), NOW)
    placed = lineage.attach_lineage(rows.drop("day", "kind"), resolved)
    # Of one cycle, later events stand in later files: order the files by their first event.
    kept = placed.withColumn("position", F.col("event").cast("long")).drop("event")
    processed = run_recipe(kept.drop("row_id").withColumnRenamed("position", "row_id"), "capacity", Load())
    typed = prepare(tables.stage(processed, scratch_path(spark, "processed")))
    table_path = scratch_path(spark, "capacity")
    tables.merge_into(
        spark, table_path, typed.accepted.drop("file_path"), ["row_id"], now=F.timestamp_seconds(F.lit(NOW))
    )
    return tables.read_table(spark, table_path).select(
        "loc", "loc_name", "loc_zn", "dc", "oac", "qty_reason", "measure_date", "cycle_id", "download_timestamp", "created_at"
    )


@query("processed_csv", _READINGS + """
select loc, loc_name, dc, oac, qty_reason, cast(event as varchar) as event, day, kind from readings
""")
def processed_csv(spark, sf_dir):
    """Cleaned rows written as CSV beside the raw files, and read again."""
    rows = source.read_feed(spark, landed(spark, sf_dir), RAW, min_bytes=0)
    out = scratch_path(spark, "processed")
    tables.write_csv(rows.select("loc", "loc_name", "dc", "oac", "qty_reason", "event",
                                 F.regexp_extract("file_path", "day=([^/]+)/", 1).alias("day"),
                                 F.regexp_extract("file_path", "kind=([^/]+)/", 1).alias("kind")), out)
    again = source.read_feed(spark, out, ["loc", "loc_name", "dc", "oac", "qty_reason", "event", "day", "kind"], min_bytes=0)
    return again.select(
        "loc", "loc_name", F.col("dc").cast("double").alias("dc"), F.col("oac").cast("double").alias("oac"),
        "qty_reason", "event", F.col("day").cast("date").alias("day"), "kind",
    )


_ROW_SCHEMA = T.StructType([
    T.StructField("loc", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("measure_date", T.DateType()),
    T.StructField("dc", T.DoubleType()),
    T.StructField("created_at", T.TimestampType()),
])
_EVENT_KEY = ["loc", "event", "measure_date"]


def _stream_rows(stream):
    return stream.select(
        "loc", "event", F.regexp_extract("file_path", "day=([^/]+)/", 1).cast("date").alias("measure_date"),
        F.col("dc").try_cast("double").alias("dc"),
    )


@query("stream_ingest", _READINGS + """
select loc, cast(event as varchar) as event, day as measure_date, dc from readings
""")
def stream_ingest(spark, sf_dir):
    """Landed files as a stream into a table; run twice, every file is taken once."""
    path, out, checkpoint = landed(spark, sf_dir), scratch_path(spark, "rows"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = _stream_rows(source.read_feed_stream(spark, path, RAW, min_bytes=0))
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.read.parquet(out)


@query("stream_upsert", _READINGS + """
select loc, cast(event as varchar) as event, day as measure_date, case when day >= date '2024-01-15' then oac else dc end as dc,
  timestamp '2024-02-01 00:00:00' as created_at
from readings
""")
def stream_upsert(spark, sf_dir):
    """Files streamed into a keyed table; then half of the days are re-issued and overwrite their rows."""
    path, out, checkpoint = landed(spark, sf_dir), scratch_path(spark, "keyed"), scratch_path(spark, "checkpoint")

    def run():
        stream = _stream_rows(source.read_feed_stream(spark, path, RAW, min_bytes=0, max_files=100))
        step = ingest.upsert_step(out, checkpoint, ["dc"], _EVENT_KEY, _ROW_SCHEMA, now=NOW)
        ingest.start(stream, step, checkpoint).awaitTermination()

    run()
    again = readings(spark, sf_dir).where(F.col("day") >= F.lit("2024-01-15").cast("date"))
    land(again.withColumn("DC", F.col("OAC")), path)
    run()
    return tables.read_table(spark, out, _ROW_SCHEMA)


@query("stream_admit_once", """
with seen as (
  select cast(user_id as varchar) as loc, bool_or(day <= 10) as first, bool_or(day between 11 and 20) as second, bool_or(day > 20) as third
  from (select user_id, extract(day from ts) as day from events) group by user_id
)
select loc, unnest([1, 8, 15]) as arrived, unnest([first, second and not first, third and not (second and not first)]) as admitted
from seen
""")
def stream_admit_once(spark, sf_dir):
    """A location is admitted once within three days of its admission, and again after that.

    The events come in three runs, a week apart: the middle one moves the watermark past what the first
    admitted, not past its own.
    """
    path, out, checkpoint = (scratch_path(spark, name) for name in ("arrivals", "admitted", "checkpoint"))
    rows, day = readings(spark, sf_dir), F.dayofmonth("day")
    locs = rows.select(F.col("Loc").alias("loc")).distinct()
    for arrived, when in ((1, day <= 10), (8, day.between(11, 20)), (15, day > 20)):
        land(rows.where(when).withColumn("day", F.make_date(F.lit(2024), F.lit(2), F.lit(arrived))), path)
        arrivals = _stream_rows(source.read_feed_stream(spark, path, RAW, min_bytes=0)).select(
            "loc", F.col("measure_date").cast("timestamp").alias("arrival")
        )
        admitted = ingest.admit_once_within(arrivals, ["loc"], "arrival", "3 days")
        admitted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    found = spark.read.schema("loc string, arrival timestamp").parquet(out).select(
        "loc", F.dayofmonth("arrival").alias("arrived"), F.lit(True).alias("admitted"))
    asked = locs.select("loc", F.explode(F.array(*[F.lit(d) for d in (1, 8, 15)])).alias("arrived"))
    return asked.join(found, ["loc", "arrived"], "left").withColumn("admitted", F.coalesce("admitted", F.lit(False)))


@query("two_layouts", _READINGS + """
select loc, dc, oac, event from readings where day < date '2024-01-16'
union all select loc, dc, null, event from readings where day >= date '2024-01-16'
""")
def two_layouts(spark, sf_dir):
    """Files of an older and a newer layout in one load; the newer one has no availability."""
    rows = readings(spark, sf_dir)
    change = F.lit("2024-01-16").cast("date")
    parts = []
    for name, columns, when in (
        ("older", ["Loc", "DC", "OAC", "Event"], F.col("day") < change),
        ("newer", ["Event", "Loc", "DC"], F.col("day") >= change),
    ):
        path = scratch_path(spark, name)
        rows.where(when).select(*columns).write.option("header", True).csv(path)
        parts.append(source.read_feed(spark, path, min_bytes=0).drop(*source.FILE_COLUMNS))
    return source.union_feeds(*parts).select(
        "loc", F.col("dc").try_cast("double").alias("dc"), F.col("oac").try_cast("double").alias("oac"),
        F.col("event").cast("bigint").alias("event"),
    )


@query("mixed_layouts", _READINGS + """
select loc, dc, case when day < date '2024-01-16' then oac end as oac, event from readings
""")
def mixed_layouts(spark, sf_dir):
    """The same two layouts side by side in one folder, told apart by their headers."""
    path = scratch_path(spark, "mixed")
    rows, change = readings(spark, sf_dir), F.lit("2024-01-16").cast("date")
    for columns, when in ((["Loc", "DC", "OAC", "Event"], F.col("day") < change), (["Event", "Loc", "DC"], F.col("day") >= change)):
        rows.where(when).select(*columns).write.mode("append").option("header", True).csv(path)
    return source.read_layouts(spark, path, min_bytes=0).select(
        "loc", F.col("dc").try_cast("double").alias("dc"), F.col("oac").try_cast("double").alias("oac"),
        F.col("event").cast("bigint").alias("event"),
    )


@query("inferred_types", """
with kinds as (
  select * from (values ('loc', 'bigint'), ('loc_name', 'string'), ('dc', 'double'), ('oac', 'bigint'), ('qty_reason', 'string'),
    ('event', 'bigint')) t(column_name, kind)
)
select column_name, kind, (select count(*) from events) as row_count from kinds
""")
def inferred_types(spark, sf_dir):
    """Types found by looking at the landed text, with the rows they were found on."""
    rows = source.read_feed(spark, landed(spark, sf_dir), RAW, min_bytes=0).drop(*source.FILE_COLUMNS, "day", "kind")
    typed = infer_types(rows)
    pairs = [F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("kind")) for n, t in typed.dtypes]
    return typed.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p").agg(
        F.count(F.lit(1)).alias("row_count")
    ).select("p.*", "row_count")


@query("recipe_capacity", _READINGS + """
select loc, 'day_' || kind as file_path, max(dc) as capacity, min(event) as row_id,
  arg_min(oac, event) as oac, case when kind = 'error' then 'Unavailable' end as qty_reason
from readings group by loc, kind
""")
def recipe_capacity(spark, sf_dir):
    """Sanitised names, present lineage left alone, duplicates of a file collapsed, reasons normalised."""
    rows = readings(spark, sf_dir).select(
        F.col("Loc").alias("Location"), F.concat(F.lit("day_"), "kind").alias("File Path"),
        F.col("DC").try_cast("double").alias("Capacity"), F.col("Event").cast("long").alias("Row-ID"),
        F.col("OAC").cast("double").alias("OAC"), "Qty Reason",
        F.lit(1.0).alias("download_timestamp"), F.lit("x").alias("cycle_id"), F.lit("y").alias("measure_date"),
    )
    done = run_recipe(rows, "Capacity", Load())
    return done.select(F.col("location").alias("loc"), "file_path", "capacity", "row_id", "oac", "qty_reason")


def _raw_lines(rows, header: str, line, path: str) -> None:
    """CSV files made of whole lines, so that a line need not fit the header."""
    (
        rows.repartitionByRange(F.col("Event").cast("long"))
        .sortWithinPartitions(F.col("Event").cast("long"))
        .select(line.alias(header))
        .write.option("header", True).option("sep", "\t").option("quote", "\x01").csv(path)
    )


def _put_bytes(spark, path: str, data: bytes) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()


def _put_text(spark, path: str, text: str) -> None:
    _put_bytes(spark, path, text.encode())


# Sidecars of the files of a kind; the other kinds have none.
_SIDECARS = {
    "purchase": '{"cycle_name": "Evening", "date": "20240110", "download_timestamp": 1704931200}',
    "error": '{"cycle_name": "Evening", "date": "2024-01-11", "download_timestamp": 1705017600}',
    "click": '{"cycle_name": "Evening", ',
}


def _mixed_folder(spark, sf_dir) -> tuple[str, str]:
    """Two layouts with other columns in another order, lines that are too long, and JSON sidecars beside them."""
    landing, metadata = scratch_path(spark, "mixed"), scratch_path(spark, "sidecars")
    rows = readings(spark, sf_dir)
    name, empty = F.concat(F.lit('"'), F.col("Loc Name"), F.lit('"')), F.lit("")
    number = [F.coalesce(F.col(c), empty) for c in ("DC", "OAC")]
    third = F.col("Event").cast("long") % 3 == 0
    long_line = (F.col("kind") == "error") & third
    older = F.when(long_line, F.concat_ws(",", "Loc", name, empty, empty, F.lit("x"), F.col("Event"))).otherwise(
        F.concat_ws(",", "Loc", name, *number))
    newer = F.when(long_line, F.concat_ws(",", name, "Loc", empty, F.col("Event"))).otherwise(F.concat_ws(",", name, "Loc", number[0]))
    change = F.lit("2024-01-16").cast("date")
    # A write of its own per kind, as Spark names the files of one task alike in all folders of a write.
    for kind in ("click", "error", "purchase", "signup", "view"):
        own = rows.where(F.col("kind") == kind)
        _raw_lines(own.where(F.col("day") < change), "Loc,Loc Name,DC,OAC", older, f"{landing}/a-{kind}")
        _raw_lines(own.where(F.col("day") >= change), "Loc Name,Loc,DC", newer, f"{landing}/b-{kind}")
    folder = F.element_at(F.split("file_path", "/"), -2)
    # One line per file; a load has few.
    _put_text(spark, f"{metadata}/of no file.meta.json", "{}")
    for file in source.list_files(spark, f"{landing}/*").select("file_name", folder.alias("folder")).toLocalIterator():
        if text := _SIDECARS.get(file["folder"][2:]):
            _put_text(spark, f"{metadata}/{file['file_name'][:-4]}.meta.json", text)
    return f"{landing}/*", metadata


_MIXED = _READINGS + """,
lines as (
  select *, case when day < date '2024-01-16' then 'a' else 'b' end as layout,
    case kind when 'purchase' then date '2024-01-10' when 'error' then date '2024-01-11' else date '2024-02-01' end as measure_date,
    case when kind in ('purchase', 'error') then 'Evening' else 'Unknown_Cycle' end as cycle_id,
    cast(case kind when 'purchase' then 1704931200 when 'error' then 1705017600 else 1706745600 end as double) as download_timestamp,
    kind = 'error' and event % 3 = 0 as too_long
  from readings
),
stored as (
  select loc, loc_name, dc, case when layout = 'a' then oac end as oac, measure_date, cycle_id, download_timestamp
  from lines where not too_long
  qualify row_number() over (partition by loc, loc_name, measure_date, cycle_id order by layout desc, kind desc, event desc) = 1
),
aside as (
  select case layout when 'a' then concat(loc, ',"', loc_name, '",,,x,', event) else concat('"', loc_name, '",', loc, ',,', event) end as line
  from lines where too_long
)
"""
_PLACE = ["loc", "loc_name", "dc", "oac", "measure_date", "cycle_id", "download_timestamp"]


@query("load_mixed_folder", _MIXED + """
select *, null as line from stored union all by name select line from aside
""")
def load_mixed_folder(spark, sf_dir):
    """A whole load from files: own headers, sidecars that are whole, broken or absent, lines too long set aside."""
    landing, metadata = _mixed_folder(spark, sf_dir)
    at = scratch_path(spark, "capacity")
    done = load_folder(spark, landing, metadata, at, now=NOW, min_bytes=0)
    lines = done.surplus.select(F.col("surplus_line").alias("line"))
    return tables.read_table(spark, at).select(*_PLACE).unionByName(lines, allowMissingColumns=True)


@query("unreadable_files", """
select concat(event_type, '.csv') as file, 'FILE_NOT_FOUND' as type, 'ERROR' as severity, 0 as record_count, 'FAILED' as status
from events group by event_type
union all select 'empty.csv', 'EMPTY_FILE', 'ERROR', 0, 'FAILED'
""")
def unreadable_files(spark, sf_dir):
    """A load whose sidecars announce a file per kind, none of which landed, and a file with a header alone."""
    landing, metadata = scratch_path(spark, "partly"), scratch_path(spark, "announced")
    rows = readings(spark, sf_dir)
    _raw_lines(rows, "Loc,Loc Name,DC", F.concat_ws(",", "Loc", "Loc", F.col("OAC")), f"{landing}/a")
    _put_text(spark, f"{landing}/b/empty.csv", "Loc,Loc Name,DC\n")
    for row in rows.select("kind").distinct().toLocalIterator():  # five
        _put_text(spark, f"{metadata}/{row['kind']}.meta.json", "{}")
    done = load_folder(spark, f"{landing}/*", metadata, scratch_path(spark, "capacity"), now=NOW, min_bytes=0)
    issues, failed = done.unreadable, q.failed_summary(done.unreadable, by="file_path")
    return issues.select("file_path", "type", "severity").join(failed, "file_path").select(
        F.substring_index("file_path", "/", -1).alias("file"), "type", "severity",
        F.col("record_count").cast("int").alias("record_count"), "status")


@query("stream_feed", _MIXED + """,
checked as (
  select concat(layout, '-', kind) as loc, count(*) as n, count(*) - count(dc) as empty from lines where not too_long and layout = 'a'
  group by layout, kind
),
kept as (
  select loc, loc_name, dc, oac, measure_date, cycle_id, download_timestamp from lines where not too_long and layout = 'a'
  qualify row_number() over (partition by loc, loc_name, measure_date, cycle_id order by kind desc, event desc) = 1
)
select 'table' as part, *, null as line, cast(1 as bigint) as n, cast(null as bigint) as empty from kept
union all by name select 'surplus' as part, line, cast(2 as bigint) as n from aside where not starts_with(line, '"')
union all by name select 'report' as part, loc, cast(2 * n as bigint) as n, cast(2 * empty as bigint) as empty from checked
""")
def stream_feed(spark, sf_dir):
    """Two streams over one folder into one table: rows once, what is set aside and reported once per stream."""
    landing, metadata = _mixed_folder(spark, sf_dir)
    out = scratch_path(spark, "streamed")
    for name in ("first", "second"):
        stream = source.read_feed_stream(spark, landing.replace("/*", "/a-*"), ["Loc", "Loc Name", "DC", "OAC"], min_bytes=0)
        step = ingest.feed_step(f"{out}/table", metadata, f"{out}/{name}", now=NOW, reports=f"{out}/reports", quarantine=f"{out}/aside")
        ingest.start(stream, step, f"{out}/{name}").awaitTermination()
    rows = tables.read_table(spark, f"{out}/table").select(F.lit("table").alias("part"), *_PLACE, F.lit(1).cast("long").alias("n"))
    lines = spark.read.parquet(f"{out}/aside/surplus").groupBy(F.col("surplus_line").alias("line")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("surplus"))
    reports = spark.read.json(f"{out}/reports/reports").withColumn("loc", F.element_at(F.split("file_path", "/"), -2))
    nulls = F.filter("issues", lambda i: (i["type"] == "MISSING_VALUES") & (i["column"] == "dc"))
    reports = reports.groupBy("loc").agg(
        F.sum("summary.record_count").alias("n"), F.sum(F.coalesce(F.get(nulls, F.lit(0))["affected_count"], F.lit(0))).alias("empty")
    ).withColumn("part", F.lit("report"))
    return rows.unionByName(lines, allowMissingColumns=True).unionByName(reports, allowMissingColumns=True)


@query("stream_layouts", _MIXED + """,
again as (
  select loc, loc_name, dc, cast(event % 7 as double) as opc from readings where kind = 'signup' and event % 2 = 0
  qualify row_number() over (partition by loc, loc_name order by event desc) = 1
)
select s.loc, s.loc_name, case when a.loc is null then s.dc else a.dc end as dc, a.opc, s.oac, s.measure_date, s.cycle_id, s.download_timestamp,
  cast(null as varchar) as line
from stored s left join again a on s.loc = a.loc and s.loc_name = a.loc_name and s.cycle_id = 'Unknown_Cycle'
union all by name select line from aside
""")
def stream_layouts(spark, sf_dir):
    """A folder of two layouts as a stream; a third one, with a column of its own, first appears in the second run."""
    landing, metadata = _mixed_folder(spark, sf_dir)
    out = scratch_path(spark, "layouts")

    def run():
        stream = source.read_files_stream(spark, landing, min_bytes=0)
        step = ingest.files_step(f"{out}/table", metadata, f"{out}/checkpoint", now=NOW, quarantine=f"{out}/aside")
        ingest.start(stream, step, f"{out}/checkpoint").awaitTermination()

    run()
    rows = readings(spark, sf_dir).where((F.col("kind") == "signup") & (F.col("Event").cast("long") % 2 == 0))
    number = [F.coalesce(F.col("DC"), F.lit("")), (F.col("Event").cast("long") % 7).cast("string")]
    line = F.concat_ws(",", number[0], F.concat(F.lit('"'), F.col("Loc Name"), F.lit('"')), number[1], "Loc")
    _raw_lines(rows, "DC,Loc Name,OPC,Loc", line, landing.replace("/*", "/c-signup"))
    run()
    lines = spark.read.parquet(f"{out}/aside/surplus").select(F.col("surplus_line").alias("line"))
    stored = tables.read_table(spark, f"{out}/table").select(*_PLACE, "opc")
    return stored.unionByName(lines, allowMissingColumns=True)


@query("stream_bad_files", _READINGS + """,
keyed as (
  select loc, loc_name, dc from readings where kind <> 'error'
  qualify row_number() over (partition by loc, loc_name order by event desc) = 1
)
select 'table' as part, loc, loc_name, dc from keyed
union all by name select 'table' as part, loc_name, dc from readings where kind = 'error'
union all by name select 'unreadable' as part, * from (values ('bytes.csv', 'not UTF-8'), ('cut.csv.gz', 'broken')) t(loc, loc_name)
""")
def stream_bad_files(spark, sf_dir):
    """Files that are no text or cut short among many: the others are loaded, also the rows without a key, and once only
    although the batch is run again."""
    landing, out = scratch_path(spark, "queue"), scratch_path(spark, "loaded")
    rows = readings(spark, sf_dir)
    loc = F.when(F.col("kind") == "error", F.lit("")).otherwise(F.col("Loc"))
    line = F.concat_ws(",", loc, F.concat(F.lit('"'), F.col("Loc Name"), F.lit('"')), F.coalesce(F.col("DC"), F.lit("")))
    _raw_lines(rows, "Loc,Loc Name,DC", line, f"{landing}/sound")
    text = "Loc,Loc Name,DC\n" + "".join(f"X{i},bad,{i}\n" for i in range(1000))
    _put_bytes(spark, f"{landing}/bad/bytes.csv", text.encode() + b"caf\xe9,latin,1\n")
    packed = gzip.compress(text.encode(), mtime=0)
    _put_bytes(spark, f"{landing}/bad/cut.csv.gz", packed[: len(packed) // 2])
    _put_bytes(spark, f"{out}/metadata/none.meta.json", b"{}")
    step = ingest.files_step(f"{out}/table", f"{out}/metadata", f"{out}/checkpoint", now=NOW, quarantine=f"{out}/aside")
    stream = source.read_files_stream(spark, f"{landing}/*", min_bytes=0)
    ingest.start(stream, step, f"{out}/checkpoint").awaitTermination()
    step(spark.createDataFrame([], "path string, file_path string"), 0)  # run again: the record says which files it is about
    bad = spark.read.parquet(f"{out}/aside/unreadable").select(
        F.lit("unreadable").alias("part"), F.substring_index("file_path", "/", -1).alias("loc"),
        F.when(F.col("error").startswith("not UTF-8"), "not UTF-8").otherwise("broken").alias("loc_name"))
    stored = tables.read_table(spark, f"{out}/table").select(F.lit("table").alias("part"), "loc", "loc_name", "dc")
    return stored.unionByName(bad, allowMissingColumns=True)


@query("stream_admit_exact", """
with recursive admitted as (
  select user_id, min(ts) as ts from events group by user_id
  union all
  select user_id, ts from (
    select e.user_id, min(e.ts) as ts from admitted a join events e on e.user_id = a.user_id and e.ts > a.ts + interval 172800 second
    group by e.user_id)
)
select cast(user_id as varchar) as loc, ts as arrival from admitted
""")
def stream_admit_exact(spark, sf_dir):
    """Every event of a user as an arrival: admitted when the last admitted one is more than two days old, to the microsecond."""
    path, out, checkpoint = (scratch_path(spark, name) for name in ("arrivals", "admitted", "checkpoint"))
    events = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("loc"), F.col("ts").cast("timestamp").alias("arrival"))
    day = F.dayofmonth("arrival")
    for when in (day <= 11, day.between(12, 20), day > 20):
        events.where(when).write.mode("append").parquet(path)
        arrivals = spark.readStream.schema(events.schema).parquet(path)
        admitted = ingest.admit_exactly(arrivals, ["loc"], "arrival", 172_800, "1 day")
        admitted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


@query("sketched_statistics", """
select event_type as kind, count(*) as row_count, true as distinct_ok, true as quartiles_ok from events group by event_type
""")
def sketched_statistics(spark, sf_dir):
    """Distinct users and quartiles of a month from the stored sketches of its days, held against the rows themselves."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.to_date("ts").alias("day"), "user_id", "value")
    path = scratch_path(spark, "sketches")
    for load in range(2):
        own = events.where(F.dayofmonth("day") % 2 == load)
        for _ in range(2):  # a repeated load replaces its own lines
            sketches.store(sketches.sketch(own, ["kind", "day"], ["user_id"], ["value"]), path, "feed", load)
    ranks = (0.25, 0.5, 0.75)
    month = materialise(sketches.estimates(sketches.merge(sketches.stored(spark, path), ["kind"]), ranks))
    below = [F.avg((F.col("value") <= F.col("q_value")[i]).cast("double")) for i in range(3)]
    least = [F.avg((F.col("value") < F.col("q_value")[i]).cast("double")) for i in range(3)]
    exact = events.join(F.broadcast(month), "kind").groupBy("kind", "row_count", "n_user_id").agg(
        F.countDistinct("user_id").alias("users"), *(b.alias(f"b{i}") for i, b in enumerate(below)), *(b.alias(f"l{i}") for i, b in enumerate(least)))
    near = [(F.col(f"l{i}") <= r + 0.015) & (F.col(f"b{i}") >= r - 0.015) for i, r in enumerate(ranks)]
    return exact.select("kind", "row_count", (F.abs(F.col("n_user_id") - F.col("users")) <= 0.03 * F.col("users")).alias("distinct_ok"),
                        (near[0] & near[1] & near[2]).alias("quartiles_ok"))
