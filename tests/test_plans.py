from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import Observation, functions as F

from tidegate.plans import loads, recipes, requests
from tidegate.sources import feed, tables
from tidegate.sources.sidecars import accepted_responses
from tidegate.streaming import ingest

DAY = dt.date(2025, 6, 8)
NOW = dt.datetime(2025, 6, 9, tzinfo=dt.timezone.utc).timestamp()


def asked(spark, rows):
    return spark.createDataFrame(rows, "endpoint string, day date, cycle int, param_text string")


@pytest.fixture
def store(spark):
    manifest = spark.createDataFrame(
        [
            ("a/b", 1, "Intraday 1", "20250608", "one.csv", 1.0),
            ("a/b", 1, "Intraday 1", "20250608", "one.csv", 2.0),
            ("a/b", 2, "Timely", "20250608", "two.csv", 1.0),
            ("a/b", 3, "Evening", "20250608", "three.csv", 1.0),
            ("a/b", 4, "Evening", "20250608", "gone.csv", 1.0),
            ("a/b", 5, "Intraday 2", "20250608", "small.csv", 1.0),
            ("a/b", 6, "Intraday 3", "20250608", "old.csv", 1.0),
        ],
        "endpoint string, requested_cycle int, cycle_name string, date string, saved_filename string, download_timestamp double",
    )
    ledger = spark.createDataFrame(
        [(f"a/b_20250608_{c}_", ts) for c, ts in (
            ("intraday_1", NOW - 10), ("evening", NOW - 86400), ("timely", NOW), ("intraday_2", NOW), ("intraday_3", NOW - 86401))],
        "cache_key string, ts double",
    )
    listing = spark.createDataFrame(
        [("a_b", n, s) for n, s in (("one.csv", 200), ("two.csv", 900), ("three.csv", 900), ("small.csv", 199), ("old.csv", 900))],
        "folder string, file_name string, file_size long",
    )
    return manifest, ledger, listing


def test_cached_and_pending(spark, store):
    want = asked(spark, [("a/b", DAY, c, "") for c in (1, 2, 3, 4, 5, 6, None)] + [
        ("a/b", DAY, 1, "x=1"), ("a/b", dt.date(2025, 6, 7), 1, ""), ("other", DAY, 1, "")])
    found = requests.cached_files(want, *store, NOW, 86400)
    assert {(r["cycle"], r["file_name"]) for r in found.collect()} == {
        (1, "one.csv"), (3, "three.csv"), (None, "one.csv"), (None, "three.csv"),
    }
    pending = requests.pending_requests(want, *store, NOW, 86400)
    assert {(r["endpoint"], r["day"].day, r["cycle"], r["param_text"]) for r in pending.collect()} == {
        ("a/b", 8, 2, ""), ("a/b", 8, 4, ""), ("a/b", 8, 5, ""), ("a/b", 8, 6, ""),
        ("a/b", 8, 1, "x=1"), ("a/b", 7, 1, ""), ("other", 8, 1, ""),
    }
    assert requests.pending_requests(want, *store, NOW, 86400, caching=False).count() == 10
    assert requests.pending_requests(want, *store, NOW + 86400, 86400).count() == 10


def test_backfill_grid(spark):
    grid = requests.backfill_grid(spark.createDataFrame([("e",)], "endpoint string"), F.lit(DAY), 2)
    assert grid.count() == 16
    assert {r["day"] for r in grid.collect()} == {dt.date(2025, 6, 7), dt.date(2025, 6, 6)}
    seen = spark.createDataFrame([(dt.date(2025, 6, 7), 8)], "day date, cycle int")
    assert requests.not_seen(grid, seen).count() == 15


def test_responses(spark):
    rows = spark.createDataFrame(
        [
            ("e", 1, DAY, 'attachment; filename="data_timely_20250608.csv"', 900, NOW),
            ("e", 1, DAY, 'attachment; filename="data_intraday1_20250608.csv"', 900, NOW),
            ("e", 1, DAY, 'attachment; filename="x/data:evening.csv"', 200, NOW),
            ("e", 1, DAY, 'attachment; filename="data_evening.csv"', 199, NOW),
            ("e", 1, DAY, None, 900, NOW),
        ],
        "endpoint string, requested_cycle int, day date, disposition string, content_length long, received double",
    )
    kept = accepted_responses(rows).orderBy("cycle_name").collect()
    assert [(r["cycle_name"], r["saved_filename"], r["date"]) for r in kept] == [
        ("Evening", "data_evening.csv", "20250608"), ("Intraday 1", "data_intraday1_20250608.csv", "20250608"),
    ]
    assert kept[0]["download_time"] == "2025-06-09T00:00:00.000000"


def test_recipes():
    assert recipes.recipe("CAPACITY") == [recipes.sanitise_step, recipes.lineage_step, recipes.capacity_step]
    assert recipes.recipe("unheard of") == recipes.recipe("lineage") == [recipes.sanitise_step, recipes.lineage_step]

    def shout(rows, load):
        return rows.withColumn("note", F.upper("note"))

    recipes.register_step("Shout", shout)
    assert recipes.recipe("shout")[-1] is shout and recipes.step_for("SHOUT") is shout
    assert recipes.kind_of_asset("A1/capacity/") == "capacity" and recipes.kind_of_asset("A1") == "default"


def test_lineage_step_needs_sidecars(spark):
    with pytest.raises(ValueError, match="sidecars"):
        recipes.lineage_step(spark.range(1), recipes.Load())


HEADER = ["Loc", "Loc Name", "DC", "OPC", "Qty Reason"]


def land(folder, name, rows, day, cycle, stamp):
    landing, meta = folder / "landing", folder / "metadata"
    landing.mkdir(exist_ok=True, parents=True)
    meta.mkdir(exist_ok=True)
    body = "\n".join([",".join(HEADER)] + [",".join(map(str, r)) for r in rows]) + "\n"
    (landing / f"{name}.csv").write_text(body)
    (meta / f"{name}.meta.json").write_text(json.dumps(
        {"cycle_name": cycle, "date": day, "download_timestamp": stamp, "endpoint": "e"}))


def first_files(folder):
    land(folder, "oac intraday 1", [(f"L{i}", "n", i, "NA", "Unavailable now") for i in range(20)], "20250608", "Intraday 1", 100.0)
    land(folder, "oac evening", [(f"L{i}", "n", i, 1, "") for i in range(20)] + [("L0", "n", 77, 1, "")], "20250608", "Evening", 200.0)
    land(folder, "oac bad", [("X", "n", -1, 1, "")] * 5 + [("Y", "n", "many", 1, "")] * 5 + [("", "n", 5, 1, "")] * 5, "20250608", "Evening", 300.0)


def test_load_folder(spark, tmp_path):
    first_files(tmp_path)
    table, watch = str(tmp_path / "table"), Observation("load")
    done = loads.load_folder(spark, str(tmp_path / "landing"), str(tmp_path / "metadata"), table,
                             now=NOW, min_bytes=50, counters=watch)
    rows = tables.read_table(spark, table)
    assert rows.count() == 45 and watch.get == {"inserted": 45, "updated": 0, "kept": 0}
    assert rows.where("loc = 'L0' and cycle_id = 'Evening'").first()["dc"] == 77.0
    line = rows.where("loc = 'L3' and cycle_id = 'Intraday_1'").first()
    assert (line["dc"], line["opc"], line["qty_reason"], line["measure_date"]) == (3.0, None, "Unavailable", DAY)
    assert rows.where("loc is null").count() == 5
    assert done.rejected.count() == 5 and done.uncastable.count() == 5
    # The same files again: keyed rows are updated, rows without a key are added.
    loads.load_folder(spark, str(tmp_path / "landing"), str(tmp_path / "metadata"), table, now=NOW, min_bytes=50)
    assert tables.read_table(spark, table).count() == 50


def stream(spark, folder, **options):
    rows = feed.read_feed_stream(spark, str(folder / "landing"), HEADER, min_bytes=50, max_files=1)
    checkpoint = str(folder / "checkpoint")
    step = ingest.feed_step(
        str(folder / "table"), str(folder / "metadata"), checkpoint, now=NOW, reports=str(folder / "reports"),
        quarantine=str(folder / "quarantine"), **options)
    ingest.start(rows, step, checkpoint).awaitTermination()
    return tables.read_table(spark, str(folder / "table"))


def test_stream_of_files(spark, tmp_path):
    first_files(tmp_path)
    assert stream(spark, tmp_path).count() == 45
    assert stream(spark, tmp_path).count() == 45  # nothing new, nothing loaded twice
    land(tmp_path, "late evening", [("L1", "n", 500, 1, "late"), ("N", "n", 1, 1, "")] * 4, "20250608", "Evening", 400.0)
    rows = stream(spark, tmp_path)
    assert rows.count() == 46
    assert rows.where("loc = 'L1' and cycle_id = 'Evening'").first()["dc"] == 500.0
    reports = spark.read.json(str(tmp_path / "reports" / "reports"))
    names = {r["file_path"].rsplit("/", 1)[-1].replace("%20", " ") for r in reports.select("file_path").collect()}
    assert names == {"oac intraday 1.csv", "oac evening.csv", "oac bad.csv", "late evening.csv"}
    bad = reports.where("file_path like '%bad.csv'").first()
    # Rows that were set aside are checked as well; what could not be typed counts as missing.
    assert bad["summary"]["record_count"] == 15
    assert any(i["description"] == "Missing values in dc: 5 records affected" for i in bad["issues"])
    assert spark.read.parquet(str(tmp_path / "quarantine" / "rejected")).count() == 5


def test_repeated_batch_of_a_stream(spark, tmp_path):
    """A batch run again after a failure leaves the table as it was."""
    first_files(tmp_path)
    stream(spark, tmp_path)
    checkpoint = str(tmp_path / "checkpoint")
    identity = ingest.stream_id(spark, checkpoint)
    for batch in range(3):
        path = tmp_path / "table__staging" / f"{identity}-{batch % 2}"
        assert path.exists()
    step = ingest.feed_step(str(tmp_path / "table"), str(tmp_path / "metadata"), checkpoint, now=NOW)
    again = feed.read_feed(spark, str(tmp_path / "landing"), HEADER, min_bytes=50)
    last = again.where(F.col("file_name") == last_file(spark, tmp_path, identity))
    step(last, 2)
    assert tables.read_table(spark, str(tmp_path / "table")).count() == 45


def last_file(spark, folder, identity):
    rows = spark.read.parquet(str(folder / "table__staging" / f"{identity}-0-rows" / "raw"))
    return rows.first()["file_name"]


def test_time_to_live_readmits(spark, tmp_path):
    def drop(name, key, arrival):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(json.dumps({"key": key, "arrival": arrival}) + "\n")
        rows = spark.readStream.schema("key string, arrival timestamp").json(str(folder))
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
        admitted = ingest.admit_once_within(rows, ["key"], "arrival", "1 day")
        admitted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start().awaitTermination()
        return sorted(r["arrival"].day for r in spark.read.schema("key string, arrival timestamp").parquet(out).where("key = 'k'").collect())

    assert drop("1.json", "k", "2025-06-01T00:00:00") == [1]
    assert drop("2.json", "k", "2025-06-01T12:00:00") == [1]
    drop("3.json", "other", "2025-06-05T00:00:00")
    assert drop("4.json", "k", "2025-06-05T12:00:00") == [1, 5]


def test_streams_keep_each_others_outputs(spark, tmp_path):
    first_files(tmp_path)
    stream(spark, tmp_path)
    before = spark.read.parquet(str(tmp_path / "quarantine" / "rejected")).count()
    rows = feed.read_feed_stream(spark, str(tmp_path / "landing"), HEADER, min_bytes=50, max_files=1)
    step = ingest.feed_step(
        str(tmp_path / "table"), str(tmp_path / "metadata"), str(tmp_path / "second"), now=NOW,
        reports=str(tmp_path / "reports"), quarantine=str(tmp_path / "quarantine"))
    ingest.start(rows, step, str(tmp_path / "second")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "quarantine" / "rejected")).count() == 2 * before
    assert spark.read.json(str(tmp_path / "reports" / "reports")).groupBy("file_path").count().where("count != 2").count() == 0


def test_sidecars_of_many_files(spark, tmp_path, monkeypatch):
    from tidegate.sources import sidecars

    first_files(tmp_path)
    files = spark.createDataFrame([("x/oac evening.csv",), ("x/oac bad.csv",), ("x/none.csv",)], "file_path string")
    found = []
    for limit in (10, 1):
        monkeypatch.setattr(sidecars, "LISTED_FILES", limit)
        found.append(sorted(r["stem"] for r in sidecars.read_sidecars(spark, str(tmp_path / "metadata"), files).collect()))
    assert found[0] == found[1] and set(found[0]) <= {"oac evening", "oac bad"}


def test_cycle_parameter_replaces_the_cycle(spark):
    from tidegate.functions.requests import request_url

    row = spark.sql("select date'2025-06-08' as day, 1 as cycle, map('cycle', '3', 'x', 'y') as params")
    url = row.select(request_url(F.lit("e"), F.col("day"), F.col("cycle"), F.col("params"), base_url="http://h/")).first()[0]
    assert url.endswith("&cycle=3&x=y") and url.count("cycle=") == 1


def test_swapped_columns_land_in_their_places(spark, tmp_path):
    for name, header, line in (("a", "Loc,Loc Name,DC,OAC", "L1,n,10,1"), ("b", "Loc,Loc Name,OAC,DC", "L3,n,1,10")):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / f"oac {name}.csv").write_text(f"{header}\n{line}\n")
    (tmp_path / "metadata").mkdir()
    (tmp_path / "metadata" / "none.meta.json").write_text("{}")
    loads.load_folder(spark, str(tmp_path / "landing"), str(tmp_path / "metadata"), str(tmp_path / "table"), now=NOW, min_bytes=1)
    rows = tables.read_table(spark, str(tmp_path / "table")).collect()
    assert sorted((r["loc"], r["dc"], r["oac"]) for r in rows) == [("L1", 10, 1), ("L3", 10, 1)]


def test_surplus_fields_and_equal_names(spark, tmp_path):
    """Longer rows are set aside whole; files of one name in two folders stay two; two sidecars make no second row."""
    for folder, header, lines in (
        ("x", "Loc,Loc Name,DC", ["L1,n,1", "L2,n,2,EXTRA", 'L3,"n, x",3', 'L4,"n, ""x",4,', "L5,n", "L6,n,6,7,8"]),
        ("y", "Loc,Loc Name,DC,OAC", ["L7,n,7,8", "L8,n,8,9,10"]),
    ):
        (tmp_path / "landing" / folder).mkdir(parents=True)
        (tmp_path / "landing" / folder / "oac.csv").write_text("\n".join([header, *lines]) + "\n")
        (tmp_path / "metadata" / folder).mkdir(parents=True)
        (tmp_path / "metadata" / folder / "oac.meta.json").write_text(
            json.dumps({"cycle_name": f"Evening {folder}", "date": "20250608", "download_timestamp": 5.0 + len(lines)}))
    landing, metadata = f"{tmp_path}/landing/*", f"{tmp_path}/metadata/*"
    done = loads.load_folder(spark, landing, metadata, str(tmp_path / "table"), now=NOW, min_bytes=1)
    rows = tables.read_table(spark, str(tmp_path / "table")).orderBy("loc").collect()
    assert [(r["loc"], r["loc_name"], r["dc"], r["oac"]) for r in rows] == [
        ("L1", "n", 1, None), ("L3", "n, x", 3, None), ("L5", "n", None, None), ("L7", "n", 7, 8)]
    assert {r["cycle_id"] for r in rows} == {"Evening_x"}
    aside = done.surplus.orderBy("file_path", "row_id").collect()
    assert [(r["file_path"][-9:], r["row_id"], r["surplus_line"]) for r in aside] == [
        ("x/oac.csv", 1, "L2,n,2,EXTRA"), ("x/oac.csv", 3, 'L4,"n, ""x",4,'), ("x/oac.csv", 5, "L6,n,6,7,8"),
        ("y/oac.csv", 1, "L8,n,8,9,10")]
