from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidegate.operators import lineage
from tidegate.operators.clean import infer_types, named_columns, nan_to_null, split_casts
from tidegate.schema import SIDECAR_SCHEMA, capacity_schema
from tidegate.sources import feed, ledger
from tidegate.sources.sidecars import append_manifest, read_manifest, read_sidecars, sidecars_of

HEADER = "Loc,Loc Name,DC,Qty Reason"
NOW = dt.datetime(2025, 7, 1, 12, tzinfo=dt.timezone.utc).timestamp()


def write_feed(path, rows=20, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [header] + [f"{i},\"name, {i}\",{i}.5,{'NA' if i % 2 else 'is unavailable'}" for i in range(rows)]
    path.write_text("\n".join(lines) + "\n")


def test_scan_skips_what_is_no_feed(spark, tmp_path):
    write_feed(tmp_path / "cap intraday 1.csv")
    write_feed(tmp_path / "upper.CSV", 15)
    write_feed(tmp_path / "notes.txt")
    (tmp_path / "tiny.csv").write_text(HEADER + "\n1,2,3,4\n")
    exact = tmp_path / "exact.csv"
    exact.write_text(HEADER + "\n" + "9" * (200 - len(HEADER) - 1))
    assert exact.stat().st_size == 200
    rows = feed.read_feed(spark, str(tmp_path))
    counts = {r[0]: r[1] for r in rows.groupBy("file_name").count().collect()}
    assert counts == {"cap intraday 1.csv": 20, "upper.CSV": 15, "exact.csv": 1}
    first = rows.where("file_name = 'upper.CSV' and loc = '3'").first()
    assert (first["loc_name"], first["dc"], first["qty_reason"]) == ("name, 3", "3.5", None)
    listed = {r["file_name"]: r["file_size"] for r in feed.list_files(spark, str(tmp_path)).collect()}
    assert set(listed) == {"cap intraday 1.csv", "upper.CSV", "tiny.csv", "exact.csv"}


def test_vanished_files_are_skipped(spark, tmp_path):
    write_feed(tmp_path / "a.csv")
    write_feed(tmp_path / "b.csv")
    rows = feed.read_feed(spark, str(tmp_path))
    (tmp_path / "b.csv").unlink()
    assert rows.count() == 20


def test_row_index_over_many_splits(spark, tmp_path):
    for name, rows in (("one.csv", 3001), ("two.csv", 17), ("three.csv", 900)):
        write_feed(tmp_path / name, rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = feed.read_feed(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 20
        indexed = feed.with_row_index(rows)
        assert indexed.count() == 3918
        assert indexed.where(F.col("row_id") != F.col("loc").cast("long")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_union_of_layouts(spark, tmp_path):
    write_feed(tmp_path / "a" / "a.csv")
    write_feed(tmp_path / "b" / "b.csv", header="Loc,Loc Name,OAC,Qty Reason")
    both = feed.union_feeds(*[feed.read_feed(spark, str(tmp_path / d)) for d in "ab"])
    assert both.where("dc is null").count() == both.where("oac is null").count() == 20


def test_mixed_layouts_in_one_folder(spark, tmp_path):
    write_feed(tmp_path / "a one.csv")
    write_feed(tmp_path / "b.csv", 30, "Loc,OAC,Loc Name,Qty Reason")
    write_feed(tmp_path / "c.csv", 25)
    (tmp_path / "tiny.csv").write_text("other\n1\n")
    rows = feed.with_row_index(feed.read_layouts(spark, str(tmp_path)))
    assert {"loc", "loc_name", "dc", "oac", "qty_reason"} <= set(rows.columns) and "other" not in rows.columns
    assert rows.where(F.col("row_id") == F.col("loc").cast("long")).count() == rows.count() == 75
    b = rows.where("file_name = 'b.csv' and loc = '3'").first()
    assert (b["oac"], b["loc_name"], b["dc"]) == ("name, 3", "3.5", None)
    assert feed.read_layouts(spark, str(tmp_path), min_bytes=10**6).count() == 0


def test_any_number_of_layouts(spark, tmp_path):
    for i in range(101):
        (tmp_path / f"f{i}.csv").write_text(f"Loc,Own {i},DC\nL{i},x{i},{i}\n" if i % 2 else f"DC,Loc,Own {i}\n{i},L{i},x{i}\n")
    rows = feed.read_layouts(spark, str(tmp_path), min_bytes=1, index="row_id").collect()
    assert {(r["loc"], r["dc"], r[f"own_{r['dc']}"], r["row_id"]) for r in rows} == {(f"L{i}", str(i), f"x{i}", 0) for i in range(101)}


def test_infer_types(spark):
    df = spark.createDataFrame(
        [("1", "1", "1.5", "True", "x", None, "true"), ("2", None, "2", "FALSE", "2", None, None)],
        "a string, b string, c string, d string, e string, f string, g string",
    )
    assert [t for _, t in infer_types(df).dtypes] == [
        "bigint", "double", "double", "boolean", "string", "double", "string",
    ]


def test_typed_rows_and_quarantine(spark):
    df = spark.createDataFrame(
        [(0, "1", "2.5", "2025-01-01"), (1, "x", "bad", "2025-02-30"), (2, None, None, None)],
        "row_id int, loc string, dc string, measure_date string",
    )
    accepted, rejected = split_casts(df, capacity_schema(), keep=["row_id"])
    assert [r["row_id"] for r in accepted.orderBy("row_id").collect()] == [0, 2]
    assert accepted.schema["measure_date"].dataType.simpleString() == "date"
    bad = rejected.first()
    assert (bad["row_id"], bad["dc"], bad["cast_errors"]) == (1, "bad", ["dc", "measure_date"])
    with pytest.raises(ValueError, match="unknown|not in"):
        split_casts(df.withColumn("extra", F.lit(1)), capacity_schema(), keep=["row_id"])


def test_nan_and_unnamed_columns(spark):
    df = spark.createDataFrame(
        [(1, 1.1, "a", True, dt.date(2023, 1, 1)), (2, float("nan"), "b", False, None), (None, 3.3, None, None, None)],
        "i int, f double, s string, b boolean, d date",
    )
    rows = nan_to_null(df).collect()
    assert [r["f"] for r in rows] == [1.1, None, 3.3] and len(rows) == 3
    blank = df.toDF("i", "", "s", "b", "")
    assert named_columns(blank).columns == ["i", "s", "b"]


def write_sidecar(folder, stem, body):
    folder.mkdir(exist_ok=True)
    (folder / f"{stem}.meta.json").write_text(body if isinstance(body, str) else json.dumps(body, indent=2))


def test_lineage_fallbacks(spark, tmp_path):
    landing, meta = tmp_path / "landing", tmp_path / "metadata"
    stamp = dt.datetime(2025, 6, 10, 3, tzinfo=dt.timezone.utc).timestamp()
    names = ["full", "intraday 2 nocycle", "slash", "epoch", "odd", "broken intraday 1 01-02-2025", "nodate",
             "alone intraday 12 06-08-2025", "alone"]
    for name in names:
        write_feed(landing / f"{name}.csv")
    write_sidecar(meta, "full", {"cycle_name": "Intraday 1", "date": "20250608", "download_timestamp": stamp})
    write_sidecar(meta, "intraday 2 nocycle", {"cycle_name": "", "date": "2025-06-08", "download_timestamp": stamp})
    write_sidecar(meta, "slash", {"cycle_name": "Evening", "date": "06/08/2025", "download_timestamp": 0})
    write_sidecar(meta, "epoch", {"cycle_name": "Evening", "date": 1749340800, "download_timestamp": stamp})
    write_sidecar(meta, "odd", {"cycle_name": "Evening", "date": "June 8", "download_timestamp": stamp})
    write_sidecar(meta, "broken intraday 1 01-02-2025", "{ not json")
    write_sidecar(meta, "nodate", {"download_timestamp": stamp})

    rows = feed.read_feed(spark, str(landing))
    sidecars = read_sidecars(spark, str(meta))
    resolved = lineage.resolve_lineage(lineage.files_of(rows), sidecars, NOW)
    found = {r["file_name"][:-4]: r for r in resolved.collect()}
    gas, downloaded, today = dt.date(2025, 6, 8), dt.date(2025, 6, 10), dt.date(2025, 7, 1)
    expected = {
        "full": ("Intraday_1", gas),
        "intraday 2 nocycle": ("Intraday_2", gas),
        "slash": ("Evening", gas),
        "epoch": ("Evening", gas),
        "odd": ("Evening", downloaded),
        "broken intraday 1 01-02-2025": ("Unknown_Cycle", today),
        "nodate": ("Unknown_Cycle", downloaded),
        "alone intraday 12 06-08-2025": ("Intraday_12", gas),
        "alone": ("Unknown_Cycle", today),
    }
    assert {k: (r["cycle_id"], r["measure_date"]) for k, r in found.items()} == expected
    assert found["full"]["download_timestamp"] == stamp
    modified = (landing / "slash.csv").stat().st_mtime
    assert abs(found["slash"]["download_timestamp"] - modified) < 1
    assert found["alone"]["download_timestamp"] == found["broken intraday 1 01-02-2025"]["download_timestamp"] == NOW

    compat = lineage.resolve_lineage(lineage.files_of(rows), sidecars, NOW, compat_dates=True)
    days = {r["file_name"][:-4]: r["measure_date"] for r in compat.collect()}
    assert days["full"] == downloaded and days["slash"] == gas

    small = lineage.attach_lineage(rows, resolved).orderBy("file_name", "loc").collect()
    cut = lineage.attach_lineage(rows, resolved, broadcast_files=0, segment_bytes=64).orderBy("file_name", "loc").collect()
    assert small == cut and len(small) == 20 * len(names)
    complete = rows.withColumns({c: F.lit(1) for c in ("measure_date", "cycle_id", "download_timestamp")})
    assert lineage.attach_lineage(complete, resolved) is complete


def test_today_in_compat_mode_becomes_download_day(spark, tmp_path):
    write_feed(tmp_path / "l" / "a.csv")
    stamp = NOW - 3 * 86400
    write_sidecar(tmp_path / "m", "a", {"cycle_name": "E", "date": "2025-07-01", "download_timestamp": stamp})
    files = lineage.files_of(feed.read_feed(spark, str(tmp_path / "l")))
    side = read_sidecars(spark, str(tmp_path / "m"))
    assert lineage.resolve_lineage(files, side, NOW, True).first()["measure_date"] == dt.date(2025, 6, 28)
    assert lineage.resolve_lineage(files, side, NOW).first()["measure_date"] == dt.date(2025, 7, 1)


def test_manifest_latest_record_counts(spark, tmp_path):
    path = str(tmp_path / "manifest")
    record = ("e", 1, "Evening", "20250608", "o.csv", "o.csv", "t", 5.0)
    append_manifest(spark.createDataFrame([record], SIDECAR_SCHEMA), path)
    append_manifest(spark.createDataFrame([(*record[:2], "Intraday 1", *record[3:7], 9.0)], SIDECAR_SCHEMA), path)
    sides = sidecars_of(read_manifest(spark, path)).collect()
    assert len(sides) == 1 and sides[0]["cycle_name"] == "Intraday 1" and sides[0]["stem"] == "o"


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.read_ledger(spark, path).count() == 0
    ledger.append_ledger(spark.createDataFrame([("a", 1.0), ("b", 2.0)], ledger.LEDGER_SCHEMA), path)
    ledger.append_ledger(spark.createDataFrame([("a", 5.0)], ledger.LEDGER_SCHEMA), path)
    known = ledger.read_ledger(spark, path)
    assert {tuple(r) for r in known.collect()} == {("a", 5.0), ("b", 2.0)}
    # An age of exactly the time to live is still fresh.
    assert {r[0] for r in ledger.fresh_entries(known, 15.0, 10).collect()} == {"a"}
    assert {r[0] for r in ledger.fresh_entries(known, 15.1, 10).collect()} == set()
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text('{"k": 1.5, "l": 2}')
    bad.write_text("not json")
    assert {tuple(r) for r in ledger.read_ledger_json(spark, str(good)).collect()} == {("k", 1.5), ("l", 2.0)}
    assert ledger.read_ledger_json(spark, str(bad)).count() == 0
    assert ledger.read_ledger_json(spark, str(tmp_path / "none.json")).count() == 0
