"""Streams of files: what a batch is, files that break, polling."""

from __future__ import annotations

import gzip
import json
import time

from pyspark.sql import functions as F

from tests.test_plans import HEADER, NOW, land
from tidegate.plans import loads
from tidegate.sources import feed, soundness, tables
from tidegate.streaming import batches, ingest


def files_stream(spark, folder, **options):
    checkpoint = str(folder / "checkpoint")
    step = ingest.files_step(str(folder / "table"), str(folder / "metadata"), checkpoint, quarantine=str(folder / "aside"), **options)
    return feed.read_files_stream(spark, str(folder / "landing"), min_bytes=20), step, checkpoint


def test_a_batch_run_again_is_the_same_batch(spark, tmp_path, monkeypatch):
    """Without sidecars, with null keys, at another time."""
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "x.csv").write_text("\n".join([",".join(HEADER), ",n,1,1,", "L,n,2,1,", ",n,3,1,"]) + "\n")
    (tmp_path / "metadata").mkdir()
    (tmp_path / "metadata" / "other.meta.json").write_text("{}")
    rows = feed.read_feed_stream(spark, str(tmp_path / "landing"), HEADER, min_bytes=10)
    checkpoint = str(tmp_path / "checkpoint")
    step = ingest.feed_step(str(tmp_path / "table"), str(tmp_path / "metadata"), checkpoint)
    ingest.start(rows, step, checkpoint).awaitTermination()
    first = sorted(map(str, tables.read_table(spark, str(tmp_path / "table")).collect()))
    assert len(first) == 3
    clock = time.time
    monkeypatch.setattr(time, "time", lambda: clock() + 90_000)  # past midnight
    step(feed.read_feed(spark, str(tmp_path / "landing"), HEADER, min_bytes=10), 0)
    assert sorted(map(str, tables.read_table(spark, str(tmp_path / "table")).collect())) == first


def test_record(spark, tmp_path):
    place = str(tmp_path / "slot")
    one = batches.begin(spark, place, 4, 7.0, [("p", "u")])
    assert (one.now, one.files, one.note(spark, "checked")) == (7.0, (("p", "u"),), None)
    one.reach(spark, "checked", [{"u": "e"}, {}])
    again = batches.begin(spark, place, 4, 9.0, [])
    assert again == one and again.note(spark, "checked") == [{"u": "e"}, {}]
    assert batches.begin(spark, place, 6).identity != one.identity
    assert batches.begin(spark, place, 4, 1.0).identity != one.identity  # its record went when the next one came


def test_bad_files_stand_alone(spark, tmp_path):
    for i in range(6):
        land(tmp_path, f"oac evening {i}", [(f"L{i}", "n", i, 1, "")] * 3, "20250608", "Evening", 100.0 + i)
    text = (tmp_path / "landing" / "oac evening 0.csv").read_bytes()
    (tmp_path / "landing" / "cut [1].csv.gz").write_bytes(gzip.compress(text * 200)[:-30])
    (tmp_path / "landing" / "latin.csv").write_bytes(text + "é".encode("latin-1"))
    (tmp_path / "landing" / "whole.csv.gz").write_bytes(gzip.compress(text.replace(b"L0", b"Z"), 0))
    stream, step, checkpoint = files_stream(spark, tmp_path, now=NOW)
    ingest.start(stream, step, checkpoint).awaitTermination()
    want = {f"L{i}" for i in range(6)} | {"Z"}

    def loaded():
        return {r["loc"] for r in tables.read_table(spark, str(tmp_path / "table")).collect()}

    assert loaded() == want
    aside = spark.read.parquet(str(tmp_path / "aside" / "unreadable"))
    errors = {r["file_path"].rsplit("/", 1)[1]: r["error"] for r in aside.collect()}
    assert set(errors) == {"cut%20%5B1%5D.csv.gz", "latin.csv"} and errors["latin.csv"] == "not UTF-8: 1 lines"
    assert "EOF" in errors["cut%20%5B1%5D.csv.gz"] or "end of" in errors["cut%20%5B1%5D.csv.gz"]
    # A file mended meanwhile does not enter a batch that is run again; it comes with the next one, as a new file.
    (tmp_path / "landing" / "latin.csv").write_bytes(text.replace(b"L0", b"NEW"))
    step(spark.createDataFrame([], "path string, file_path string"), 0)
    assert loaded() == want and spark.read.parquet(str(tmp_path / "aside" / "unreadable")).count() == 2


def test_all_files_bad(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "metadata").mkdir()
    (tmp_path / "landing" / "a.csv.gz").write_bytes(b"\x1f\x8bno gzip at all, but long enough")
    stream, step, checkpoint = files_stream(spark, tmp_path, now=NOW)
    ingest.start(stream, step, checkpoint).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "aside" / "unreadable")).count() == 1


def test_files_gone_and_other_failures(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("a,b\n1,2\n")
    found = soundness.check_files(spark, [f"file:{good}", f"file:{tmp_path}/gone.csv"], str(tmp_path / "at"))
    assert list(found.broken) == [f"file:{tmp_path}/gone.csv"]
    assert [(r["header"], r["lines"]) for r in found.sound.collect()] == [("a,b", 2)]


def test_folder_with_a_bad_file(spark, tmp_path):
    for i in range(3):
        land(tmp_path, f"oac evening {i}", [(f"L{i}", "n", i, 1, "")] * 3, "20250608", "Evening", 100.0 + i)
    text = (tmp_path / "landing" / "oac evening 0.csv").read_bytes()
    (tmp_path / "landing" / "cut.csv.gz").write_bytes(gzip.compress(text * 300)[:-40])
    for header in (None, HEADER):
        table = str(tmp_path / f"table{header is None}")
        done = loads.load_folder(spark, str(tmp_path / "landing"), str(tmp_path / "metadata"), table, header=header, now=NOW, min_bytes=20)
        assert {r["loc"] for r in tables.read_table(spark, table).collect()} == {"L0", "L1", "L2"}
        issues = [r["type"] for r in done.unreadable.where(F.col("file_path").endswith("cut.csv.gz")).collect()]
        assert issues == ["UNREADABLE_FILE"]


def test_polling_at_an_interval(spark, tmp_path):
    land(tmp_path, "oac evening 1", [("A", "n", 1, 1, "")] * 3, "20250608", "Evening", 100.0)
    stream, step, checkpoint = files_stream(spark, tmp_path, now=NOW)
    running = ingest.start(stream, step, checkpoint, every="1 second")
    try:
        def wait_for(names):
            until = time.time() + 120
            while time.time() < until:
                table = str(tmp_path / "table")
                if (tmp_path / "table").exists() and {r["loc"] for r in tables.read_table(spark, table).collect()} == names:
                    return True
                time.sleep(0.5)
            return False

        assert wait_for({"A"})
        body = "Loc Name,Loc,Extra Text,DC\n" + "n,B,x,5\n" * 3  # another layout arrives while the stream runs
        (tmp_path / "metadata" / "late.meta.json").write_text(json.dumps({"cycle_name": "Evening", "date": "20250608", "download_timestamp": 5.0}))
        (tmp_path / "late.tmp").write_text(body.replace(",Extra Text", ",TSQ").replace(",x,", ",4,"))
        (tmp_path / "late.tmp").rename(tmp_path / "landing" / "late.csv")
        assert wait_for({"A", "B"}) and running.isActive
    finally:
        running.stop()
