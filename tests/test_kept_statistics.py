"""Sketches that merge, numbers of rows, a ledger that shrinks, exact expiry."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from tests.test_tables import D1, D2, KEYS, NOW, SCHEMA, source
from tidegate.operators import sketches
from tidegate.operators.surrogate import marked, numbered
from tidegate.sources import ledger, tables, versions
from tidegate.streaming import ingest


def test_sketches_of_files_say_what_their_rows_say(spark, tmp_path):
    dice = random.Random(3)
    rows = [(f"f{i % 7}", f"L{dice.randrange(900)}", None if i % 50 == 0 else dice.gauss(10, 3)) for i in range(9000)]
    df = spark.createDataFrame(rows, "file string, loc string, dc double").repartition(4)
    path = str(tmp_path / "sketches")
    for batch in range(2):
        own = df.where(F.pmod(F.xxhash64("file"), F.lit(2)) == batch)
        for _ in range(2):
            sketches.store(sketches.sketch(own, ["file"], ["loc"], ["dc"]), path, "w", batch)
    stored = sketches.stored(spark, path)
    assert stored.count() == 7
    whole = sketches.estimates(sketches.merge(stored), [0.1, 0.5, 0.9]).first()
    values = sorted(v for *_, v in rows if v is not None)
    assert whole["row_count"] == 9000 and abs(whole["n_loc"] - len({r[1] for r in rows})) <= 0.03 * 900
    for rank, found in zip((0.1, 0.5, 0.9), whole["q_dc"]):
        assert abs(sum(v <= found for v in values) / len(values) - rank) < 0.015
    one = sketches.estimates(stored.where("file = 'f3'")).first()
    assert one["row_count"] == sum(r[0] == "f3" for r in rows)
    empty = spark.createDataFrame([("x", None, None)] * 3, "file string, loc string, dc double")
    line = sketches.estimates(sketches.merge(sketches.sketch(empty, ["file"], ["loc"], ["dc"]), ["file"])).first()
    assert (line["row_count"], line["n_loc"], line["q_dc"]) == (3, 0, None)


def test_numbers_are_dense(spark, tmp_path):
    rows = spark.range(0, 1000, numPartitions=7).where("id % 3 != 0 and id not between 200 and 500").withColumnRenamed("id", "v")
    staged = tables.stage(marked(rows), str(tmp_path / "rows"))
    got = [r["n"] for r in numbered(staged, "n", 40).collect()]
    assert sorted(got) == list(range(41, 41 + rows.count()))


def test_numbers_over_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("id", T.LongType()), *SCHEMA.fields])

    def merge(rows, **options):
        tables.merge_into(spark, path, source(spark, rows), ["ord"], KEYS, schema, now=F.lit(NOW), number="id", **options)
        return {(r["loc"], r["measure_date"]): r["id"] for r in tables.read_table(spark, path, schema).collect()}

    first = merge([(i, f"k{i}", D1, 1.0) for i in range(30)])
    assert sorted(first.values()) == list(range(1, 31))
    second = merge([(i, f"k{i}", D1, 2.0) for i in range(20, 40)], batch=1)
    assert merge([(i, f"k{i}", D1, 2.0) for i in range(20, 40)], batch=1) == second  # run again
    assert {k: second[k] for k in first} == first and sorted(second.values()) == list(range(1, 41))
    third = merge([(1, "k1", D2, 1.0), (2, None, D2, 1.0), (3, None, D2, 1.0)])
    assert len(third) == 42 and versions.latest(spark, path).highest == 43


def test_ledger_shrinks(spark, tmp_path):
    path = str(tmp_path / "ledger")

    def add(rows):
        ledger.append_ledger(spark.createDataFrame(rows, "cache_key string, ts double"), path)

    assert ledger.compact_ledger(spark, path, 100.0, 10.0) == 0
    for i in range(8):
        add([(f"k{j}", float(50 + i * 5 + j % 3)) for j in range(20)] + [("old", 1.0)])
        want = {(r["cache_key"], r["ts"]) for r in ledger.read_ledger(spark, path).collect()}
        fresh = {(k, t) for k, t in want if 60.0 - t <= 10.0}
        assert ledger.compact_ledger(spark, path, 60.0, 10.0) == len(fresh)
        assert {(r["cache_key"], r["ts"]) for r in ledger.read_ledger(spark, path).collect()} == fresh
        assert not list((tmp_path / "ledger").glob("*.parquet"))
    assert len(list((tmp_path / "ledger").rglob("*.parquet"))) <= (versions.KEEP + 1) * ledger.BUCKETS
    add([("k1", 200.0)])
    assert {r["ts"] for r in ledger.read_ledger(spark, path).where("cache_key = 'k1'").collect()} == {200.0}


def test_a_compaction_that_fails_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    ledger.append_ledger(spark.createDataFrame([("a", 9.0), ("b", 1.0)], "cache_key string, ts double"), path)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            ledger.compact_ledger(spark, path, 10.0, 5.0)
    assert ledger.read_ledger(spark, path).count() == 2
    with monkeypatch.context() as patch:  # the files stay although the version is there
        patch.setattr(ledger, "remove", lambda *_: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            ledger.compact_ledger(spark, path, 10.0, 5.0)
    assert {r["cache_key"] for r in ledger.read_ledger(spark, path).collect()} == {"a", "b"}
    assert ledger.compact_ledger(spark, path, 10.0, 5.0) == 1 and ledger.read_ledger(spark, path).count() == 1


def test_expiry_to_the_microsecond(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start = dt.datetime(2025, 6, 1, 12, tzinfo=dt.timezone.utc)
    ttl = 3600

    def run(rows):
        spark.createDataFrame([(k, start + d if d is not None else None) for k, d in rows], "key string, arrival timestamp").write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema("key string, arrival timestamp").parquet(str(folder))
        admitted = ingest.admit_exactly(stream, ["key"], "arrival", ttl, "2 hours")
        admitted.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        found = spark.read.schema("key string, arrival timestamp").parquet(out).select("key", (F.unix_micros("arrival") - F.lit(int(start.timestamp() * 1e6))).alias("at"))
        return sorted((str(r["key"]), r["at"]) for r in found.collect())

    s = dt.timedelta(seconds=1)
    us = dt.timedelta(microseconds=1)
    first = run([("a", 0 * s), ("a", ttl * s), ("b", 5 * s), ("b", (ttl + 5) * s + us), (None, 0 * s), (None, 1 * s), ("c", None)])
    assert first == [("None", 0), ("a", 0), ("b", 5_000_000), ("b", (ttl + 5) * 1_000_000 + 1)]
    # One second more than the time to live, in the next batch; an age below it, and an arrival before the last admission, are not.
    second = run([("a", (ttl + 1) * s), ("a", (2 * ttl + 1) * s), ("b", (ttl + 1) * s), ("b", (2 * ttl + 5) * s)])
    assert second == sorted([*first, ("a", (ttl + 1) * 1_000_000)])
    run([("z", 50 * ttl * s)])  # the watermark passes all that is held, and timers drop it
    assert ("a", 60 * ttl * 1_000_000) in run([("a", 60 * ttl * s)])
