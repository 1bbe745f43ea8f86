"""Loads that become visible at once, rewrite little, and answer for their keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_tables import D1, D2, D3, KEYS, NOW, OLD, SCHEMA, content, source, target
from tidegate.sources import tables, versions


def merge(spark, path, rows, **options):
    return tables.merge_into(spark, path, source(spark, rows), ["ord"], KEYS, SCHEMA, now=F.lit(NOW), **options)


def locs(spark, path):
    return sorted((r["loc"], r["measure_date"].day, r["dc"]) for r in tables.read_table(spark, path, SCHEMA).collect())


def test_a_load_that_fails_half_way_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge(spark, path, [(1, "a", D1, 1.0), (2, "b", D2, 2.0)])

    def fail(*_):
        raise OSError("no manifest")

    load = [(1, "a", D1, 9.0), (2, "b", D2, 9.0), (3, None, D2, 5.0)]
    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", fail)
        with pytest.raises(OSError):
            merge(spark, path, load, batch=4)
    assert locs(spark, path) == [("a", 1, 1.0), ("b", 2, 2.0)]  # both days are as they were
    made = sorted(p for p in (tmp_path / "t" / "_loads").rglob("*.parquet") if "load=load-4-" in str(p))
    stamps = [p.stat().st_mtime_ns for p in made]
    for _ in range(2):  # the repeat finishes it, another one changes nothing
        merge(spark, path, load, batch=4)
        assert tables.read_table(spark, path, SCHEMA).count() == 3
    assert made and stamps == [p.stat().st_mtime_ns for p in made]  # nothing was computed again


def test_a_load_rewrites_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    first = merge(spark, path, [(i, f"k{i}", D1, 1.0) for i in range(400)] + [(i, f"k{i}", D2, 1.0) for i in range(400)])
    assert first.parts == 2 * tables.BUCKETS and first.rows == 800
    small = merge(spark, path, [(1, "k7", D1, 2.0)])
    assert small.parts == 1 and small.files == 1 and small.rows < 400 / tables.BUCKETS * 2
    assert small.bytes < first.bytes / tables.BUCKETS
    assert locs(spark, path) == sorted([(f"k{i}", d, 2.0 if (i, d) == (7, 1) else 1.0) for i in range(400) for d in (1, 2)])


def test_readers_keep_their_version_for_some_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    merge(spark, path, [(1, "a", D1, 0.0)])
    before = tables.read_table(spark, path, SCHEMA)
    for i in range(versions.KEEP - 1):
        merge(spark, path, [(1, "a", D1, float(i + 1))])
    assert [r["dc"] for r in before.collect()] == [0.0]
    for i in range(4):
        merge(spark, path, [(1, "a", D1, 10.0 + i)])
    assert len(list((tmp_path / "t" / "_versions").glob("v*.json"))) == versions.KEEP
    assert len(list((tmp_path / "t" / "_loads").iterdir())) <= versions.KEEP + 1
    assert locs(spark, path) == [("a", 1, 13.0)]


def test_a_load_beaten_by_another_begins_again(spark, tmp_path, monkeypatch):
    path, commit, others = str(tmp_path / "t"), versions.commit, []
    merge(spark, path, [(1, "a", D1, 1.0)])

    def slow(*args):
        if not others:
            others.append(True)
            merge(spark, path, [(1, "a", D1, 2.0), (2, "z", D3, 3.0)], writer="other")
        return commit(*args)

    monkeypatch.setattr(versions, "commit", slow)
    merge(spark, path, [(1, "b", D1, 5.0)])
    assert locs(spark, path) == [("a", 1, 2.0), ("b", 1, 5.0), ("z", 3, 3.0)]


def test_keys_are_not_asked_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    target(spark, [("a", D1, 5.0, "", OLD), ("b", D2, 6.0, "", OLD)]).write.partitionBy("measure_date").parquet(path)
    read, asked = versions.read_parts, []

    def watched(spark_, path_, parts, schema):
        asked.append([p.folder for p in parts])
        return read(spark_, path_, parts, schema)

    monkeypatch.setattr(versions, "read_parts", watched)
    assert tables.unique_keys(spark, path, KEYS, SCHEMA)
    assert asked == [["measure_date=2025-06-01", "measure_date=2025-06-02"]]  # once, as nobody has counted them
    for load, how in (([(1, "c", D1, 1.0)], "upsert"), ([(1, "c", D1, 1.0)], "upsert")):
        assert tables.load(spark, path, source(spark, load), ["ord"], KEYS, SCHEMA) == how
    asked.clear()
    assert tables.unique_keys(spark, path, KEYS, SCHEMA) and asked == []
    tables.append_into(spark, path, source(spark, [(1, "c", D1, 1.0)]), SCHEMA, order_by=["ord"], keys=KEYS)
    assert all("2025-06-01" in f for parts in asked for f in parts)  # what is added is counted with its own day
    asked.clear()
    assert not tables.unique_keys(spark, path, KEYS, SCHEMA) and asked == []
    assert tables.load(spark, path, source(spark, [(1, "q", D3, 1.0)]), ["ord"], KEYS, SCHEMA) == "append"
    assert content(tables.read_table(spark, path, SCHEMA).select("loc")) == [("a",), ("b",), ("c",), ("c",), ("q",)]
    assert not tables.unique_keys(spark, path, ["measure_date"], SCHEMA)  # other keys: the whole table is read
    assert not tables.unique_keys(spark, path, ["loc", "absent"], SCHEMA)


def test_a_key_wider_than_the_buckets(spark, tmp_path):
    """Keys of a load that do not decide the bucket are looked for in the whole day."""
    path = str(tmp_path / "t")
    merge(spark, path, [(i, f"k{i}", D1, 1.0) for i in range(30)])
    tables.merge_into(spark, path, source(spark, [(1, "x", D1, 1.0)]), ["ord"], ["measure_date", "dc"], SCHEMA, now=F.lit(NOW))
    assert {r["loc"] for r in tables.read_table(spark, path, SCHEMA).collect()} == {"x"}  # all rows had that key
