from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Observation, functions as F, types as T

from tidegate.operators import upsert as up
from tidegate.schema import capacity_schema
from tidegate.session import shared_dir
from tidegate.sources import tables

SCHEMA = T.StructType([
    T.StructField("loc", T.StringType()),
    T.StructField("measure_date", T.DateType()),
    T.StructField("dc", T.DoubleType()),
    T.StructField("note", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
KEYS = ["loc", "measure_date"]
D1, D2, D3 = (dt.date(2025, 6, d) for d in (1, 2, 3))
OLD, NOW = dt.datetime(2025, 1, 1), dt.datetime(2025, 7, 1)


def target(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def source(spark, rows, columns="ord int, loc string, measure_date date, dc double"):
    return spark.createDataFrame(rows, columns)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_rules(spark):
    table = target(spark, [("a", D1, 5.0, "keep", OLD), ("b", D1, 6.0, "b", OLD), (None, D1, 7.0, "n", OLD)])
    load = source(spark, [(1, "a", D1, 1.0), (2, "a", D1, None), (3, "c", D1, 2.0), (4, None, D1, 3.0), (5, None, D1, 3.0)])
    merged = up.upsert(table, load, ["ord"], KEYS, F.lit(NOW))
    assert content(merged) == content(target(spark, [
        ("a", D1, None, "keep", OLD),  # null overwrites, other columns and creation stay
        ("b", D1, 6.0, "b", OLD),
        (None, D1, 7.0, "n", OLD),
        ("c", D1, 2.0, None, NOW),
        (None, D1, 3.0, None, NOW),  # null keys never match
        (None, D1, 3.0, None, NOW),
    ]))


def test_upsert_counters(spark):
    table = target(spark, [("a", D1, 5.0, "keep", OLD), ("b", D1, 6.0, "b", OLD)])
    load = source(spark, [(1, "a", D1, 1.0), (2, "c", D1, 2.0), (3, "d", D1, 2.0)])
    watch = Observation("load")
    up.upsert(table, load, ["ord"], KEYS, with_action=True).observe(watch, *up.action_counts()).collect()
    assert watch.get == {"inserted": 2, "updated": 1, "kept": 1}


def test_only_key_columns_means_insert_if_absent(spark):
    table = target(spark, [("a", D1, 5.0, "keep", OLD)])
    load = source(spark, [(1, "a", D1, 1.0), (2, "z", D2, 2.0), (3, "z", D2, 9.0)])
    ignored = up.insert_absent(table, load, ["ord"], KEYS, F.lit(NOW))
    assert content(ignored) == content(target(spark, [("a", D1, 5.0, "keep", OLD), ("z", D2, 2.0, None, NOW)]))
    keys_only = up.upsert(table, load.drop("dc"), ["ord"], KEYS, F.lit(NOW), with_action=True)
    assert {(r["loc"], r["dc"], r["row_action"]) for r in keys_only.collect()} == {("a", 5.0, "kept"), ("z", None, "inserted")}


def test_wrong_columns_are_refused(spark):
    table = target(spark, [])
    with pytest.raises(ValueError, match="key columns missing"):
        up.upsert(table, source(spark, []).drop("loc"), ["ord"], KEYS)
    with pytest.raises(ValueError, match="unknown"):
        up.upsert(table, source(spark, []).withColumn("extra", F.lit(1)), ["ord"], KEYS)


def test_upsert_agrees_with_a_dict(spark):
    dice = random.Random(2)
    days = [D1, D2, D3]
    pick = lambda: (dice.choice("abcdefgh"), dice.choice(days))
    state = {pick(): (float(i), f"n{i}", OLD) for i in range(12)}
    table = target(spark, [(*k, *v) for k, v in state.items()])
    for _ in range(3):
        load = [(i, *pick(), dice.choice([None, float(i)])) for i in range(30)]
        for _, loc, day, dc in load:
            old = state.get((loc, day))
            state[loc, day] = (dc, old[1], old[2]) if old else (dc, None, NOW)
        dice.shuffle(load)
        table = up.upsert(table, source(spark, load), ["ord"], KEYS, F.lit(NOW))
        table = spark.createDataFrame(table.collect(), SCHEMA)
    assert content(table) == sorted(((*k, *v) for k, v in state.items()), key=str)


def test_check_keeps_unknown(spark):
    rows = spark.createDataFrame(
        [(1, None, 1.0), (2, None, -1.0), (3, 1.0, 0.0), (4, -1.0, None), (5, None, None)], "id int, dc double, opc double"
    )
    accepted, rejected = up.split_check(rows)
    assert {r["id"] for r in accepted.collect()} == {1, 3, 5}
    assert {r["id"] for r in rejected.collect()} == {2, 4}


def test_merge_into_rewrites_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.ensure_table(spark, path, SCHEMA).count() == 0
    target(spark, [("a", D1, 5.0, "x", OLD), ("b", D2, 6.0, "y", OLD), ("q", None, 1.0, "z", OLD)]).write.mode(
        "append").partitionBy("measure_date").parquet(path)
    before = {p.name for p in (tmp_path / "t" / "measure_date=2025-06-02").glob("*.parquet")}
    load = source(spark, [(1, "a", D1, 1.0), (2, "c", D3, 2.0), (3, "r", None, 4.0)])
    watch = Observation("merge")
    tables.merge_into(spark, path, load, ["ord"], KEYS, SCHEMA, now=F.lit(NOW), counters=watch)
    assert content(tables.read_table(spark, path, SCHEMA)) == content(target(spark, [
        ("a", D1, 1.0, "x", OLD), ("b", D2, 6.0, "y", OLD), ("c", D3, 2.0, None, NOW),
        ("q", None, 1.0, "z", OLD), ("r", None, 4.0, None, NOW),
    ]))
    assert watch.get == {"inserted": 2, "updated": 1, "kept": 1}
    assert {p.name for p in (tmp_path / "t" / "measure_date=2025-06-02").glob("*.parquet")} == before
    touched = tables.touched_partitions(tables.read_table(spark, path, SCHEMA), load)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(measure_date" in plan or "PartitionFilters: [((" in plan


def test_repeated_batch_is_not_loaded_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    load = source(spark, [(1, "a", D1, 1.0), (2, None, D1, 2.0)])
    for batch in (0, 0, 1, 1):
        tables.merge_into(spark, path, load, ["ord"], KEYS, SCHEMA, now=F.lit(NOW), batch=batch)
    # The keyless row was inserted once per batch, however often each was repeated.
    assert tables.read_table(spark, path, SCHEMA).count() == 3
    tables.merge_into(spark, path, load, ["ord"], KEYS, SCHEMA, now=F.lit(NOW), batch=1, writer="other")
    assert tables.read_table(spark, path, SCHEMA).count() == 4


def test_empty_load_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (None, 0):
        tables.merge_into(spark, path, source(spark, []), ["ord"], KEYS, SCHEMA, batch=batch)
    assert tables.read_table(spark, path, SCHEMA).count() == 0


def test_partition_must_be_part_of_the_key(spark, tmp_path):
    with pytest.raises(ValueError, match="key columns"):
        tables.merge_into(spark, str(tmp_path / "t"), source(spark, []), ["ord"], ["loc"], SCHEMA)


def test_load_appends_without_a_usable_key(spark, tmp_path):
    path = str(tmp_path / "t")
    load = source(spark, [(1, "a", D1, 1.0)])
    assert tables.load(spark, path, load, ["ord"], KEYS, SCHEMA) == "upsert"
    tables.append_into(spark, path, load, SCHEMA, order_by=["ord"])
    assert tables.load(spark, path, load, ["ord"], KEYS, SCHEMA) == "append"
    assert tables.read_table(spark, path, SCHEMA).count() == 3


def test_default_table(spark, tmp_path):
    path = str(tmp_path / "capacity")
    assert tables.ensure_table(spark, path).schema.names == capacity_schema().names
    exact = capacity_schema(exact_numbers=True)
    assert exact["dc"].dataType == T.DecimalType(38, 6) and len(exact) == 19


def test_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared_dir(Session()) == "hdfs:///shared"


def test_batch_number_with_other_rows_is_loaded(spark, tmp_path):
    path = str(tmp_path / "table")
    for name in ("a", "zz", "zz"):  # the last one is a repeat
        tables.merge_into(spark, path, source(spark, [(1, name, D1, 1.0)]), ["ord"], KEYS, SCHEMA, batch=1)
    assert sorted(r["loc"] for r in tables.read_table(spark, path, SCHEMA).collect()) == ["a", "zz"]


def test_duplicate_key_on_another_day_is_seen(spark, tmp_path):
    path = str(tmp_path / "table")
    target(spark, [("a", D1, 5.0, "", OLD), ("a", D1, 6.0, "", OLD)]).write.partitionBy("measure_date").parquet(path)
    assert tables.load(spark, path, source(spark, [(1, "b", D2, 1.0)]), ["ord"], KEYS, SCHEMA) == "append"


def test_repeated_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_into(spark, path, source(spark, [(1, "a", D1, 1.0), (2, "a", D1, 2.0)]), SCHEMA, order_by=["ord"])
    load = source(spark, [(1, "a", D1, 3.0), (2, "b", D2, 4.0)])
    for _ in range(2):  # a repeat counts what the batch did, too
        watch = Observation()
        assert tables.load(spark, path, load, ["ord"], KEYS, SCHEMA, batch=7, counters=watch) == "append"
        assert watch.get == {"inserted": 2, "updated": 0, "kept": 2}
        assert tables.read_table(spark, path, SCHEMA).count() == 4
    tables.load(spark, path, source(spark, [(1, "c", D2, 5.0)]), ["ord"], KEYS, SCHEMA, batch=8)
    assert tables.read_table(spark, path, SCHEMA).count() == 5
    watch = Observation()
    tables.load(spark, path, load.limit(0), ["ord"], KEYS, SCHEMA, batch=9, counters=watch)
    assert watch.get == {"inserted": 0, "updated": 0, "kept": 0}
    assert tables.read_table(spark, path, SCHEMA).count() == 5
