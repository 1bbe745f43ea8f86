from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidegate.operators import duplicates as dup
from tidegate.operators.skew import join_groups, sliced_join
from tidegate.session import materialise

SCHEMA = "row_id int, date string, cycle string, location string, capacity double, available double, note string"
KEYS = ["date", "cycle", "location"]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


BASE = [("a", "1", "x", 1.0, None, None), ("a", "1", "x", 3.0, 2.0, "n"), ("b", "1", "y", 5.0, 5.0, "m")]
LOOSE = (None, "1", "x", 9.0, 9.0, "z")


def collapsed(spark, rows, **options):
    out = dup.collapse_duplicates(frame(spark, rows), ["row_id"], **options)
    assert out.columns == [*KEYS, "capacity", "available", "row_id", "note"]
    return sorted(out.drop("row_id").collect(), key=str)


def test_collapse(spark):
    assert [tuple(r) for r in collapsed(spark, BASE)] == [
        ("a", "1", "x", 3.0, 2.0, "n"), ("b", "1", "y", 5.0, 5.0, "m"),
    ]


def test_null_keys_go_only_where_duplicates_exist(spark):
    assert len(collapsed(spark, [*BASE, LOOSE])) == 2
    assert len(collapsed(spark, [BASE[0], BASE[2], LOOSE])) == 3
    # Two rows with the same null key are duplicates themselves.
    assert len(collapsed(spark, [BASE[0], BASE[2], LOOSE, LOOSE])) == 2
    assert len(collapsed(spark, [BASE[0], LOOSE], drop_null_keys=True)) == 1
    assert len(collapsed(spark, [*BASE, LOOSE, LOOSE], drop_null_keys=False)) == 4


def test_collapse_without_key_columns_or_rows(spark):
    plain = frame(spark, BASE).drop(*KEYS)
    assert dup.collapse_duplicates(plain, ["row_id"]) is plain
    assert frame(spark, []).transform(lambda d: dup.collapse_duplicates(d, ["row_id"])).count() == 0
    only_keys = frame(spark, BASE).select(*KEYS)
    assert dup.collapse_duplicates(only_keys, KEYS).count() == 2


values = st.sampled_from([None, 1.0, 2.0, 3.0])
rows = st.lists(
    st.tuples(*[st.sampled_from([None, "a", "b"])] * 3, values, values, st.sampled_from([None, "n", "m"])), max_size=12
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_collapse_agrees_with_pandas(spark, rows):
    pdf = pd.DataFrame(rows, columns=[*KEYS, "capacity", "available", "note"])
    if len(pdf) and pdf.duplicated(KEYS).any():
        rules = {"capacity": "max", "available": "max", "note": "first"}
        pdf = pdf.groupby(KEYS, as_index=False).agg(rules)
    expected = sorted((tuple(None if pd.isna(v) else v for v in r) for r in pdf.to_numpy(dtype=object)), key=str)
    found = dup.collapse_duplicates(frame(spark, rows), ["row_id"]).drop("row_id")
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    flagged = dup.flag_duplicates(frame(spark, rows), KEYS).where("is_duplicate").count()
    fresh = pd.DataFrame(rows, columns=[*KEYS, "capacity", "available", "note"])
    assert flagged == int(fresh.duplicated(KEYS, keep=False).sum())


def test_counts_and_groups(spark):
    df = frame(spark, [*BASE, LOOSE, LOOSE])
    assert tuple(dup.key_counts(df, KEYS).first()) == (5, 3, 2)
    assert dup.duplicate_groups(df, KEYS).count() == 2
    assert tuple(dup.key_counts(frame(spark, []), KEYS).first()) == (0, 0, 0)


def test_last_and_first_writer(spark):
    df = frame(spark, [*BASE, LOOSE])
    assert {r["row_id"] for r in dup.last_per_key(df, KEYS, ["row_id"]).collect()} == {1, 2, 3}
    assert {r["row_id"] for r in dup.first_per_key(df, KEYS, ["row_id"]).collect()} == {0, 2, 3}
    plan = dup.last_per_key(df, KEYS, ["row_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_unique_key(spark):
    df = frame(spark, BASE)
    ok, groups = dup.validate_unique_key(df, KEYS)
    assert not ok and groups.count() == 1
    assert dup.validate_unique_key(df, ["row_id"])[0]
    assert dup.validate_unique_key(df, ["row_id", ""])[0]
    assert dup.validate_unique_key(df, []) == (False, None)
    assert dup.validate_unique_key(df, ["nowhere"]) == (False, None)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds over a third of the rows, among them exact copies."""
    dice = np.random.default_rng(3)
    keys = np.where(dice.random(6000) < 0.4, 0, dice.integers(1, 400, 6000))
    pdf = pd.DataFrame({"row_id": np.arange(6000), "k": [None if k == 7 else f"k{k}" for k in keys], "v": 1.0})
    return pdf, spark.createDataFrame(pdf, "row_id long, k string, v double").cache()


def test_sliced_join_of_a_hot_key(spark, skewed):
    pdf, df = skewed
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    expected = {(r, None if pd.isna(k) else k): n for r, k, n in zip(
        pdf.row_id, pdf.k, pdf.groupby("k", dropna=False).v.transform("size"))}
    joined = sliced_join(df, sizes, ["k"], "n", ["row_id"], hot_rows=50)
    assert {(r["row_id"], r["k"]): r["n"] for r in joined.collect()} == expected
    for broadcast_rows in (0, 10_000):
        both = join_groups(df, materialise(sizes), ["k"], "n", ["row_id"], broadcast_rows=broadcast_rows, hot_rows=50)
        assert both.count() == 6000 and both.columns == ["row_id", "k", "v", "n"]
    few = sizes.where("k = 'k0' or k is null")
    assert sliced_join(df, few, ["k"], "n", ["row_id"], "left_anti", 50).count() == int(
        ((pdf.k != "k0") & pdf.k.notna()).sum()
    )


def test_hot_key_is_spread_over_tasks(spark, skewed):
    pdf, df = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = sliced_join(df, sizes, ["k"], "n", ["row_id"], hot_rows=50)
        parts = joined.where("k = 'k0'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) == 8
        assert max(r["count"] for r in parts) < 0.3 * int((pdf.k == "k0").sum())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_flags_do_not_depend_on_slicing(spark, skewed):
    pdf, df = skewed
    expected = set(pdf.row_id[pdf.duplicated("k", keep=False)])
    for hot_rows in (1, 50, 10**6):
        flagged = dup.flag_duplicates(df, ["k"], hot_rows=hot_rows)
        assert flagged.count() == 6000
        assert {r[0] for r in flagged.where("is_duplicate").select("row_id").collect()} == expected


def test_more_hot_groups_than_are_broadcast(spark, skewed, monkeypatch):
    from tidegate.operators import skew

    _, df = skewed
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    want = sorted(map(str, sliced_join(df, sizes, ["k"], "n", ["row_id"], hot_rows=50).collect()))
    monkeypatch.setattr(skew, "HOT_GROUPS", 0)
    assert sorted(map(str, sliced_join(df, sizes, ["k"], "n", ["row_id"], hot_rows=50).collect())) == want
