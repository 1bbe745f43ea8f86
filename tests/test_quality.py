from __future__ import annotations

import json
import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegate.operators import quality as q
from tidegate.operators.quantiles import group_quantiles
from tidegate.sources.tables import stored_report, write_report

SCHEMA = (
    "file_name string, row_id long, date string, cycle string, location string, capacity double, available double,"
    " flow long, note string"
)


def sample(seed, files=3, rows=120):
    dice = np.random.default_rng(seed)
    parts = []
    for f in range(files):
        n = 1 if f == 0 else rows
        parts.append(pd.DataFrame({
            "file_name": f"f{f}",
            "row_id": np.arange(n),
            "date": dice.choice(["d1", "d2", None], n),
            "cycle": dice.choice(["1", "2"], n),
            "location": dice.choice([None, *[f"l{i}" for i in range(30)]], n),
            "capacity": np.where(dice.random(n) < 0.1, np.nan, np.round(dice.lognormal(3, 1, n), 2)),
            "available": np.round(dice.normal(15, 9, n), 1),
            "flow": dice.integers(0, 9, n),
            "note": dice.choice(["x", None], n),
        }))
    return pd.concat(parts, ignore_index=True)


def frame(spark, pdf):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(pdf):
    """The expected report of one file, straight from the definitions."""
    body = pdf.drop(columns=["file_name", "row_id"])
    issues, hits = [], set()

    def add(severity, kind, column, mask):
        ids = pdf.row_id[mask]
        if len(ids):
            issues.append((severity, kind, column, len(ids)))
            hits.update((kind, column, int(i)) for i in ids)

    add("ERROR", "INCONSISTENT_DATA", None, body.capacity < body.available)
    add("WARNING", "DUPLICATE_RECORDS", None, body.duplicated(["date", "cycle", "location"], keep=False))
    for c in body.columns:
        add("ERROR" if c in ("date", "cycle", "location") else "WARNING", "MISSING_VALUES", c, body[c].isna())
    metrics = {}
    for c in ("capacity", "available", "flow"):
        low, high = body[c].quantile(0.25), body[c].quantile(0.75)
        reach = 1.5 * (high - low)
        add("INFO", "POTENTIAL_OUTLIERS", c, (body[c] < low - reach) | (body[c] > high + reach))
        metrics |= {f"{c}_min": body[c].min(), f"{c}_max": body[c].max(), f"{c}_mean": round(float(body[c].mean()), 2)}
    metrics["completeness"] = round(1 - body.isna().sum().sum() / body.size, 4)
    metrics["unique_locations"] = body.location.nunique()
    weight = sum({"ERROR": 1.0, "WARNING": 0.5, "INFO": 0.1}[s] for s, *_ in issues)
    score = round(max(0, 1 - weight / (len(body) * 2)), 2)
    status = "PASSED" if score >= 0.8 else "WARNING" if score >= 0.5 else "FAILED"
    return issues, hits, metrics, (len(body), 7, len(issues), score, status)


@pytest.mark.parametrize(
    "limits", [{}, {"broadcast_rows": 0, "hot_rows": 20}], ids=["broadcast", "sliced"]
)
def test_report_agrees_with_definitions(spark, limits):
    pdf = sample(11)
    df = frame(spark, pdf).cache()
    report = q.quality_report(df, q.Checks(limits=limits))
    issues, metrics = report.issues.collect(), report.metrics.collect()
    found_rows, summary = report.issue_rows.collect(), report.summary.collect()
    for name, part in pdf.groupby("file_name"):
        want_issues, want_rows, want_metrics, want_summary = brute(part)
        mine = sorted((r for r in issues if r["file_name"] == name), key=lambda r: r["issue_id"])
        assert [(r["severity"], r["type"], r["column"], r["affected_count"]) for r in mine] == want_issues
        assert [r["issue_id"] for r in mine] == list(range(len(mine)))
        assert {(r["type"], r["column"], r["row_id"]) for r in found_rows if r["file_name"] == name} == want_rows
        got = {r["name"]: r["value"] for r in metrics if r["file_name"] == name}
        assert got.keys() == want_metrics.keys()
        for key, value in want_metrics.items():
            assert got[key] is None if math.isnan(value) else got[key] == pytest.approx(value, abs=1e-9)
        line = next(r for r in summary if r["file_name"] == name)
        assert tuple(line)[1:6] == want_summary
        assert line["passed"] == (want_summary[-1] == "PASSED")


def test_missing_columns_and_no_numbers(spark):
    df = spark.createDataFrame([("f", 0, "1", "x"), ("f", 1, "1", None)], "file_name string, row_id long, cycle string, note string")
    report = q.quality_report(df)
    assert [(r["type"], r["column"]) for r in report.issues.orderBy("issue_id").collect()] == [
        ("MISSING_COLUMNS", None), ("MISSING_VALUES", "note"),
    ]
    assert "available, capacity, date, location" in report.issues.orderBy("issue_id").first()["description"]
    assert {r["name"] for r in report.metrics.collect()} == {"completeness"}
    assert report.issue_rows.count() == 1


def test_empty_and_all_null(spark):
    empty = q.quality_report(frame(spark, sample(1).head(0)))
    assert empty.summary.count() == empty.issues.count() == empty.issue_rows.count() == 0
    pdf = sample(2, 2).assign(capacity=np.nan)
    report = q.quality_report(frame(spark, pdf))
    line = {r["name"]: r["value"] for r in report.metrics.where("file_name = 'f1'").collect()}
    assert line["capacity_min"] is None and line["available_min"] is not None
    assert report.issues.where("column = 'capacity' and type = 'POTENTIAL_OUTLIERS'").count() == 0


def test_scores(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0, 1), (1, 1, 0, 20), (9, 0, 0, 1), (0, 0, 0, 0), (0, 0, 3, 1), (1, 1, 1, 2)], "e int, w int, i int, n int"
    )
    score = q.quality_score(F.col("e"), F.col("w"), F.col("i"), F.col("n"))
    found = [tuple(r) for r in rows.select(score, q.quality_status(score)).collect()]

    def expected(e, w, i, n):
        value = round(max(0, 1 - (e * 1.0 + w * 0.5 + i * 0.1) / (max(n, 1) * 2)), 2)
        return value, "PASSED" if value >= 0.8 else "WARNING" if value >= 0.5 else "FAILED"

    assert found == [expected(*r) for r in rows.collect()]
    assert found[0] == (0.5, "WARNING") and found[1] == (0.96, "PASSED")


@pytest.mark.parametrize("shape", ["continuous", "ties", "heavy tail", "tiny"])
def test_quantiles_agree_with_numpy(spark, shape):
    dice = np.random.default_rng(8)
    n = 3 if shape == "tiny" else 20_000
    values = {
        "continuous": dice.normal(0, 1e6, n),
        "ties": np.where(dice.random(n) < 0.4, 5.0, dice.integers(0, 40, n) / 4),
        "heavy tail": np.exp(dice.normal(0, 30, n)),
        "tiny": np.array([3.0, 1.0, 2.0]),
    }[shape]
    group = np.where(dice.random(n) < 0.9, "big", "small")
    pdf = pd.DataFrame({"row_id": np.arange(n), "g": group, "v": values})
    df = spark.createDataFrame(pdf).repartition(8)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for limits in ({}, {"broadcast_rows": 0, "hot_rows": 1000}):
        found = group_quantiles(df, ["g"], ["v"], probabilities, ["row_id"], accuracy=200, **limits)
        for row in found.collect():
            expected = np.quantile(pdf.v[pdf.g == row["g"]], probabilities)
            assert [row[f"v_q{i}"] for i in range(7)] == pytest.approx(expected, rel=1e-12)
    rough = group_quantiles(df, ["g"], ["v"], [0.5], ["row_id"], approximate=True)
    assert rough.count() == pdf.g.nunique()


def test_files_that_cannot_be_checked(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "file_name string")
    listing = spark.createDataFrame([("b", 10), ("c", 900)], "file_name string, file_size long")
    counts = spark.createDataFrame([("c", 5)], "file_name string, record_count long")
    issues = q.unreadable_files(expected, listing, counts)
    assert {(r["file_name"], r["type"], r["severity"]) for r in issues.collect()} == {
        ("a", "FILE_NOT_FOUND", "ERROR"), ("b", "EMPTY_FILE", "ERROR"),
    }
    lines = [tuple(r) for r in q.failed_summary(issues).orderBy("file_name").collect()]
    assert lines == [("a", 0, 0, 1, 0.0, "FAILED", False), ("b", 0, 0, 1, 0.0, "FAILED", False)]


def test_stored_report(spark, tmp_path):
    df = frame(spark, sample(4))
    out = str(tmp_path / "quality")
    for run in ("2025-06-08", "2025-06-09", "2025-06-09"):
        write_report(q.checker("anything")(df), out, run)
    again = spark.read.json(f"{out}/reports")
    assert again.count() == 6
    line = json.loads(again.where("file_name = 'f1'").toJSON().first())
    assert set(line) == {"file_name", "summary", "metrics", "issues", "issue_counts", "run_date"}
    assert line["summary"]["record_count"] == 120 and line["summary"]["issue_count"] == len(line["issues"])
    assert sum(line["issue_counts"].values()) == len(line["issues"])


def test_further_checks_count_like_built_in_ones(spark):
    def zero_flow(rows):
        return rows.where("flow = 0").groupBy("file_name").agg(F.count(F.lit(1)).alias("affected_count")).select(
            "file_name", F.lit("ERROR").alias("severity"), F.lit("NO_FLOW").alias("type"), F.lit("flow").alias("column"),
            F.lit("Flow stands still").alias("description"), "affected_count",
        )

    pdf = sample(6, 2)
    plain, more = (q.quality_report(frame(spark, pdf), q.Checks(extra=e)) for e in ((), (zero_flow,)))
    last = more.issues.where("file_name = 'f1'").orderBy(F.desc("issue_id")).first()
    assert (last["type"], last["affected_count"]) == ("NO_FLOW", int(((pdf.file_name == "f1") & (pdf.flow == 0)).sum()))
    scores = [r.summary.where("file_name = 'f1'").first() for r in (plain, more)]
    assert scores[1]["issue_count"] == scores[0]["issue_count"] + 1
    assert scores[1]["quality_score"] <= scores[0]["quality_score"]


def test_missing_columns_per_file(spark, tmp_path):
    """Two layouts read together: a file answers for its own columns only."""
    from tidegate.sources import feed as source

    (tmp_path / "a.csv").write_text("date,cycle,location,capacity,available\nd,c,L1,5,1\nd,c,L2,,2\n")
    (tmp_path / "b.csv").write_text("location,date,cycle,capacity\nL1,d,c,5\nL2,d,c,6\n")
    path = str(tmp_path)
    rows = source.read_layouts(spark, path, min_bytes=0, index="row_id").drop(source.SURPLUS)
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("capacity", "available")})
    checks = q.Checks(by="file_path", helpers=("file_name", "file_size", "file_modified", "block_start"))
    layouts = source.file_layouts(spark, path, min_bytes=0)
    for given, b_columns in ((layouts, 4), (layouts.where("file_path like '%a.csv'"), 5)):
        report = q.quality_report(rows, checks, given)
        issues = {(r["file_path"][-5:], r["type"], r["column"]) for r in report.issues.collect()}
        lacking = ("b.csv", "MISSING_COLUMNS", None) if b_columns == 4 else ("b.csv", "MISSING_VALUES", "available")
        assert issues == {("a.csv", "MISSING_VALUES", "capacity"), lacking}
        assert {r["file_path"][-5:]: r["column_count"] for r in report.summary.collect()} == {"a.csv": 5, "b.csv": b_columns}


def test_affected_rows_of_a_report_written_twice_are_computed_once(spark, tmp_path):
    rows = [("a", k, "2024-01-01", "x", None if k % 3 else "l", 5.0, 7.0) for k in range(9)]
    df = spark.createDataFrame(rows, "file_name string, row_id long, date string, cycle string, location string, capacity double, available double")
    found, read = q.quality_report(df), spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = replace(found, find_rows=lambda: found.issue_rows.mapInArrow(noted, found.issue_rows.schema))
    report = stored_report(counted, str(tmp_path / "rows"))
    for run in ("run-1", "run-2", "run-2"):
        write_report(report, str(tmp_path / "out"), run)
    again, want = spark.read.json(str(tmp_path / "out/issue_rows")), found.issue_rows.count()
    assert {r["run_date"]: r["count"] for r in again.groupBy("run_date").count().collect()} == {"run-1": want, "run-2": want}
    assert want > 0 and read.value == want
