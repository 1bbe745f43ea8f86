from __future__ import annotations

import io

import pandas as pd
import pytest

from tidegate.schema import RAW_HEADER
from tidegate.sources import headers


@pytest.mark.parametrize(
    "line", ["Loc,Loc,DC", "a,,b,", "x,x,x.1,x", "Loc.1,Loc,Loc", '"q,1",b,b', "only"]
)
def test_names_are_made_distinct_as_pandas_does(line):
    expected = list(pd.read_csv(io.StringIO(line + "\n")).columns)
    assert headers.split_header(line) == expected


def test_clean_names():
    names = ["2nd Qty", "A b", "a_b", "Loc/QTI", "Größe", "a b", "", "x-y"]
    assert headers.clean_names(names) == ["col_2nd_qty", "a_b", "a_b_1", "loc_qti", "größe", "a_b_2", "", "x_y"]
    assert headers.clean_names(RAW_HEADER)[:6] == ["loc", "loc_zn", "loc_name", "loc_purp_desc", "loc_qti", "flow_ind"]
    assert headers.clean_names(["Loc", "Loc.1"]) == ["loc", "loc_1"]


def test_sanitise_header(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "3"])
    assert headers.sanitise_header(df).columns == ["a_b", "col_3"]


def test_file_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.CSV").write_text("c,d\n1,2\n3,4\n")
    (tmp_path / "three.txt").write_text("no\n")
    found = {r["file_path"].rsplit("/", 1)[1]: r["header"] for r in headers.file_headers(spark, str(tmp_path)).collect()}
    assert found == {"one.csv": "a,b", "two.CSV": "c,d"}
