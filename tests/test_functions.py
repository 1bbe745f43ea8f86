from __future__ import annotations

import datetime as dt
import itertools
import random
import struct
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tidegate.functions import cycles, dates, filenames, numbers, params, requests, text


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_cycle_names(spark):
    table = {
        "data_intraday1_20250101.csv": "Intraday 1",
        "data_intraday 2_20250101.csv": "Intraday 2",
        "data_intraday3_20250101.csv": "Intraday 3",
        "data_timely_20250101.csv": "Timely",
        "data_EVENING_20250101.csv": "Evening",
        "data_final_20250101.csv": "Final",
        "data_20250101.csv": None,
        "random_filename.csv": None,
        "evening/data.csv": None,
        "intraday 12.csv": "Intraday 1",
        "intraday 4 final.csv": "Final",
        "intra_timely.csv": "Timely",
        "intraday evening.csv": "Evening",
        "intraday 9.csv": None,
    }
    assert column(spark, table, cycles.cycle_of_filename) == list(table.values())


def test_lineage_label_keeps_all_digits(spark):
    names = ["x Intraday 12.csv", "intraday3", "intra 3", "evening"]
    assert column(spark, names, cycles.intraday_label) == ["Intraday 12", "Intraday 3", None, None]


def test_allowed_cycles(spark):
    names = ["Intraday 1", "Intraday 2", "Intraday 3", "Evening", "Timely", "Final", "Unknown", "", None, "evening"]
    assert column(spark, names, cycles.is_allowed_cycle) == [True] * 4 + [False] * 6
    assert column(spark, ["Timely", ""], lambda c: cycles.is_allowed_cycle(c, ["Timely", ""])) == [True, False]


def test_expected_cycles_by_hour(spark):
    rows = spark.range(24).select(
        "id", cycles.expected_cycles(F.timestamp_seconds(F.col("id") * 3600))
    ).orderBy("id").collect()
    sizes = [len(r[1]) for r in rows]
    assert sizes == [4] * 3 + [0] * 12 + [1] * 5 + [2] * 3 + [4]


def test_safe_filenames(spark):
    table = {
        "test_file.csv": "test_file.csv",
        "/path/to/file.csv": "file.csv",
        "C:\\path\\to\\file.csv": "file.csv",
        'file:with"invalid*chars?.csv': "file_with_invalid_chars_.csv",
        "": "unnamed_file.csv",
        "a b<c>.csv": "a b_c_.csv",
        ".hidden": "unnamed_7.csv",
        "x/..": "unnamed_7.csv",
        "folder/name/": "name",
        "back\\": "unnamed_7.csv",
        "mixed\\a/b": "a_b",
    }
    clean = column(spark, table, lambda c: filenames.safe_filename(c, F.lit(7.9)))
    assert clean == list(table.values())


def test_stems(spark):
    table = {"a.csv": "a", "a.b.csv": "a.b", ".hidden": ".hidden", "x/y.csv": "y", "plain": "plain", "dot.": "dot."}
    assert column(spark, table, filenames.stem) == list(table.values())
    assert column(spark, ["a.b.csv"], filenames.sidecar_name) == ["a.b.meta.json"]


def test_filename_of_response(spark):
    rows = spark.createDataFrame(
        [('attachment; filename="data_timely_20250608.csv"',), ("attachment; filename=plain.csv",), ("inline",), (None,)],
        "h string",
    )
    name = filenames.filename_of_response(F.col("h"), F.lit("a/b"), F.lit(dt.date(2025, 6, 8)))
    assert [r[0] for r in rows.select(name).collect()] == [
        "data_timely_20250608.csv", "plain.csv", "a_b_20250608.csv", "a_b_20250608.csv",
    ]


def test_date_in_filename(spark):
    names = ["x_06-08-2025.csv", "x_6-8-2025.csv", "99-99-2025", "a 01-02-2024 03-04-2025"]
    assert column(spark, names, filenames.date_text_of_filename) == [
        "2025-06-08", None, "2025-99-99", "2024-01-02",
    ]


def test_parse_dates(spark):
    texts = ["2025-06-08", "2025-6-8", "06/08/2025", "8-6-2025", "20250608", "8.6.2025", "2025-13-01", "31/12/2025", "", None]
    day = dt.date(2025, 6, 8)
    assert column(spark, texts, dates.parse_date) == [day] * 5 + [None] * 5
    assert column(spark, texts, lambda c: dates.parse_date(c, compact=False)) == [day] * 4 + [None] * 6


def test_gas_day_and_ranges(spark):
    day = F.lit(dt.date(2025, 6, 8))
    row = spark.range(1).select(
        dates.gas_day(day), dates.recent_days(day, 3), dates.backfill_days(day, 2), dates.recent_days(day, 0)
    ).first()
    assert row[0] == "06%2F08%2F2025"
    assert row[1] == [dt.date(2025, 6, d) for d in (8, 7, 6)]
    assert row[2] == [dt.date(2025, 6, d) for d in (7, 6)]
    assert row[3] == []


def test_quote_like_form_encoding(spark):
    values = ["a b", "50%", "~x*y", "é&=/", "%7E literal", "%2A", "a+b", "'quoted' (x)!", "", "日本", "_.-"]
    assert column(spark, values, requests.quote_value) == [urllib.parse.quote_plus(v, safe="%") for v in values]


def test_request_url(spark):
    def url(cycle, given):
        known = F.lit(None).cast("map<string,string>") if given is None else F.create_map(
            *[F.lit(x) for pair in given.items() for x in pair]
        )
        return spark.range(1).select(
            requests.request_url(
                F.lit("endpoint"), F.lit(dt.date(2025, 6, 8)), F.lit(cycle).cast("int"),
                None if given is None else known,
                base_url="https://api.example.com", routing_path="/api/v1/", asset_id="TEST",
            )
        ).first()[0]

    plain = url(1, None)
    assert plain.startswith("https://api.example.com/api/v1/TESTendpoint?f=csv&extension=csv&asset=TEST&")
    assert plain.endswith("gasDay=06%2F08%2F2025&searchType=ALL&searchString=&locType=ALL&locZone=ALL&cycle=1")
    chosen = url(None, {"searchType": "NOM", "extra": "a b", "locZone": "N"})
    assert chosen.endswith("searchType=NOM&searchString=&locType=ALL&locZone=N&extra=a+b")
    assert "cycle" not in chosen


@pytest.mark.parametrize(
    ("cycle", "name", "given", "key"),
    [
        (1, None, {}, "endpoint_20250608_cycle1_"),
        (1, "Intraday 1", {}, "endpoint_20250608_intraday_1_"),
        (1, None, {"param2": "value2", "param1": "value1"}, "endpoint_20250608_cycle1_param1=value1_param2=value2"),
        (None, "Evening Cycle", {}, "endpoint_20250608_evening_cycle_"),
        (None, "", {"x": ""}, "endpoint_20250608_"),
    ],
)
def test_cache_keys(spark, cycle, name, given, key):
    pairs = [F.lit(x) for pair in given.items() for x in pair]
    known = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    made = requests.cache_key(
        F.lit("endpoint"), F.lit(dt.date(2025, 6, 8)), F.lit(cycle).cast("int"), F.lit(name).cast("string"), known
    )
    assert spark.range(1).select(made).first()[0] == key


def test_cache_key_parts(spark):
    parts = column(spark, ["a/b_20250608_cycle1_", "a_b_20250608_cycle1_", "a_b"], requests.cache_key_parts)
    assert [p and tuple(p) for p in parts] == [("a_b", "20250608", "cycle1"), ("a", "b", "20250608"), None]


def test_table_of_endpoint(spark):
    mapping = {"test/endpoint": "test_table", "a_b": "under", "c-d": "hyphen"}
    names = ["test/endpoint", "unmapped/endpoint", "a/b", "c_d", "x-y/z"]
    assert column(spark, names, lambda c: requests.table_of_endpoint(c, mapping)) == [
        "test_table", "unmapped_endpoint", "under", "hyphen", "x_y_z",
    ]
    assert column(spark, ["x-y"], lambda c: requests.table_of_endpoint(c, {})) == ["x_y"]


def test_parse_pairs(spark):
    given = [["a=1", "b", "c=x=y", "a=2", "=z"], [], None]
    assert column(spark, given, params.parse_pairs, "array<string>") == [{"a": "2", "c": "x=y", "": "z"}, {}, None]


def test_parse_lists(spark):
    given = ["[a, 1]", "[]", "[ 007 ,x ]", "plain", "[open", "]", "[", "[0]"]
    assert column(spark, given, params.parse_list) == [
        ["a", "1"], [""], ["7", "x"], ["plain"], ["[open"], ["]"], ["["], ["0"],
    ]


def test_combinations_are_the_product(spark):
    cases = [
        {"a": ["1", "2"], "b": ["x"], "c": ["p", "q", "r"]},
        {"a": ["1"]},
        {"a": ["1"], "b": []},
        {},
    ]
    found = column(spark, cases, params.combinations, "map<string,array<string>>")
    for case, combos in zip(cases, found):
        expected = [dict(zip(case, chosen)) for chosen in itertools.product(*case.values())]
        assert sorted(map(str, combos)) == sorted(map(str, expected))


def test_sorted_text_and_first_values(spark):
    given = [{"b": ["2", "9"], "a": ["1"], "e": [""], "n": []}]
    assert column(
        spark, given, lambda c: params.sorted_text(params.first_values(c)), "map<string,array<string>>"
    ) == ["a=1_b=2"]


def test_round_exact_agrees_with_correct_rounding(spark):
    dice = random.Random(5)
    values = [0.125, 0.375, 0.975, 2.675, 1.005, -0.125, -2.675, 0.5, 1.5, 2.5, 1e15 + 0.3, 1e300, 0.0, -0.0049, 0.615]
    values += [k / 1000 for k in range(-2000, 2000, 5)] + [k / 8 for k in range(-80, 80)]
    values += [dice.uniform(-1000, 1000) for _ in range(2000)]
    values += [struct.unpack("d", struct.pack("q", dice.getrandbits(62)))[0] for _ in range(200)]
    values = [v for v in values if abs(v) < 1e290] + [None]
    for digits in (0, 2, 4):
        found = column(spark, values, lambda c: numbers.round_exact(c, digits), "double")
        assert found == [None if v is None else round(v, digits) for v in values]


def test_reason_and_missing_texts(spark):
    reasons = ["Currently UNAVAILABLE", "unavailable", "Available", "", None]
    assert column(spark, reasons, text.normalise_reason) == ["Unavailable", "Unavailable", "Available", "", None]
    assert column(spark, ["NA", "n/a", "", "na", "0", " NA", None], text.null_if_na) == [
        None, None, None, "na", "0", " NA", None,
    ]
