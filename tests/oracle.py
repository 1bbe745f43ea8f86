"""Compare registered queries with their SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (list, dict)):
        return repr(value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_columns, got_rows = df.columns, [tuple(r) for r in df.collect()]
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    rows = found.fetchall()
    if sorted(columns) != sorted(got_columns):
        return f"columns {sorted(got_columns)} != {sorted(columns)}"
    got, want = rows_of(got_columns, got_rows), rows_of(columns, rows)
    if got == want:
        kinds = {c: t for c, t in zip(columns, [str(d[1]) for d in found.description])}
        del kinds
        return None
    extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"{len(got_rows)} rows, expected {len(rows)}\n  only here: {extra}\n  only there: {lacking}"


def main() -> int:
    import __spark_entry__ as entry
    from tidegate.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = compare(df, con, sql) if sql else f"no SQL, {df.count()} rows"
            rows = df.count() if not problem else "-"
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", "-"
        bad += bool(problem) and not problem.startswith("no SQL")
        print(f"{'ok ' if not problem else '-- '} {name:28s} {time.time() - started:6.2f}s rows={rows} {problem or ''}", flush=True)
    print("failures:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
