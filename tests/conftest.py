from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidegate.session import build_session

    session = build_session(
        "tests", "local[8]", **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def one(spark, column, **values):
    """Value of an expression over one row of literals."""
    from pyspark.sql import functions as F

    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(0).alias("none")])
    return row.select(column).first()[0]
