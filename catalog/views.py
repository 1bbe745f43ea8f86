"""The given tables seen as feeds, once for Spark and once as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a quality feed: file = event type, one reading per user and day.

    Some cells are missing: the location of user 0, readings below 1, and
    availabilities of 95 and more.
    """
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("file_name"),
        F.to_date("ts").alias("date"),
        F.col("event_type").alias("cycle"),
        F.when(F.col("user_id") > 0, F.col("user_id").cast("string")).alias("location"),
        F.when(F.col("value") >= 1, F.col("value")).alias("capacity"),
        F.when(k < 95, k).alias("available"),
        F.when(k >= 10, F.col("props")).alias("note"),
    )


FEED_SQL = """
feed as (
  select event_id as row_id, event_type as file_name, cast(ts as date) as date, event_type as cycle,
    case when user_id > 0 then cast(user_id as varchar) end as location,
    case when value >= 1 then value end as capacity,
    case when k < 95 then k end as available,
    case when k >= 10 then props end as note
  from (select *, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as double) as k from events)
)
"""

# Cycle texts of the request and file-name views, by order status.
_CYCLE_TEXT = {"O": "OAC_Intraday ", "F": "oac_EVENING_", "P": "oac timely "}


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed file names: folder, cycle text, number, day."""
    orders = table(spark, sf_dir, "orders")
    text = F.lit(None)
    for status, words in _CYCLE_TEXT.items():
        text = F.when(F.col("o_orderstatus") == status, words).otherwise(text)
    return orders.withColumn(
        "name",
        F.concat(
            F.lit("/landing/"), "o_orderpriority", F.lit("/"), text, F.col("o_custkey").cast("string"), F.lit("_"),
            F.date_format("o_orderdate", "MM-dd-yyyy"), F.lit(".csv"),
        ),
    )


NAMES_SQL = """
names as (
  select *, concat('/landing/', o_orderpriority, '/',
    case o_orderstatus when 'O' then 'OAC_Intraday ' when 'F' then 'oac_EVENING_' when 'P' then 'oac timely ' end,
    cast(o_custkey as varchar), '_', strftime(o_orderdate, '%m-%d-%Y'), '.csv') as name
  from orders
)
"""


def with_sql(*parts: str) -> str:
    return "with " + ",".join(p.strip() for p in parts) + "\n"
