"""Telemetry view of the given tables (``events`` and ``customer``).

events -> sensor events:  event_id = text of event_id, car_id = user_id,
speed = value, rpm = 500 + 65 * props.k, gear = 1 + event_id mod 6,
event_time = ISO text of ts.
customer -> cars: one car per customer (for the joins, every fifth key's car has no id
yet, so left-join misses exist at every scale); driver, model and colour ids
are derived from the customer columns.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.eventtime import format_event_time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# The canonical flat form {"k": <JSON integer>}: JSON whitespace only, no leading zeros
# (possessive quantifiers: no backtracking).
_FLAT_K = r'^\{[ \t\n\r]*+"k"[ \t\n\r]*+:[ \t\n\r]*+(-?+(?:0|[1-9][0-9]*+))[ \t\n\r]*+\}$'


def props_k(props: Column) -> Column:
    """``props.k`` as INT, exactly as ``from_json(props, "k INT").k``.

    The props text is parsed for every event, so this is the hottest expression
    of the view.  Texts in the canonical flat form take a regular expression
    (about twice as cheap as a JSON parse); every other text - and a flat one
    whose integer does not fit INT - is parsed as JSON.  For the flat form
    both give the same value, so the result is exactly the JSON parse.
    """
    fast = F.regexp_extract(props, _FLAT_K, 1).try_cast("int")  # "" (no match) -> NULL
    return F.coalesce(fast, F.from_json(props, "k INT").getField("k"))


def sensor_columns(events: DataFrame, with_time_text: bool = True) -> DataFrame:
    """Map ``events`` rows to sensor-event columns (narrow projection, keeps ``ts``)."""
    k = props_k(F.col("props"))
    cols = [
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts"),
        F.col("user_id").try_cast("int").alias("car_id"),
        F.col("value").alias("speed"),
        (F.lit(500) + F.lit(65) * k.cast("bigint")).try_cast("int").alias("rpm"),
        (F.lit(1) + F.pmod(F.col("event_id"), F.lit(6))).cast("int").alias("gear"),
    ]
    if with_time_text:
        cols.insert(2, format_event_time(F.col("ts")).alias("event_time"))
    return events.select(*cols)


def telemetry_events(spark: SparkSession, sf_dir: str, with_time_text: bool = True) -> DataFrame:
    """Sensor events over the whole ``events`` table."""
    return sensor_columns(read_table(spark, sf_dir, "events"), with_time_text)


def cars_from_customers(customer: DataFrame, unregistered: bool = False) -> DataFrame:
    """One car per customer.  With ``unregistered``, every fifth key's car has no id yet
    (NULL), so that left joins miss it; the row stays."""
    key = F.col("c_custkey")
    car_id = F.when(F.pmod(key, F.lit(5)) != 4, key) if unregistered else key
    return customer.select(
        car_id.alias("car_id"),
        (F.lit(100000000) + key).alias("driver_id"),
        (F.pmod(F.col("c_nationkey"), F.lit(7)) + 1).cast("bigint").alias("model_id"),
        (F.pmod(key, F.lit(7)) + 1).cast("bigint").alias("color_id"),
    )


def telemetry_cars(spark: SparkSession, sf_dir: str, unregistered: bool = True) -> DataFrame:
    """The cars dimension derived from the whole ``customer`` table."""
    return cars_from_customers(read_table(spark, sf_dir, "customer"), unregistered)
