"""Declared schemas of the telemetry records and dimensions."""

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values that must equal the reference: names, types and order of the two wire records.

# Raw sensor event as it travels as JSON on the input topic.
RAW_EVENT = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_time", StringType(), True),
        StructField("car_id", IntegerType(), True),
        StructField("speed", DoubleType(), True),
        StructField("rpm", IntegerType(), True),
        StructField("gear", IntegerType(), True),
    ]
)

# Enriched event; the alert record has the same shape.  Field order is the wire order.
ENRICHED_EVENT = StructType(
    [
        StructField("event_id", StringType(), True),
        StructField("event_time", StringType(), True),
        StructField("car_id", IntegerType(), True),
        StructField("driver_id", IntegerType(), True),
        StructField("brand_name", StringType(), True),
        StructField("model_name", StringType(), True),
        StructField("color_name", StringType(), True),
        StructField("speed", DoubleType(), True),
        StructField("rpm", IntegerType(), True),
        StructField("gear", IntegerType(), True),
        StructField("expected_gear", IntegerType(), True),
    ]
)
ALERT_EVENT = ENRICHED_EVENT

CARS = StructType(
    [
        StructField("car_id", LongType(), True),
        StructField("driver_id", LongType(), True),
        StructField("model_id", LongType(), True),
        StructField("color_id", LongType(), True),
    ]
)
CAR_MODELS = StructType(
    [
        StructField("model_id", LongType(), True),
        StructField("car_brand", StringType(), True),
        StructField("car_model", StringType(), True),
    ]
)
CAR_COLORS = StructType(
    [
        StructField("color_id", LongType(), True),
        StructField("color_name", StringType(), True),
    ]
)

# A file-backed topic stores what a Kafka record carries that the jobs use.
TOPIC_RECORD = StructType(
    [
        StructField("key", BinaryType(), True),
        StructField("value", BinaryType(), True),
        StructField("timestamp", TimestampType(), True),
    ]
)
