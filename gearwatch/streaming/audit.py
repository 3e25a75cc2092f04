"""What a window stream holds in its checkpoint, read with Spark's state-store reader.

The stream need not run: the reader takes the state of the last committed micro-batch, as a distributed scan.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.eventtime import utc_of_instant
from gearwatch.session import children, read_text


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that was committed; -1: none."""
    return max((int(n) for n in children(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()), default=-1)


def watermark_ms(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> int:
    """The watermark (milliseconds since the epoch) that a micro-batch, by default the last committed one, worked with."""
    batch_id = last_batch(spark, checkpoint) if batch_id is None else batch_id
    if batch_id < 0:
        return 0
    header = read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}").split("\n")[1]
    return json.loads(header)["batchWatermarkMs"]


def held_windows(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """The windows in the state of a window stream: ``window_start, window_end`` (UTC wall clock), ``behind`` (whether the
    window ended at or before the watermark: it should be gone)."""
    if last_batch(spark, checkpoint) < 0:
        return spark.createDataFrame([], "window_start timestamp_ntz, window_end timestamp_ntz, behind boolean")
    state = spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
    window = f"key.`{state.schema['key'].dataType.fields[0].name}`"
    mark = F.timestamp_millis(F.lit(watermark_ms(spark, checkpoint)))
    return state.select(utc_of_instant(F.col(f"{window}.start")).alias("window_start"),
                        utc_of_instant(F.col(f"{window}.end")).alias("window_end"),
                        (F.col(f"{window}.end") <= mark).alias("behind"))


def state_summary(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """One row: the last batch, its watermark, how many windows are held, and how many of them lie behind it."""
    held = held_windows(spark, checkpoint, operator_id)
    return held.agg(
        F.lit(last_batch(spark, checkpoint)).cast("bigint").alias("batch_id"),
        utc_of_instant(F.timestamp_millis(F.lit(watermark_ms(spark, checkpoint)))).alias("watermark"),
        F.count(F.lit(1)).alias("n_held"), F.count_if("behind").alias("n_behind"),
        F.min("window_start").alias("oldest"), F.max("window_end").alias("newest"))
