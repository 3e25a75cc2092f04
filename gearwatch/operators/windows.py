"""Event-time window metrics: counts, per-category counts and maxima per tumbling window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from gearwatch.functions.eventtime import instant_of_utc, utc_of_instant

# Fixed values that must equal the reference: window, watermark, counted colours
# and the maxima it reports (input column -> output column).
WINDOW = "15 minutes"
WATERMARK = "48 hours"
COUNTED_COLORS: tuple[str, ...] = ("Black", "White", "Silver")
MAXIMA: tuple[tuple[str, str], ...] = (
    ("speed", "maximum_speed"),
    ("gear", "maximum_gear"),
    ("rpm", "maximum_rpm"),
)


def category_count_name(category: str) -> str:
    return f"num_of_{category.lower()}"


def window_metrics(
    df: DataFrame,
    time_col: str = "event_time_ts",
    *,
    window: str = WINDOW,
    watermark: str | None = None,
    category_col: str = "color_name",
    categories: Sequence[str] = COUNTED_COLORS,
    maxima: Sequence[tuple[str, str]] = MAXIMA,
) -> DataFrame:
    """Aggregate ``df`` by tumbling event-time window of length ``window``.

    Output: ``window_start, window_end`` (TIMESTAMP_NTZ, UTC wall clock),
    ``num_of_rows``, one ``num_of_<category>`` per category and the maxima.
    Windows are ``[start, end)``, aligned to the epoch; a row with a NULL time
    falls in no window.  With ``watermark`` the time column must be (or is cast
    to) TIMESTAMP and late rows are handled by the stream's output mode.  The
    aggregate is partial-then-final, so one hot window costs one row per task.
    """
    ttype = df.schema[time_col].dataType
    if not isinstance(ttype, (TimestampNTZType, TimestampType)):
        raise TypeError(f"{time_col} must be a timestamp, not {ttype.simpleString()}")
    if watermark is not None:
        # streaming watermarks need an instant (TIMESTAMP); NTZ is read as UTC
        if isinstance(ttype, TimestampNTZType):
            df = df.withColumn(time_col, instant_of_utc(F.col(time_col)))
        df = df.withWatermark(time_col, watermark)
    as_utc = (lambda c: c) if isinstance(df.schema[time_col].dataType, TimestampNTZType) \
        else utc_of_instant
    aggs = [F.count(F.lit(1)).alias("num_of_rows")]
    aggs += [
        F.sum(F.when(F.col(category_col) == F.lit(c), F.lit(1)).otherwise(F.lit(0)))
        .cast("bigint").alias(category_count_name(c))
        for c in categories
    ]
    aggs += [F.max(src).alias(out) for src, out in maxima]
    grouped = df.groupBy(F.window(F.col(time_col), window).alias("window")).agg(*aggs)
    return grouped.select(
        as_utc(F.col("window.start")).alias("window_start"),
        as_utc(F.col("window.end")).alias("window_end"),
        *[c for c in grouped.columns if c != "window"],
    )
