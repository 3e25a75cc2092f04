"""Synthetic sensor events, generated on the executors.

The original generator collects the fleet to the driver and draws events in a
Python loop.  Here every event is a row of an id source (``spark.range`` or a
table), its car is picked by joining a hashed index to the numbered fleet, and
the readings are hash-derived columns, so generation scales with the cluster
and a recomputed task yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gearwatch.functions.eventtime import format_event_time, utc_now
from gearwatch.functions.hashing import hash31, uniform_hundredths, uniform_index, uniform_int

# Fixed values that must equal the reference: reading ranges of a generated event.
SPEED_RANGE = (0, 180)
RPM_RANGE = (500, 7000)
GEAR_RANGE = (1, 6)

# Fixed values that must equal the reference: one event every half second.
PACE_SECONDS = 0.5

MAX_FLEET = 100_000  # a test fleet: numbered in one task and broadcast

# Salts of the independent draws per event.
_SALT_CAR, _SALT_SPEED, _SALT_RPM, _SALT_GEAR, _SALT_ID = 11, 12, 13, 14, 15

# Fixed values of the single injected alert (manual test message).
INJECTED_ALERT = {
    "event_id": "6f1c2a9e-0b7d-4c3e-9a51-2d8e7f4b1c60",
    "car_id": 5417867,
    "driver_id": 702937568,
    "brand_name": "Kia",
    "model_name": "Rio",
    "color_name": "Blue",
    "speed": 150.5,
    "rpm": 3200,
    "gear": 4,
    "expected_gear": 6,
}


def uuid_text(id_col: str) -> F.Column:
    """A UUID-shaped id that is unique per BIGINT id below 2^48 and repeatable."""
    x = F.col(id_col)

    def hx(c, width):
        return F.lpad(F.lower(F.hex(c)), width, "0")

    return F.concat_ws(
        "-",
        hx(hash31(x, _SALT_ID), 8),
        hx(F.pmod(hash31(x, _SALT_ID + 1), F.lit(65536)), 4),
        F.concat(F.lit("4"), hx(F.pmod(hash31(x, _SALT_ID + 2), F.lit(4096)), 3)),
        F.concat(F.lit("8"), hx(F.pmod(hash31(x, _SALT_ID + 3), F.lit(4096)), 3)),
        hx(x, 12),
    )


def synth_events(
    ids: DataFrame,
    cars: DataFrame,
    id_col: str = "id",
    time_col: str | None = None,
    pace_seconds: float = PACE_SECONDS,
) -> DataFrame:
    """One sensor event per row of ``ids``: a uniformly picked car plus random readings.

    ``time_col`` (a UTC TIMESTAMP_NTZ of the id source) gives the event time.
    Without it, event ``id`` is stamped ``now + id * pace_seconds``: the
    timeline of a producer that sends one event per pace, computed at once.
    Output: ``event_id, event_time, car_id, speed, rpm, gear`` (raw-event types).
    """
    keys = ["car_id", "driver_id", "model_id", "color_id"]
    n_cars = cars.limit(MAX_FLEET + 1).count()
    if not 0 < n_cars <= MAX_FLEET:
        raise ValueError(f"the generator draws from a fleet of 1 to {MAX_FLEET} cars")
    numbered = cars.select(*keys, (F.row_number().over(Window.orderBy(*keys)) - 1).alias("row_idx"))
    fleet = F.broadcast(numbered.select("row_idx", F.col("car_id").alias("__car")))
    x = F.col(id_col)
    if time_col:
        ts = F.col(time_col)
    else:
        offset = (x * F.lit(pace_seconds)).cast("decimal(18,6)")
        ts = utc_now() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset)
    picked = ids.select(
        F.col(id_col),
        uuid_text(id_col).alias("event_id"),
        format_event_time(ts).alias("event_time"),
        uniform_index(x, F.lit(n_cars), _SALT_CAR).alias("row_idx"),
        uniform_hundredths(x, *SPEED_RANGE, salt=_SALT_SPEED).alias("speed"),
        uniform_int(x, *RPM_RANGE, salt=_SALT_RPM).cast("int").alias("rpm"),
        uniform_int(x, *GEAR_RANGE, salt=_SALT_GEAR).cast("int").alias("gear"),
    )
    return picked.join(fleet, "row_idx").select(
        "event_id", "event_time", F.col("__car").try_cast("int").alias("car_id"),
        "speed", "rpm", "gear",
    )


def injected_alert(spark: SparkSession, event_time: str | None = None, **overrides) -> DataFrame:
    """One fixed alert record (ENRICHED_EVENT columns) for a manual end-to-end check."""
    from gearwatch.schemas import ALERT_EVENT

    row = {**INJECTED_ALERT, **overrides}
    row.setdefault("event_time", None)
    if event_time is not None:
        row["event_time"] = event_time
    from gearwatch.sources.dims import literal_table

    df = literal_table(spark, [tuple(row.get(f.name) for f in ALERT_EVENT.fields)], ALERT_EVENT)
    if row["event_time"] is None:
        df = df.withColumn("event_time", format_event_time(utc_now()))
    return df
