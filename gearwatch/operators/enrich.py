"""Enrichment: sensor events LEFT JOIN the car snowflake (cars -> models, colors)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.functions.bands import GEAR_BOUNDS, classify_bands
from gearwatch.operators.joins import HOT_SHARE, SALT_BUCKETS, broadcast_if_small, left_join_checked, with_every_salt
from gearwatch.schemas import ENRICHED_EVENT
from gearwatch.sources.dims import with_model_names

# Lookups up to this size only name a car's model and colour: a car's profile stays about its size.
LOOKUP_MAX_BYTES = 64 << 10
PROFILE_COLUMNS = ("driver_id", "brand_name", "model_name", "color_name")


def lookup(events: DataFrame, dim: DataFrame, key: str, **join_opts) -> DataFrame:
    """``events LEFT JOIN dim USING (key)``, strategy by checked size (``left_join_checked``).

    The key keeps the events' type (an INT key meets a BIGINT dimension key by
    an implicit cast).  Unknown and NULL keys keep their event with NULL
    attributes; a key listed twice in ``dim`` doubles its events.
    """
    return left_join_checked(events, dim, key, **join_opts)


def car_profiles(cars: DataFrame, models: DataFrame, colors: DataFrame) -> DataFrame:
    """Flatten the dimension snowflake to one row per car row (dimension-sized work).

    ``cars LEFT JOIN models USING (model_id) LEFT JOIN colors USING (color_id)``.
    Joining the events once to this equals joining them to the three tables in
    turn: the later joins only read car columns and equality rejects NULLs.
    The lookups are broadcast when the planner sizes them small (no job).
    """
    models, _ = broadcast_if_small(
        with_model_names(models).select("model_id", "brand_name", "model_name"))
    colors, _ = broadcast_if_small(colors.select("color_id", "color_name"))
    return (cars.join(models, "model_id", "left")
            .join(colors, "color_id", "left")
            .select("car_id", *PROFILE_COLUMNS))


def save_profiles(cars: DataFrame, models: DataFrame, colors: DataFrame, *, table: str, path: str,
                  buckets: int, salts: int = 8) -> DataFrame:
    """Write the flattened car profile as a table bucketed and sorted by ``car_id`` and a salt.

    For a fleet too large to broadcast: a join against the returned table
    shuffles only the events (into ``buckets`` partitions) and reads the
    profile bucket by bucket, with no exchange on its side - which matters
    for a stream, whose static side would otherwise be re-shuffled every
    micro-batch.  AQE cannot split such a join, so every profile is stored once
    per salt (``salts`` copies) and ``enrich`` salts the events: a hot car, or
    events without one, are spread over ``salts`` buckets.  One file per bucket
    (the rows are hash-partitioned the same way first).  Write a new ``path``
    per version and restart streams on it.
    """
    profiles = with_every_salt(car_profiles(cars, models, colors), salts)
    keys = ["car_id", profiles.columns[-1]]
    (profiles.repartition(buckets, *keys).write.mode("overwrite")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))
    return profiles.sparkSession.table(table)


def enrich(
    events: DataFrame,
    cars: DataFrame | None = None,
    models: DataFrame | None = None,
    colors: DataFrame | None = None,
    *,
    profiles: DataFrame | None = None,
    bounds: Sequence[float] = GEAR_BOUNDS,
    broadcast_max_bytes: int | None = None,
    skew: str = "auto",
    salt_buckets: int = SALT_BUCKETS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add ``driver_id, brand_name, model_name, color_name, expected_gear`` to events.

    Left outer: an event with an unknown or NULL ``car_id`` is kept with NULL
    attributes; a car listed twice doubles its events.  Event columns keep
    their order and type (``car_id`` stays the event's INT).

    ``profiles`` (e.g. from ``save_profiles``) replaces the three dimensions
    with an already flattened profile.

    Join strategy (``left_join_checked``): the car profile is broadcast when the
    planner sizes it within ``broadcast_max_bytes``; otherwise a shuffle join
    that spreads hot and missing car ids over ``salt_buckets`` tasks, for batch
    inputs, streams and bucketed profiles alike.
    """
    small = False
    if profiles is None:
        profiles = car_profiles(cars, models, colors)
        # the planner sizes a join by the product of its sides; a profile is a car with three names
        small = all(broadcast_if_small(dim, bound)[1] for dim, bound in (
            (cars, broadcast_max_bytes), (models, LOOKUP_MAX_BYTES), (colors, LOOKUP_MAX_BYTES)))
    joined = lookup(events, profiles, "car_id", broadcast_max_bytes=broadcast_max_bytes, right_is_small=small, skew=skew,
                    salt_buckets=salt_buckets, hot_share=hot_share)
    ordered = events.columns + [c for c in PROFILE_COLUMNS if c not in events.columns]
    return classify_bands(joined.select(*ordered), "speed", bounds, "expected_gear")


def to_enriched_record(df: DataFrame, schema=ENRICHED_EVENT) -> DataFrame:
    """Select the enriched-record fields in wire order and type (ids that do not fit are NULL)."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
