"""Pipelines: enrich -> detect -> window metrics, fused into one plan or staged via JSON.

The fused plan is the efficient one.  The rule predicate reads only event
columns (speed, rpm, gear and a function of speed), so Catalyst evaluates it
below the left joins, right after the scan, and the joins only see alerts.
The staged plan keeps the reference's hand-offs: every stage decodes JSON
records and encodes its output again, as separate jobs behind topics would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gearwatch.functions.bands import GEAR_BOUNDS
from gearwatch.functions.codec import decode, encode
from gearwatch.functions.eventtime import parse_event_time
from gearwatch.operators.delivery import once_within
from gearwatch.operators.enrich import enrich, to_enriched_record
from gearwatch.operators.rules import DEFAULT_RULES, Rule, detect
from gearwatch.operators.windows import COUNTED_COLORS, WINDOW, window_metrics
from gearwatch.schemas import ENRICHED_EVENT, RAW_EVENT

ENRICHED_FIELDS = [f.name for f in ENRICHED_EVENT.fields]

# What records that are kept in order by car are sorted by (columns beside the record).
SENT_ORDER = ("event_time_ts", "event_id")


def decode_once(records: DataFrame, schema: StructType, dedup_within: str | None) -> DataFrame:
    """``decode``; with ``dedup_within``, an event id that arrives again within that span is left out."""
    if dedup_within is None:
        return decode(records, schema)
    return once_within(decode(records, schema, keep=("timestamp",)), ["event_id"], "timestamp", dedup_within).drop("timestamp")


def encode_enriched(events: DataFrame, ordered: bool) -> DataFrame:
    """Topic records of enriched events; ``ordered``: keyed by car, with ``SENT_ORDER`` beside them."""
    if not ordered:
        return encode(events, ENRICHED_FIELDS)
    timed = events.withColumn("event_time_ts", parse_event_time(F.col("event_time")))
    return encode(timed, ENRICHED_FIELDS, key="car_id", keep=SENT_ORDER)


def enrichment_stage(raw: DataFrame, cars: DataFrame | None, models: DataFrame | None,
                     colors: DataFrame | None, bounds: Sequence[float] = GEAR_BOUNDS, *,
                     dedup_within: str | None = None, ordered: bool = False, **join_opts) -> DataFrame:
    """Topic records of raw events -> topic records (``value``; ``ordered``: and ``key``) of enriched events."""
    events = decode_once(raw, RAW_EVENT, dedup_within)
    enriched = to_enriched_record(enrich(events, cars, models, colors, bounds=bounds, **join_opts))
    return encode_enriched(enriched, ordered)


def detection_stage(enriched_records: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, *,
                    dedup_within: str | None = None, ordered: bool = False) -> DataFrame:
    """Topic records of enriched events -> topic records of alerts."""
    alerts = detect(decode_once(enriched_records, ENRICHED_EVENT, dedup_within), rules)
    return encode_enriched(alerts, ordered)


def counting_stage(alert_records: DataFrame, *, window: str = WINDOW, watermark: str | None = None,
                   categories: Sequence[str] = COUNTED_COLORS, lenient_time: bool = False) -> DataFrame:
    """Topic records of alerts -> window metrics."""
    alerts = decode(alert_records, ENRICHED_EVENT)
    timed = alerts.withColumn("event_time_ts", parse_event_time(F.col("event_time"), lenient=lenient_time))
    return window_metrics(timed, "event_time_ts", window=window, watermark=watermark,
                          categories=categories)


def staged_plan(raw: DataFrame, cars: DataFrame, models: DataFrame, colors: DataFrame,
                    **opts) -> DataFrame:
    """The three stages chained with their JSON hand-offs, as one plan."""
    window_opts = {k: opts.pop(k) for k in ("window", "watermark", "categories", "lenient_time")
                   if k in opts}
    rules = opts.pop("rules", DEFAULT_RULES)
    enriched = enrichment_stage(raw, cars, models, colors, **opts)
    return counting_stage(detection_stage(enriched, rules), **window_opts)


def fused_from_records(raw: DataFrame, cars: DataFrame | None, models: DataFrame | None,
                       colors: DataFrame | None, *, window: str = WINDOW,
                       watermark: str | None = None, categories: Sequence[str] = COUNTED_COLORS,
                       rules: Sequence[Rule] = DEFAULT_RULES, lenient_time: bool = False,
                       **join_opts) -> DataFrame:
    """Raw-event topic records -> window metrics in one plan (no intermediate topics).

    Same result as the three staged jobs: the JSON hand-offs are lossless for
    the record schema, and the alert rules read only event columns, so the
    filter runs before the joins.
    """
    events = decode(raw, RAW_EVENT).withColumn(
        "event_time_ts", parse_event_time(F.col("event_time"), lenient=lenient_time))
    alerts = alerts_of(events, cars, models, colors, rules=rules, **join_opts)
    return window_metrics(alerts, "event_time_ts", window=window, watermark=watermark,
                          categories=categories)


def alerts_of(events: DataFrame, cars: DataFrame, models: DataFrame, colors: DataFrame, *,
              rules: Sequence[Rule] = DEFAULT_RULES, bounds: Sequence[float] = GEAR_BOUNDS,
              **join_opts) -> DataFrame:
    """Enriched alert rows (all event columns kept, e.g. ``ts``)."""
    return detect(enrich(events, cars, models, colors, bounds=bounds, **join_opts), rules)


def fused_plan(events: DataFrame, cars: DataFrame, models: DataFrame, colors: DataFrame, *,
                   time_col: str = "ts", window: str = WINDOW, watermark: str | None = None,
                   categories: Sequence[str] = COUNTED_COLORS,
                   rules: Sequence[Rule] = DEFAULT_RULES, bounds: Sequence[float] = GEAR_BOUNDS,
                   **join_opts) -> DataFrame:
    """Typed events -> window metrics of their alerts, in one plan without JSON hops."""
    alerts = alerts_of(events, cars, models, colors, rules=rules, bounds=bounds, **join_opts)
    return window_metrics(alerts, time_col, window=window, watermark=watermark,
                          categories=categories)
