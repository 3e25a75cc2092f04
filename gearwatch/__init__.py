"""gearwatch: vehicle-telemetry analytics as Spark DataFrame / Structured Streaming plans.

Every public function takes and returns a ``DataFrame`` and works the same on a
batch frame and on a streaming frame, so one definition serves both.
"""

from gearwatch.functions.bands import GEAR_BOUNDS, classify_bands
from gearwatch.functions.codec import decode, encode
from gearwatch.functions.eventtime import format_event_time, parse_event_time
from gearwatch.operators.enrich import enrich, to_enriched_record
from gearwatch.operators.rules import DEFAULT_RULES, Rule, detect
from gearwatch.operators.windows import window_metrics
from gearwatch.plans.chain import fused_from_records, fused_plan

__all__ = [
    "DEFAULT_RULES",
    "GEAR_BOUNDS",
    "Rule",
    "classify_bands",
    "decode",
    "detect",
    "encode",
    "enrich",
    "format_event_time",
    "fused_from_records",
    "fused_plan",
    "parse_event_time",
    "to_enriched_record",
    "window_metrics",
]
