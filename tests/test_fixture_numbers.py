"""Fingerprints from FIXTURES.md (sf0.001) computed through the library."""

from pyspark.sql import functions as F

from gearwatch.operators.enrich import enrich
from gearwatch.operators.rules import detect, gear_mismatch, high_rpm, overspeed
from gearwatch.operators.windows import window_metrics
from gearwatch.sources.dims import car_colors, car_models
from gearwatch.sources.testdata import telemetry_cars, telemetry_events

from tests.conftest import SF0001


def _enriched(spark):
    return enrich(telemetry_events(spark, SF0001), telemetry_cars(spark, SF0001),
                  car_models(spark), car_colors(spark))


def test_event_and_join_numbers(spark):
    ev = telemetry_events(spark, SF0001)
    assert ev.count() == 1000
    assert ev.select("car_id").distinct().count() == 15
    enr = _enriched(spark)
    assert enr.where(F.col("driver_id").isNotNull()).count() == 774


def test_rule_numbers(spark):
    enr = _enriched(spark)
    assert detect(enr, [overspeed()]).count() == 83
    assert detect(enr, [high_rpm()]).count() == 143
    assert detect(enr, [gear_mismatch()]).count() == 837
    assert detect(enr).count() == 865
    bands = {r.expected_gear: r["count"] for r in enr.groupBy("expected_gear").count().collect()}
    assert bands == {1: 449, 2: 238, 3: 145, 4: 85, 5: 43, 6: 18, 7: 22}


def test_window_numbers(spark):
    w = window_metrics(detect(_enriched(spark)), "ts")
    agg = w.agg(F.count("*"), F.sum("num_of_black"), F.sum("num_of_white"), F.sum("num_of_silver"),
                F.max("maximum_speed"), F.max("maximum_gear"), F.max("maximum_rpm")).first()
    assert tuple(agg) == (752, 121, 112, 0, 327.53, 6, 6935)
    assert dict(w.dtypes)["window_start"] == "timestamp_ntz"
    assert w.columns == ["window_start", "window_end", "num_of_rows", "num_of_black", "num_of_white",
                         "num_of_silver", "maximum_speed", "maximum_gear", "maximum_rpm"]
