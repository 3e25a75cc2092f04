import math

import pytest
from pyspark.sql import functions as F

from gearwatch.functions.bands import band_of, classify_bands
from gearwatch.operators.rules import DEFAULT_RULES, Rule, any_rule, detect

# speed -> expected gear, edges included (FIXTURES.md section 3)
BAND_CASES = [(-0.01, 0), (0.0, 1), (29.99, 1), (30.0, 2), (60.0, 3), (90.0, 4), (97.4, 4),
              (120.0, 5), (137.4, 5), (150.0, 6), (179.99, 6), (180.0, 7), (float("nan"), 7), (None, 7)]


def test_band_edges(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(BAND_CASES)], "i int, speed double")
    got = {r.i: r.expected_gear for r in classify_bands(df).collect()}
    assert got == {i: g for i, (_, g) in enumerate(BAND_CASES)}
    assert dict(classify_bands(df).dtypes)["expected_gear"] == "int"


def test_band_custom_bounds_and_validation(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (25.0,)], "x double")
    assert [r.b for r in df.select(band_of(F.col("x"), [10, 20]).alias("b")).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        band_of(F.col("x"), [20, 10])
    with pytest.raises(ValueError):
        band_of(F.col("x"), [])


# (speed, rpm, gear, expected_gear) -> alert?
ALERT_CASES = [((100.0, 3000, 4, 4), False), ((120.0, 6000, 5, 5), False), ((120.01, 3000, 5, 5), True),
               ((100.0, 6001, 4, 4), True), ((100.0, 3000, 3, 4), True), ((None, 3000, 4, 7), True),
               ((100.0, 3000, None, 4), False), ((130.0, None, None, 5), True),
               ((None, None, None, 7), False), ((float("nan"), 3000, 4, 7), True)]


def test_alert_filter_three_valued(spark):
    rows = [(i, *vals) for i, (vals, _) in enumerate(ALERT_CASES)]
    df = spark.createDataFrame(rows, "i int, speed double, rpm int, gear int, expected_gear int")
    kept = {r.i for r in detect(df).collect()}
    assert kept == {i for i, (_, alert) in enumerate(ALERT_CASES) if alert}


def test_custom_rule_list(spark):
    df = spark.createDataFrame([(1, 50.0), (2, 150.0)], "i int, speed double")
    fast = Rule("fast", lambda: F.col("speed") > 100)
    assert [r.i for r in detect(df, [fast]).collect()] == [2]
    with pytest.raises(ValueError):
        any_rule([])
    assert sorted(r.name for r in DEFAULT_RULES) == ["gear_mismatch", "high_rpm", "overspeed"]
    assert not math.isnan(0.0)
