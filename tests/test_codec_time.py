import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from gearwatch.functions.codec import decode, encode
from gearwatch.functions.eventtime import format_event_time, parse_event_time, utc_of_instant
from gearwatch.schemas import ENRICHED_EVENT, RAW_EVENT

FIELDS = [f.name for f in RAW_EVENT.fields]


def _decode_texts(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return {r.i: r for r in decode(df, RAW_EVENT, keep=("i",)).collect()}


def test_json_damage(spark):
    got = _decode_texts(spark, [
        "{bad", "null", '[{"event_id":"x"}]', "", None,
        '{"event_id":"b","car_id":99999999999,"speed":150,"rpm":3200.0,"gear":"4"}',
        '{"event_id":"d","speed":"NaN","extra":1}',
    ])
    for i in range(5):
        assert all(got[i][f] is None for f in FIELDS), i
    b = got[5]
    assert (b.event_id, b.speed, b.car_id, b.rpm, b.gear) == ("b", 150.0, None, None, None)
    d = got[6]
    assert d.event_id == "d" and math.isnan(d.speed) and d.rpm is None
    assert len(got) == 7  # rows are never dropped


def test_encode_omits_nulls_and_round_trips(spark):
    rows = [("e1", None, 7, None, 3000, 2), ("e2", "t", None, float("nan"), None, None)]
    df = spark.createDataFrame(rows, RAW_EVENT)
    enc = encode(df, FIELDS, key="event_id")
    texts = [(bytes(r.key).decode(), json.loads(bytes(r.value).decode())) for r in enc.collect()]
    assert texts[0] == ("e1", {"event_id": "e1", "car_id": 7, "rpm": 3000, "gear": 2})
    back = decode(enc, RAW_EVENT).collect()
    assert back[0] == df.collect()[0]
    assert math.isnan(back[1].speed) and back[1].event_time == "t"


def test_all_null_enriched_record_encodes_to_expected_gear_only(spark):
    from gearwatch.operators.enrich import to_enriched_record
    from gearwatch.functions.bands import classify_bands
    df = spark.createDataFrame([(None,) * 6], RAW_EVENT)
    rec = to_enriched_record(classify_bands(df.select(
        *FIELDS, *[F.lit(None).cast("string").alias(c)
                   for c in ("driver_id", "brand_name", "model_name", "color_name")])))
    assert [r.value for r in encode(rec, [f.name for f in ENRICHED_EVENT.fields], as_binary=False)
            .collect()] == ['{"expected_gear":7}']


TIME_CASES = [
    ("2025-10-17T20:06:33.569184+00:00", dt.datetime(2025, 10, 17, 20, 6, 33, 569184)),
    ("2025-10-17T14:22:35.123Z", dt.datetime(2025, 10, 17, 14, 22, 35, 123000)),
    ("2025-10-17T14:22:35.123+02:00", dt.datetime(2025, 10, 17, 12, 22, 35, 123000)),
    ("2025-10-17T14:22:35+00:00", None),
    ("junk", None),
]


def test_parse_event_time(spark):
    df = spark.createDataFrame([(t,) for t, _ in TIME_CASES], "s string")
    got = [r.t for r in df.select(utc_of_instant(parse_event_time(F.col("s"))).alias("t")).collect()]
    assert got == [want for _, want in TIME_CASES]
    lenient = df.select(utc_of_instant(parse_event_time(F.col("s"), lenient=True)).alias("t")).collect()
    assert lenient[3].t == dt.datetime(2025, 10, 17, 14, 22, 35) and lenient[4].t is None


def test_format_is_zone_independent(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:07.179575' AS ts")
    want = "2024-01-01T00:00:07.179575+00:00"
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(format_event_time(F.col("ts"))).first()[0] == want
            parsed = df.select(utc_of_instant(parse_event_time(format_event_time(F.col("ts"))))).first()[0]
            assert parsed == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


EDGES = {  # instants around both clock changes, as UTC wall clock
    "America/New_York": ["2024-03-10 06:59:59.999999", "2024-03-10 07:00:00", "2024-03-10 02:30:00",
                         "2024-11-03 05:30:00", "2024-11-03 06:30:00.5", "2024-11-03 07:30:00"],
    "Europe/Berlin": ["2024-03-31 00:59:59", "2024-03-31 01:00:00", "2024-03-31 02:30:00.25",
                      "2024-10-27 00:30:00", "2024-10-27 01:30:00", "2024-10-27 02:30:00", "1950-06-01 12:00:00.000001"],
}


@pytest.mark.parametrize("zone", EDGES)
def test_clock_changes_move_nothing(spark, zone):
    from gearwatch.functions.eventtime import instant_of_utc
    from gearwatch.operators.windows import window_metrics
    df = spark.createDataFrame([(t,) for t in EDGES[zone]], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        text = format_event_time(F.col("ts"))
        got = df.select("ts", text.alias("text"), utc_of_instant(instant_of_utc(F.col("ts"))).alias("back"),
                        utc_of_instant(parse_event_time(text)).alias("parsed"),
                        F.unix_micros(instant_of_utc(F.col("ts"))).alias("micros")).collect()
        for r in got:
            assert r.back == r.parsed == r.ts
            assert r.text == r.ts.isoformat(timespec="microseconds") + "+00:00"
            assert r.micros == (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        rows = df.withColumns({"color_name": F.lit("Black"), "speed": F.lit(1.0), "gear": F.lit(1), "rpm": F.lit(1)})
        for watermark in (None, "48 hours"):
            starts = sorted(r.window_start for r in window_metrics(rows, "ts", watermark=watermark).collect())
            assert starts == sorted({dt.datetime(1970, 1, 1) + (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(minutes=15)
                                     * dt.timedelta(minutes=15) for r in got})
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_window_metrics_equal_utc_in_other_zones(spark):
    from gearwatch.plans.catalog import QUERIES
    from tests.conftest import SF0001
    want = sorted(map(tuple, QUERIES["window_metrics"](spark, SF0001).collect()))
    try:
        for zone in EDGES:
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert sorted(map(tuple, QUERIES["window_metrics"](spark, SF0001).collect())) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
