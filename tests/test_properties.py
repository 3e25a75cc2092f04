"""Property tests: each example is evaluated as one DataFrame against a plain-Python model."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gearwatch.functions.bands import band_of
from gearwatch.functions.codec import decode, encode
from gearwatch.functions.hashing import hash31, uniform_int
from gearwatch.operators.joins import hot_keys, salted_left_join
from gearwatch.schemas import RAW_EVENT

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
M31 = 2 ** 31


def py_hash31(x: int, salt: int) -> int:
    f = (x ^ (x >> 31)) % M31
    a = ((f + salt * 7919 + 1) * 2654435761) % M31
    b = ((a ^ (a >> 15)) * 2246822519) % M31
    c = ((b ^ (b >> 13)) * 3266489917) % M31
    return c ^ (c >> 16)


def py_band(v, bounds):
    if v is None or math.isnan(v):
        return len(bounds)
    return next((i for i, b in enumerate(bounds) if v < b), len(bounds))


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True,
                                                         min_value=None, max_value=None)),
                       min_size=1, max_size=60),
       bounds=st.lists(st.integers(-500, 500), min_size=1, max_size=9, unique=True).map(sorted))
def test_band_matches_model(spark, values, bounds):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.b for r in df.select("i", band_of(F.col("v"), bounds).alias("b")).collect()}
    assert got == {i: py_band(v, bounds) for i, v in enumerate(values)}


@SETTINGS
@given(ids=st.lists(st.integers(0, 2 ** 62), min_size=1, max_size=60),
       salt=st.integers(0, 50), lo=st.integers(-10 ** 6, 10 ** 6), span=st.integers(1, 10 ** 9))
def test_hash_matches_model_and_stays_in_range(spark, ids, salt, lo, span):
    hi = lo + span - 1
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, x bigint")
    rows = df.select("i", "x", hash31("x", salt).alias("h"),
                     uniform_int("x", lo, hi, salt).alias("u")).collect()
    for r in rows:
        h = py_hash31(r.x, salt)
        assert r.h == h and 0 <= h < M31
        assert r.u == lo + ((h * span) >> 31) and lo <= r.u <= hi


event = st.tuples(
    st.one_of(st.none(), st.text(max_size=12)),
    st.one_of(st.none(), st.text(max_size=12)),
    st.one_of(st.none(), st.integers(-2 ** 31, 2 ** 31 - 1)),
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
    st.one_of(st.none(), st.integers(-2 ** 31, 2 ** 31 - 1)),
    st.one_of(st.none(), st.integers(-2 ** 31, 2 ** 31 - 1)),
)


@SETTINGS
@given(rows=st.lists(event, min_size=1, max_size=40))
def test_json_round_trip_is_lossless(spark, rows):
    df = spark.createDataFrame(rows, RAW_EVENT)
    back = decode(encode(df, [f.name for f in RAW_EVENT.fields]), RAW_EVENT)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 12)), min_size=1, max_size=200),
       hot_key=st.integers(0, 12), hot_count=st.integers(0, 150),
       dim_keys=st.lists(st.integers(0, 14), max_size=30), buckets=st.integers(2, 9))
def test_salted_join_equals_plain_join(spark, keys, hot_key, hot_count, dim_keys, buckets):
    keys = keys + [hot_key] * hot_count
    ev = spark.createDataFrame([(f"e{i}", k) for i, k in enumerate(keys)], "event_id string, k int")
    dim = spark.createDataFrame([(k, j) for j, k in enumerate(dim_keys)] or [(99, 0)], "k bigint, v int")
    hot = hot_keys(ev, "k", share=1 / 8)
    assert hot == sorted({k for k in keys if k is not None and keys.count(k) >= max(2, len(keys) / 8)},
                         key=lambda k: (-keys.count(k), k))
    plain = ev.join(dim, "k", "left")
    cols = sorted(plain.columns)
    expect = sorted(map(tuple, plain.select(cols).collect()), key=repr)
    salted = salted_left_join(ev, dim, "k", ["event_id"], buckets, hot)
    assert sorted(map(tuple, salted.select(cols).collect()), key=repr) == expect


ws = st.text(alphabet=" \t\n\r", max_size=2)
flat = st.builds(lambda a, b, c, d, n: f'{{{a}"k"{b}:{c}{n}{d}}}', ws, ws, ws, ws,
                 st.one_of(st.integers(-2 ** 40, 2 ** 40).map(str),
                           st.sampled_from(["007", "-0", "1e2", "1.0", "2147483648", "-2147483648"])))
other = st.one_of(
    st.sampled_from(['{"k": "5"}', '{"x": {"k": 5}}', '{"k": 5, "k": 6}', '{"\\u006b": 5}', '{"k": 5}x',
                     "null", "", "[1]", '{"k":null}', "{bad", '{ "k" : 12 , "j": 1 }']),
    st.text(max_size=12))


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), flat, other), min_size=1, max_size=60))
def test_props_fast_path_equals_json_parse(spark, texts):
    from gearwatch.sources.testdata import props_k
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, props string")
    got = df.select("i", props_k(F.col("props")).alias("fast"),
                    F.from_json("props", "k INT").getField("k").alias("json")).collect()
    assert [(r.i, r.fast) for r in got] == [(r.i, r.json) for r in got]
