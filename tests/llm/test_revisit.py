"""Operator 6 against a scan in time order."""

import random

import pytest
from pyspark.sql import functions as F

from gearwatch.llm import queries
from gearwatch.llm.revisit import capture_log, EXCLUDED, canonical_url, header_lines, resolve_revisits
from tests.llm.helpers import SF
from tests.oracle_check import duck

SCHEMA = "record_id bigint, url string, captured bigint, status int, headers map<string,string>, payload string, base string"


def brute(records):
    out = []
    for rid, url, at, status, headers, _, _ in records:
        if status != 304:
            continue
        own = {k.lower(): v for k, v in (headers or {}).items()}
        earlier = [r for r in records if r[3] == 200 and None not in (url, at, r[1], r[2]) and r[1] == url and r[2] < at]
        if not earlier:
            out.append((rid, None, "no_base", None, None))
            continue
        base = max(earlier, key=lambda r: (r[2], r[0]))
        stored = {k.lower(): v for k, v in (base[4] or {}).items()}
        outcome = "no_validator"
        for name, word in (("etag", "etag_differs"), ("last-modified", "date_differs")):
            if name in own and name in stored:
                a, b = (x[name].strip().removeprefix("W/") if name == "etag" else x[name] for x in (own, stored))
                outcome = "merged" if a == b else word
                break
        if outcome != "merged":
            out.append((rid, base[0], outcome, None, None))
            continue
        listed = [x.strip() for x in own.get("connection", "").lower().split(",")]
        stored.update({k: v for k, v in own.items() if k not in EXCLUDED and k not in listed})
        out.append((rid, base[0], outcome, "\n".join(f"{k}: {v}" for k, v in sorted(stored.items())), base[5]))
    return sorted(out, key=str)


def check(df, records):
    rows = df.withColumn("headers", header_lines(F.col("headers"))).collect()
    assert sorted(((r.record_id, r.base_id, r.outcome, r.headers, r.payload) for r in rows), key=str) == brute(records)


def sample(n, seed):
    rng = random.Random(seed)
    records = []
    for i in range(n):
        headers = {"Age": str(i)} | rng.choice([{"ETag": '"a"'}, {"etag": 'W/"a"'}, {"ETag": '"b"'}, {}])
        headers |= rng.choice([{"Last-Modified": "d1"}, {"last-modified": "d2"}, {}])
        headers |= rng.choice([{"Connection": "close, Age", "Content-Length": "0", "Content-Type": "x"}, {"Set-Cookie": "q"}])
        url = rng.choice(["hot.example/a"] * 6 + ["b.example", "c.example/x", None])
        records.append((i, url, rng.choice([None, *range(200)]), rng.choice([200, 304, 304, 404]),
                        rng.choice([headers, headers, headers, None]), f"p{i}", "clash"))
    return records


@pytest.mark.parametrize("stretches", [1, 7, 4096])
def test_hot_url_ties_and_nulls(spark, stretches):
    records = sample(400, stretches)
    records += [r for r in records[:40] if r[3] == 304]  # repeated rows
    check(resolve_revisits(spark.createDataFrame(records, SCHEMA).repartition(4), stretches), records)


def test_equal_names_and_empty_tables(spark):
    df = spark.sql("""select * from values
        (1L, 'u.example', 1L, 200, map('ETag', 'x', 'etag', 'y', 'A', null), 'p'),
        (2L, 'u.example', 2L, 304, map('ETAG', 'y', 'b', null), null) t(record_id, url, captured, status, headers, payload)""")
    row = resolve_revisits(df).withColumn("headers", header_lines(F.col("headers"))).first()
    assert (row.outcome, row.headers) == ("merged", "a: \nb: \netag: y")
    assert resolve_revisits(df.where("false")).count() == 0
    assert resolve_revisits(df.where("status = 200")).count() == 0
    assert resolve_revisits(df.where("status = 304")).first().outcome == "no_base"


def test_canonical_url(spark):
    cases = {
        "HTTP://user@WWW.Example.com:80/A/b/?b=2&utm_source=x&a=1&ref=q#top": "example.com/A/b?a=1&b=2",
        "https://example.com/": "example.com", "example.com": "example.com", "https://m.example.com:8080/x?": "m.example.com:8080/x",
        "": "", None: None, "https://example.com?q=http://a.b/#f": "example.com?q=http://a.b/",
    }
    df = spark.createDataFrame([(k,) for k in cases], "url string")
    assert {r.url: r.c for r in df.select("url", canonical_url(F.col("url")).alias("c")).collect()} == cases


def test_op6_whole_table(spark):
    want = duck(SF).execute(queries.ORACLE_SQL["op6_revisits"]).df()
    got = queries.op6_revisits(spark, SF).toPandas()[list(want.columns)]
    key = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    fix = lambda df: df.assign(base_id=df.base_id.fillna(-1).astype(int))
    assert key(fix(got)) == key(fix(want))
    assert {"merged", "etag_differs", "no_validator"} <= set(got.outcome)


def test_capture_log_takes_any_page_id(spark):
    ids = [0, 1, 49, 50, 7 * 10**8, 2 * 10**11, 6 * 10**18, 2**63 - 1, -2**63, -5, None]
    pages = spark.createDataFrame([(i, "http://a.example/x", "<p>") for i in ids], "page_id long, url string, html string")
    records = capture_log(pages).collect()
    assert len(records) == 2 * len(ids)
    assert len({r.record_id for r in records if r.record_id is not None}) >= 2 * (len(ids) - 1) - 2
    days = [r.headers["Last-Modified"] for r in records if r.status == 200 and r.record_id is not None]
    assert all(len(d) == 10 for d in days)
    found = resolve_revisits(capture_log(pages)).collect()
    assert len(found) == len(ids) and sum(r.outcome == "merged" for r in found) > 0


def test_times_far_apart(spark):
    rows = [(1, "u.example", -2**63, 200, {"etag": "x"}, "p"), (2, "u.example", 2**63 - 1, 304, {"etag": "x"}, None)]
    schema = "record_id long, url string, captured long, status int, headers map<string,string>, payload string"
    assert [(r.base_id, r.outcome) for r in resolve_revisits(spark.createDataFrame(rows, schema)).collect()] == [(1, "merged")]
