"""Operator 6, not-modified revisits of a web archive resolved to the response they confirm.

A 304 record has no payload: it stands for the latest earlier full response of its canonical URL.  That
response is found by an as-of join, then the validators are checked (entity tag by weak comparison,
else the modification date) and the stored headers are brought up to date with those of the 304
that a cache may take over: all but the ones that describe the stored payload, the
connection's own, and those that the Connection field lists.

The as-of join is a window over (URL, stretch of time).  The time span is cut into ``STRETCHES`` parts, so
that one URL with a large share of all records is spread over as many groups; each group is given
the last full response of earlier stretches as its first row.  Only those carried rows, at most
``STRETCHES`` for a URL, meet by URL alone.  All of it is DataFrame functions; payloads do not move.

Defined results: every 304 row gives one row, repeated rows included; without a URL or a time it has no
base (outcome ``no_base``), and such a full response is never one; of full responses at one time the
larger record id counts as later; a full response at the time of the 304 is not earlier; header names are
compared in lower case, the last of equal ones counts; null headers count as none; an empty table gives an
empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCHES = 4096
DAYS = 730_000  # of last-modified dates that ``capture_log`` deals out
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
#: Not taken over from a 304: they describe the stored payload or one connection.
EXCLUDED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
            "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer",
            "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Host in lower case, path and remaining query in order: no scheme, user, ``www.``, default port, fragment,
    tracking parameters or closing slash."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, "^[^/?]*", 0), "^.*@", ""))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    query = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.lower(p).rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _names_lowered(headers: Column) -> Column:
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))),
                                                    lambda later: later.key == e.key))
    return F.coalesce(F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def merged_headers(stored: Column, update: Column) -> Column:
    """``stored`` with the fields of ``update`` that a cache may take over (names in lower case)."""
    listed = F.transform(F.split(F.lower(F.coalesce(update["connection"], F.lit(""))), ","), lambda x: F.trim(x))
    taken = F.map_filter(update, lambda name, _: ~name.isin(*EXCLUDED) & ~F.array_contains(listed, name))
    return F.map_concat(F.map_filter(stored, lambda name, _: ~F.map_contains_key(taken, name)), taken)


def header_lines(headers: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)),
                                    lambda e: F.concat(e.key, F.lit(": "), F.coalesce(e.value, F.lit("")))), "\n")


def resolve_revisits(records: DataFrame, stretches: int = STRETCHES) -> DataFrame:
    """One row for each 304 of ``records`` (``record_id``, ``url``, ``captured``, ``status``, ``headers``,
    ``payload``): ``record_id``, ``url``, ``canonical_url``, ``captured``, ``base_id``, ``outcome``, and of
    a base that the validators confirm ``headers`` (merged) and ``payload``.

    Outcomes: ``merged``, ``no_base``, ``etag_differs``, ``date_differs``, ``no_validator``.
    """
    rows = records.where(F.col("status").isin(200, 304)).select(
        F.col("record_id"), F.col("url"), canonical_url(F.col("url")).alias("canonical_url"),
        F.col("captured").cast("bigint").alias("captured"), (F.col("status") == 200).alias("full"),
        _names_lowered(F.col("headers")).alias("headers"), F.col("payload"))
    placed = rows.where("canonical_url is not null and captured is not null")
    low, high = placed.agg(F.min("captured"), F.max("captured")).first()
    width = max(1, ((high or 0) - (low or 0)) // stretches + 1)
    # the span of all times may exceed a long: the number of the stretch does not
    placed = placed.withColumn("stretch", F.expr(f"(cast(captured as decimal(20,0)) - {low or 0}BD) div {width}BD"))
    base = F.when(F.col("full"), F.struct("record_id", "headers", "payload"))

    last = placed.where("full").groupBy("canonical_url", "stretch").agg(
        F.max_by(F.struct("record_id", "headers", "payload"), F.struct("captured", "record_id")).alias("base"))
    asked = placed.where("not full").select("canonical_url", "stretch").distinct().withColumn(
        "base", F.lit(None).cast(last.schema["base"].dataType))
    earlier = Window.partitionBy("canonical_url").orderBy("stretch", F.col("base").isNotNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    carried = last.unionByName(asked).withColumn("carried", F.last("base", ignorenulls=True).over(earlier)).where(
        "base is null and carried is not null")  # a stretch's request comes before its own response

    first = carried.select("canonical_url", "stretch", F.lit(0).alias("turn"), F.col("carried").alias("base"))
    events = placed.select("*", F.lit(1).alias("turn"), base.alias("base")).unionByName(first, allowMissingColumns=True)
    before = Window.partitionBy("canonical_url", "stretch").orderBy("turn", "captured", "full", "record_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("base", F.last("base", ignorenulls=True).over(before)).where("turn = 1 and not full")
    unplaced = rows.where("not full and (canonical_url is null or captured is null)")
    found = found.unionByName(unplaced, allowMissingColumns=True)

    def tag(headers: Column) -> Column:
        return F.regexp_replace(F.trim(headers["etag"]), "^W/", "")

    own, stored = F.col("headers"), F.col("base.headers")
    outcome = (F.when(F.col("base").isNull(), "no_base")
               .when(tag(own).isNotNull() & tag(stored).isNotNull(), F.when(tag(own) == tag(stored), "merged").otherwise("etag_differs"))
               .when(own["last-modified"].isNotNull() & stored["last-modified"].isNotNull(),
                     F.when(own["last-modified"] == stored["last-modified"], "merged").otherwise("date_differs"))
               .otherwise("no_validator"))
    confirmed = F.col("outcome") == "merged"
    return found.withColumn("outcome", outcome).select(
        "record_id", "url", "canonical_url", "captured", F.col("base.record_id").alias("base_id"), "outcome",
        F.when(confirmed, merged_headers(stored, own)).alias("headers"),
        F.when(confirmed, F.col("base.payload")).alias("payload"))


def capture_log(pages: DataFrame) -> DataFrame:
    """An archive's records made of ``pages`` (``page_id``, ``url``, ``html``): each page as a full response, and
    a later 304 for it, with validators of every kind by page id.

    Times are ten units a page; the 304 comes up to 10,000 units later, so other captures of the URL may
    lie between.  A payload is named by the MD5 of the page.  Any page id does: record ids are the page's bits moved up
    by one, times repeat after 10^17 pages and days after ``DAYS``.
    """
    page, payload = F.col("page_id").cast("bigint"), F.md5(F.coalesce("html", F.lit("")))
    double, time = F.shiftleft(page, 1), page % 10**17 * 10
    tag = F.concat(F.lit('"'), F.substring(payload, 1, 16), F.lit('"'))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.floor(page % (50 * DAYS) / 50).cast("int")), "yyyy-MM-dd")

    def headers(*fields: tuple[str, Column]) -> Column:
        pairs = F.array(*(F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in fields))
        return F.map_from_entries(F.filter(pairs, lambda e: e.value.isNotNull()))

    full = pages.select(
        double.alias("record_id"), "url", time.alias("captured"), F.lit(200).alias("status"),
        headers(("Content-Type", F.lit("text/html")), ("Content-Length", F.octet_length(F.coalesce("html", F.lit(""))).cast("string")),
                ("ETag", F.when(page % 7 != 0, tag)), ("Last-Modified", day), ("Cache-Control", F.lit("max-age=60")),
                ("X-Page", page.cast("string"))).alias("headers"),
        payload.alias("payload"))
    kind = page % 5
    sent = (F.when(kind == 0, tag).when(kind == 2, F.concat(F.lit("W/"), tag)).when(kind == 3, F.lit('"other"')))
    later = pages.select(
        double.bitwiseOR(F.lit(1)).alias("record_id"), "url", (time + 5 + page % 1000 * 7919 % 1000 * 10).alias("captured"),
        F.lit(304).alias("status"),
        headers(("etag", sent), ("last-modified", F.when(kind.isin(0, 1), day)), ("Cache-Control", F.lit("max-age=600")),
                ("Content-Length", F.lit("0")), ("Connection", F.lit("close, X-Hop")), ("X-Hop", F.lit("1")),
                ("Age", (page % 60).cast("string"))).alias("headers"),
        F.lit(None).cast("string").alias("payload"))
    return reduce(DataFrame.unionByName, (full, later))
