"""Registered queries over the given tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each one runs the library's operators over whole tables (``events`` and
``customer``); none reads made-up input alone.  Streaming queries run the same
operators under Structured Streaming until the available input is processed,
writing to a fresh folder under the shared checkpoint root, and return the
result read back from there.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.functions.bands import classify_bands
from gearwatch.functions.codec import decode, decode_checked, encode
from gearwatch.functions.eventtime import format_event_time, instant_of_utc, parse_event_time, utc_of_instant
from gearwatch.functions.hashing import hash31
from gearwatch.operators.enrich import car_profiles, enrich, lookup, to_enriched_record
from gearwatch.operators.rules import detect, gear_mismatch, high_rpm, overspeed
from gearwatch.operators.windows import WATERMARK, window_metrics
from gearwatch.plans.chain import (
    ENRICHED_FIELDS,
    alerts_of,
    counting_stage,
    fused_from_records,
    fused_plan,
    staged_plan,
)
from gearwatch.schemas import ENRICHED_EVENT, RAW_EVENT
from gearwatch.session import discard, fresh_dir, is_folder
from gearwatch.sources.dims import car_colors, car_models, publish_dimension, read_dimension, write_dimension
from gearwatch.sources.testdata import (
    cars_from_customers,
    read_table,
    sensor_columns,
    table_path,
    telemetry_cars,
    telemetry_events,
)
from gearwatch.sources.topics import (
    ALERT_TOPIC,
    ENRICHED_TOPIC,
    RAW_TOPIC,
    order_breaks,
    read_topic,
    record_positions,
    write_topic,
)
from gearwatch.streaming.audit import held_windows
from gearwatch.streaming.jobs import (
    counter_frame,
    publish_alert,
    start_detection,
    start_enrichment,
    start_quarantine,
    start_refreshed_enrichment,
)
from gearwatch.streaming.partials import WindowCounter
from gearwatch.streaming.runner import (
    await_or_stop,
    materialize,
    read_materialized,
    start_materialize,
)

Query = Callable[[SparkSession, str], DataFrame]
# One car and one instant that a third of the events are moved to (skew queries).
HOT_CAR = 7
HOT_TIME = "2024-01-10 10:07:00"
# Event time of the injected alert (inside the 30 days the given events cover).
INJECT_AT = "2024-01-15T12:05:00.000000+00:00"
WINDOW_KEYS = ("window_start", "window_end")
RAW_FIELDS = [f.name for f in RAW_EVENT.fields]


def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return telemetry_cars(spark, sf_dir), car_models(spark), car_colors(spark)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(telemetry_events(spark, sf_dir), *_dims(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_of(telemetry_events(spark, sf_dir), *_dims(spark, sf_dir))


def _class(df_id_col: str, salt: int, n: int):
    """Deterministic class in [0, n) of each event (every row is kept)."""
    return F.pmod(hash31(F.col(df_id_col).cast("bigint"), salt), F.lit(n))


# ------------------------------------------------------------------ sources and dimensions
def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_events(spark, sf_dir).select(
        "event_id", "ts", "event_time", "car_id", "speed", "rpm", "gear")


def scan_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the generic reader form of a Parquet scan
    customer = spark.read.format("parquet").load(table_path(sf_dir, "customer"))
    return cars_from_customers(customer)


def dim_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = os.path.join(fresh_dir(spark, "dims"), "cars", "v=1")
    write_dimension(telemetry_cars(spark, sf_dir, unregistered=False), path)
    return read_dimension(spark, path)


def literal_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return car_profiles(telemetry_cars(spark, sf_dir, unregistered=False), car_models(spark), car_colors(spark))


# ------------------------------------------------------------------ projections and codec
def expected_gear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_bands(telemetry_events(spark, sf_dir)).select("event_id", "speed", "expected_gear")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode(to_enriched_record(_enriched(spark, sf_dir)), ENRICHED_FIELDS)
    return decode(records, ENRICHED_EVENT)


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact wire text of enriched records (NULL fields left out)."""
    return encode(to_enriched_record(_enriched(spark, sf_dir)), ENRICHED_FIELDS, as_binary=False)


def _damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events' messages, seven of eight kinds of them damaged."""
    ev = telemetry_events(spark, sf_dir)
    whole = F.to_json(F.struct(*RAW_FIELDS))
    k = _class("event_id", 31, 8)
    text = (
        F.when(k == 0, F.concat(F.lit("{bad"), whole))                  # malformed
        .when(k == 1, F.lit("null"))                                    # JSON null
        .when(k == 2, F.concat(F.lit("["), whole, F.lit("]")))          # an array
        .when(k == 3, F.lit(""))                                        # empty message
        .when(k == 5, F.concat(F.lit('{"event_id":"'), F.col("event_id"),
                               F.lit('","car_id":99999999999,"speed":150,"rpm":3200.0,"gear":"4"}')))
        .when(k == 6, F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","speed":"fast","rpm":'),
                               F.coalesce(F.col("rpm").cast("string"), F.lit("null")),
                               F.lit(',"extra":1}')))
        .when(k == 7, whole)
    )                                                                   # k == 4: NULL value
    return ev.select(text.cast("binary").alias("value"))


def json_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(_damaged_messages(spark, sf_dir), RAW_EVENT)


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages set apart by a stream: the records of the checked topic, and the other topic's with their text."""
    base = fresh_dir(spark, "json-quarantine")
    topics = os.path.join(base, "topics")
    write_topic(_damaged_messages(spark, sf_dir), RAW_TOPIC, root=topics)
    await_or_stop(start_quarantine(spark, checkpoint=os.path.join(base, "ck"), topics_root=topics, sink="checked",
                                   bad_sink="damaged", trigger="available-now"))
    good = decode(read_topic(spark, "checked", root=topics, streaming=False), RAW_EVENT)
    bad = decode_checked(read_topic(spark, "damaged", root=topics, streaming=False), RAW_EVENT).drop("damaged")
    return good.select("*", F.lit(False).alias("damaged"), F.lit(None).cast("string").alias("text")).unionByName(
        bad.withColumn("damaged", F.lit(True)))


def parse_event_time_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = telemetry_events(spark, sf_dir)
    k = _class("event_id", 51, 4)
    shifted = format_event_time(F.col("ts") + F.expr("INTERVAL 2 HOURS"))
    text = (
        F.when(k == 0, F.col("event_time"))
        .when(k == 1, F.concat(F.substring("event_time", 1, 23), F.lit("Z")))       # milliseconds
        .when(k == 2, F.concat(F.substring(shifted, 1, 26), F.lit("+02:00")))
        .otherwise(F.concat(F.substring("event_time", 1, 19), F.lit("+00:00")))     # no fraction
    )
    timed = ev.select("event_id", text.alias("event_time"))
    return timed.withColumn("event_time_ts", utc_of_instant(parse_event_time(F.col("event_time"))))


# ------------------------------------------------------------------ joins
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(telemetry_events(spark, sf_dir), telemetry_cars(spark, sf_dir), "car_id").select(
        "event_id", "car_id", "driver_id", "model_id", "color_id")


def join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    cars = cars_from_customers(customer, unregistered=True)
    # cars registered a second time (another driver): their events double
    again = cars_from_customers(customer.where(F.col("c_mktsegment") == "AUTOMOBILE"), unregistered=True) \
        .withColumn("driver_id", F.col("driver_id") + F.lit(500000000))
    fleet = cars.unionByName(again).select("car_id", "driver_id")
    return lookup(telemetry_events(spark, sf_dir), fleet, "car_id").select("event_id", "car_id", "driver_id")


def enrich_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_enriched_record(_enriched(spark, sf_dir))


def _one_third(spark: SparkSession, sf_dir: str, salt: int):
    ev = telemetry_events(spark, sf_dir)
    return ev, _class("event_id", salt, 3) == 0


def enrich_hot_car(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all events belong to one car, a seventh of the others to none; the fleet is
    joined by shuffle (as a fleet too large to broadcast would be), so both are salted over many tasks."""
    ev, hot = _one_third(spark, sf_dir, 61)
    car = F.when(hot, F.lit(HOT_CAR)).when(_class("event_id", 62, 7) != 0, F.col("car_id"))
    out = enrich(ev.withColumn("car_id", car), *_dims(spark, sf_dir), broadcast_max_bytes=0, salt_buckets=16)
    return to_enriched_record(out)


def window_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all events fall into one 15-minute window (partial aggregation keeps
    that window at one row per task before the shuffle)."""
    ev, hot = _one_third(spark, sf_dir, 71)
    ev = ev.withColumn("ts", F.when(hot, F.lit(HOT_TIME).cast("timestamp_ntz")).otherwise(F.col("ts")))
    return fused_plan(ev, *_dims(spark, sf_dir), time_col="ts")


# ------------------------------------------------------------------ rules
def _rule_query(rule):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_enriched_record(detect(_enriched(spark, sf_dir), [rule]))
    return run


def alerts_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_enriched_record(_alerts(spark, sf_dir))


def alerts_null_logic(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = telemetry_events(spark, sf_dir)
    k = _class("event_id", 41, 4)

    def blank(col, classes):
        return F.when(k.isin(*classes), F.lit(None)).otherwise(F.col(col)).alias(col)

    holed = ev.select("event_id", "ts", "event_time", "car_id",
                      blank("speed", (0, 3)).cast("double").alias("speed"),
                      blank("rpm", (2, 3)).cast("int").alias("rpm"),
                      blank("gear", (1, 3)).cast("int").alias("gear"))
    return alerts_of(holed, *_dims(spark, sf_dir)).select("event_id", "speed", "rpm", "gear", "expected_gear")


# ------------------------------------------------------------------ windows and chains
def _alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(to_enriched_record(_alerts(spark, sf_dir)), ENRICHED_FIELDS)


def window_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting_stage(_alert_records(spark, sf_dir))


def fused_alert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fused_plan(telemetry_events(spark, sf_dir), *_dims(spark, sf_dir), time_col="ts")


def staged_topic_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = encode(telemetry_events(spark, sf_dir), RAW_FIELDS, key="event_id")
    return staged_plan(raw, *_dims(spark, sf_dir))


def inject_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detection job's alert topic, the manual alert published into it, and the counter over both."""
    base = fresh_dir(spark, "inject-alert")
    topics = os.path.join(base, "topics")
    write_topic(encode(to_enriched_record(_enriched(spark, sf_dir)), ENRICHED_FIELDS), ENRICHED_TOPIC, root=topics)
    await_or_stop(start_detection(spark, checkpoint=os.path.join(base, "ck-detect"), topics_root=topics,
                                  trigger="available-now"))
    publish_alert(spark, topics_root=topics, event_time=INJECT_AT)
    metrics = counter_frame(spark, topics_root=topics, watermark=WATERMARK)
    return _finished(spark, base, metrics, "complete")


def preview(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    return to_enriched_record(_alerts(spark, sf_dir).orderBy("ts", "event_id").limit(n))


# ------------------------------------------------------------------ streaming
def stream_table(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A given table opened as a file stream (schema from the footers, no inference).

    By default all files that are there make one micro-batch: files are not in order of event
    time, so a watermark of one batch could rule out rows of the next."""
    path = table_path(sf_dir, name).rstrip("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, path):
        return reader.parquet(path)
    # the table is one file: stream its folder, filtered to that file
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))


def _stream_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return sensor_columns(stream_table(spark, sf_dir, "events", max_files_per_trigger))


def _finished(spark: SparkSession, base: str, df: DataFrame, mode: str, key_cols=()) -> DataFrame:
    """The result of a stream, read from ``base``; what else was written there is given up."""
    out, state = os.path.join(base, "out"), os.path.join(base, "state")
    result = materialize(df, output_mode=mode, out_dir=out, checkpoint=state, key_cols=key_cols)
    for scratch in ("state", "topics", "inbox", "ck-enrich", "ck-detect"):
        discard(spark, os.path.join(base, scratch))
    return result


def _run(spark: SparkSession, name: str, df: DataFrame, mode: str, key_cols=()) -> DataFrame:
    return _finished(spark, fresh_dir(spark, name), df, mode, key_cols)


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = to_enriched_record(enrich(_stream_events(spark, sf_dir), *_dims(spark, sf_dir)))
    return _run(spark, "stream-enrich", df, "append")


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = to_enriched_record(alerts_of(_stream_events(spark, sf_dir), *_dims(spark, sf_dir)))
    return _run(spark, "stream-alerts", df, "append")


def _stream_windows(spark: SparkSession, sf_dir: str, source: DataFrame | None = None,
                    watermark: str = WATERMARK) -> DataFrame:
    events = source if source is not None else _stream_events(spark, sf_dir)
    return window_metrics(alerts_of(events, *_dims(spark, sf_dir)), "ts", watermark=watermark)


def stream_window_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, "stream-complete", _stream_windows(spark, sf_dir), "complete")


def stream_window_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, "stream-update", _stream_windows(spark, sf_dir), "update", WINDOW_KEYS)


def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, "stream-append", _stream_windows(spark, sf_dir), "append")


def _hour_cut(events: DataFrame):
    """Midpoint of the events' time range, truncated to the hour (a window boundary)."""
    b = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if b["lo"] is None:
        return F.lit(None).cast("timestamp_ntz")
    mid = (b["lo"] + (b["hi"] - b["lo"]) / 2).replace(minute=0, second=0, microsecond=0)
    return F.lit(mid.isoformat(sep=" ")).cast("timestamp_ntz")


def _in_steps(spark: SparkSession, sf_dir: str, name: str, parts, steps: int, keep_all: bool) -> DataFrame:
    """Window counts in update mode over a source that grows by the next of ``parts(cut)`` before each
    of ``steps`` runs of one checkpoint."""
    base = fresh_dir(spark, name)
    inbox, out, ckpt = (os.path.join(base, p) for p in ("inbox", "out", "state"))
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    conditions = parts(_hour_cut(events))
    metrics = None
    for step in range(steps):
        if step < len(conditions):
            events.where(conditions[step]).write.mode("append").parquet(inbox)
        if metrics is None:
            source = sensor_columns(spark.readStream.schema(events.schema).parquet(inbox))
            metrics = _stream_windows(spark, sf_dir, source)
        query = start_materialize(metrics, output_mode="update", out_dir=out, checkpoint=ckpt)
        await_or_stop(query, keep_all=keep_all)
    for scratch in (inbox, ckpt):
        discard(spark, scratch)
    return read_materialized(spark, out, "update", metrics.schema, WINDOW_KEYS)


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode window counts when the later half of the events arrives first.

    The earlier half then lies behind the 48-hour watermark and is dropped as
    late (the feature shown here); what remains are the windows of the later half."""
    ts = F.col("ts")
    return _in_steps(spark, sf_dir, "stream-late", lambda cut: (ts >= cut, ~(ts >= cut) | ts.isNull()), 2,
                     keep_all=False)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts in update mode over a source that grows between three runs of
    one checkpoint: first half of the events, then the rest, then nothing new."""
    ts = F.col("ts")
    return _in_steps(spark, sf_dir, "stream-restart",
                     lambda cut: (ts < cut, ~(ts < cut) | ts.isNull() | cut.isNull()), 3, keep_all=True)


def _stream_timed_alerts(spark: SparkSession, sf_dir: str, source: DataFrame) -> DataFrame:
    return alerts_of(sensor_columns(source), *_dims(spark, sf_dir)).select("ts", "color_name", "speed", "gear", "rpm", "event_id")


def stream_window_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts from mergeable partials: the events come newest first, a file a micro-batch, in two runs."""
    base = fresh_dir(spark, "stream-partials")
    inbox, ckpt = os.path.join(base, "inbox"), os.path.join(base, "state")
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    cut = _hour_cut(events)
    counter = None
    for part in (F.col("ts") >= cut, ~(F.col("ts") >= cut) | F.col("ts").isNull() | cut.isNull()):
        events.where(part).repartitionByRange(3, F.desc("ts")).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        rows = _stream_timed_alerts(spark, sf_dir, source)
        counter = WindowCounter(rows, os.path.join(base, "out"), time_col="ts", compact_every=4)
        await_or_stop(counter.start(rows, ckpt, "available-now"))
    for scratch in (inbox, ckpt):
        discard(spark, scratch)
    return counter.read(spark)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the events first: what lies behind the watermark then is kept apart; counts of both."""
    base = fresh_dir(spark, "stream-late-rows")
    inbox, ckpt = os.path.join(base, "inbox"), os.path.join(base, "state")
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    cut = _hour_cut(events)
    counter = None
    for part in (F.col("ts") >= cut, ~(F.col("ts") >= cut) | F.col("ts").isNull() | cut.isNull()):
        events.where(part).write.mode("append").parquet(inbox)
        rows = _stream_timed_alerts(spark, sf_dir, spark.readStream.schema(events.schema).parquet(inbox))
        counter = WindowCounter(rows, os.path.join(base, "out"), time_col="ts", delay=WATERMARK, late="side")
        await_or_stop(counter.start(rows, ckpt, "available-now"))
    for scratch in (inbox, ckpt):
        discard(spark, scratch)
    late = window_metrics(counter.late_rows(spark), "ts")
    return counter.read(spark).withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


def _raw_topic(spark: SparkSession, sf_dir: str, base: str) -> str:
    topics = os.path.join(base, "topics")
    write_topic(encode(telemetry_events(spark, sf_dir), RAW_FIELDS, key="event_id"), RAW_TOPIC, root=topics)
    return topics


def stream_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-event topic -> window metrics in one streaming query (no intermediate topics)."""
    base = fresh_dir(spark, "stream-fused")
    raw = read_topic(spark, RAW_TOPIC, root=_raw_topic(spark, sf_dir, base))
    metrics = fused_from_records(raw, *_dims(spark, sf_dir), watermark=WATERMARK)
    return _finished(spark, base, metrics, "update", WINDOW_KEYS)


def topic_chain_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three stream jobs chained through file-backed topics, each run to completion."""
    base = fresh_dir(spark, "topic-chain")
    topics = _raw_topic(spark, sf_dir, base)
    await_or_stop(start_enrichment(spark, *_dims(spark, sf_dir), checkpoint=os.path.join(base, "ck-enrich"),
                                   topics_root=topics, trigger="available-now"))
    await_or_stop(start_detection(spark, checkpoint=os.path.join(base, "ck-detect"), topics_root=topics,
                                  trigger="available-now"))
    metrics = counter_frame(spark, topics_root=topics, watermark=WATERMARK)
    return _finished(spark, base, metrics, "complete")


def topic_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chained jobs over hops that deliver at least once: the earlier half of the raw events is sent again between two
    runs of the enrichment, all enriched records between two of the detection; the jobs leave repeats out."""
    base = fresh_dir(spark, "topic-dedup")
    topics, span = os.path.join(base, "topics"), "1 day"
    events = read_table(spark, sf_dir, "events")
    cut = _hour_cut(events)
    early = F.coalesce(F.col("ts") < cut, F.lit(True))
    for part in (early, ~early, early):
        write_topic(encode(sensor_columns(events.where(part)), RAW_FIELDS, key="event_id"), RAW_TOPIC, root=topics)
        await_or_stop(start_enrichment(spark, *_dims(spark, sf_dir), checkpoint=os.path.join(base, "ck-enrich"),
                                       topics_root=topics, trigger="available-now", dedup_within=span))
    again = read_topic(spark, ENRICHED_TOPIC, root=topics, streaming=False)
    for step in range(2):
        if step:
            write_topic(again, ENRICHED_TOPIC, root=topics)
        await_or_stop(start_detection(spark, checkpoint=os.path.join(base, "ck-detect"), topics_root=topics,
                                      trigger="available-now", dedup_within=span))
    return _finished(spark, base, counter_frame(spark, topics_root=topics, watermark=WATERMARK), "complete")


def topic_chain_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts after three hops that keep records in order by car: per car (NULL: events without one), how many
    there are, how many lie behind a later one, and the times of the first and the last by position."""
    base = fresh_dir(spark, "topic-ordered")
    topics = os.path.join(base, "topics")
    events = read_table(spark, sf_dir, "events")
    cut = _hour_cut(events)
    early = F.coalesce(F.col("ts") < cut, F.lit(True))
    for part in (early, ~early):
        raw = encode(sensor_columns(events.where(part)), RAW_FIELDS, key="car_id")
        write_topic(raw, RAW_TOPIC, root=topics)
        await_or_stop(start_enrichment(spark, *_dims(spark, sf_dir), checkpoint=os.path.join(base, "ck-enrich"),
                                       topics_root=topics, trigger="available-now", ordered=True))
        await_or_stop(start_detection(spark, checkpoint=os.path.join(base, "ck-detect"), topics_root=topics,
                                      trigger="available-now", ordered=True))
    alerts = decode(record_positions(spark, ALERT_TOPIC, topics), ENRICHED_EVENT, keep=("batch", "file", "row"))
    timed = alerts.withColumn("ts", utc_of_instant(parse_event_time(F.col("event_time"))))
    return order_breaks(timed, ["car_id"], "ts")


def stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the counters in update and append mode still hold in their state, all input being processed."""
    held = []
    for mode in ("update", "append"):
        base = fresh_dir(spark, f"state-audit-{mode}")
        ckpt = os.path.join(base, "state")
        materialize(_stream_windows(spark, sf_dir), output_mode=mode, out_dir=os.path.join(base, "out"), checkpoint=ckpt,
                    key_cols=WINDOW_KEYS)
        held.append(held_windows(spark, ckpt).withColumn("mode", F.lit(mode)))
    return held[0].unionByName(held[1])


def stream_refreshed_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment over two micro-batches of one checkpoint; the fleet is replaced between them (new drivers)."""
    base = fresh_dir(spark, "refreshed-dims")
    topics, dims, ckpt = (os.path.join(base, x) for x in ("topics", "dims", "ck-enrich"))
    cars, models, colors = _dims(spark, sf_dir)
    for name, df in (("cars", cars), ("car_models", models), ("car_colors", colors)):
        publish_dimension(df, f"{dims}/{name}", 1)
    events = read_table(spark, sf_dir, "events")
    cut = _hour_cut(events)
    early = F.coalesce(F.col("ts") < cut, F.lit(True))
    for step, part in enumerate((early, ~early)):
        if step:
            publish_dimension(cars.withColumn("driver_id", F.col("driver_id") + F.lit(500_000_000)), f"{dims}/cars", 2)
        write_topic(encode(sensor_columns(events.where(part)), RAW_FIELDS, key="event_id"), RAW_TOPIC, root=topics)
        await_or_stop(start_refreshed_enrichment(spark, dims, checkpoint=ckpt, topics_root=topics, trigger="available-now"))
    return decode(read_topic(spark, ENRICHED_TOPIC, root=topics, streaming=False), ENRICHED_EVENT)


def topic_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detection that starts at the latest offset: the earlier half of the events is in its topic by then and is left
    out; the later half comes in two writes, with a restart between them."""
    base = fresh_dir(spark, "topic-latest")
    topics, ckpt = os.path.join(base, "topics"), os.path.join(base, "ck-detect")
    events = read_table(spark, sf_dir, "events")
    cut = _hour_cut(events)
    enriched = to_enriched_record(enrich(sensor_columns(events), *_dims(spark, sf_dir)))
    early = F.coalesce(parse_event_time(F.col("event_time")) < instant_of_utc(cut), F.lit(True))
    odd = F.pmod(F.col("event_id").cast("bigint"), F.lit(2)) == 1
    for part in (early, ~early & odd, ~early & ~odd):
        write_topic(encode(enriched.where(part), ENRICHED_FIELDS), ENRICHED_TOPIC, root=topics)
        await_or_stop(start_detection(spark, checkpoint=ckpt, topics_root=topics, trigger="available-now",
                                      starting_offsets="latest"))
    return decode(read_topic(spark, ALERT_TOPIC, root=topics, streaming=False), ENRICHED_EVENT)


QUERIES: dict[str, Query] = {
    "scan_events": scan_events,
    "scan_dim": scan_dim,
    "dim_roundtrip": dim_roundtrip,
    "literal_dims": literal_dims,
    "expected_gear": expected_gear,
    "enrich_left": enrich_left,
    "join_fanout": join_fanout,
    "enrich_snowflake": enrich_snowflake,
    "enrich_hot_car": enrich_hot_car,
    "json_roundtrip": json_roundtrip,
    "json_encode": json_encode,
    "json_damage": json_damage,
    "json_quarantine": json_quarantine,
    "rule_speed": _rule_query(overspeed()),
    "rule_rpm": _rule_query(high_rpm()),
    "rule_gear": _rule_query(gear_mismatch()),
    "alerts_any": alerts_any,
    "alerts_null_logic": alerts_null_logic,
    "parse_event_time": parse_event_time_q,
    "window_metrics": window_metrics_q,
    "fused_alert_windows": fused_alert_windows,
    "window_hot": window_hot,
    "staged_topic_hops": staged_topic_hops,
    "inject_alert": inject_alert,
    "preview": preview,
    "stream_enrich": stream_enrich,
    "stream_alerts": stream_alerts,
    "stream_window_complete": stream_window_complete,
    "stream_window_update": stream_window_update,
    "stream_window_append": stream_window_append,
    "stream_late_data": stream_late_data,
    "stream_restart": stream_restart,
    "stream_window_partials": stream_window_partials,
    "stream_late_rows": stream_late_rows,
    "stream_fused": stream_fused,
    "topic_chain_stream": topic_chain_stream,
    "topic_from_latest": topic_from_latest,
    "topic_chain_dedup": topic_chain_dedup,
    "topic_chain_ordered": topic_chain_ordered,
    "stream_state_audit": stream_state_audit,
    "stream_refreshed_dims": stream_refreshed_dims,
}
