"""Repeats after a hop, order by key over hops, damaged messages set apart, and the state that a counter holds."""

import os

import pytest
from pyspark.sql import functions as F

from gearwatch.cli import main
from gearwatch.functions.codec import decode, decode_checked
from gearwatch.operators.delivery import once_within
from gearwatch.operators.windows import window_metrics
from gearwatch.schemas import ENRICHED_EVENT, RAW_EVENT
from gearwatch.sources.dims import car_colors, car_models
from gearwatch.sources.topics import (
    ALERT_TOPIC,
    ENRICHED_TOPIC,
    RAW_TOPIC,
    in_key_order,
    order_breaks,
    read_topic,
    record_positions,
    topic_stream_writer,
    write_topic,
)
from gearwatch.streaming import jobs
from gearwatch.streaming.audit import held_windows, last_batch, state_summary, watermark_ms
from gearwatch.streaming.runner import await_or_stop, materialize

MESSAGES = {  # message -> (event id, damaged)
    '{"event_id":"a","speed":1.5}': ("a", False), "{}": (None, False), '{"event_id":null,"other":[1]}': (None, False),
    '{bad{"event_id":"b"}': (None, True), "null": (None, True), '[{"event_id":"c"}]': (None, True), "3": (None, True),
    "": (None, True), "  ": (None, True), '{"event_id":"d","speed":"fast"}': ("d", True),
    '{"event_id":"e","car_id":99999999999}': ("e", True),
}


def send(spark, texts, topics, topic=RAW_TOPIC):
    write_topic(spark.createDataFrame([(t,) for t in texts], "value string"), topic, root=topics)


def event(name, time="2024-01-01T00:00:00.000000+00:00", car=1):
    car = "" if car is None else f'"car_id":{car},'
    name = "" if name is None else f'"event_id":"{name}",'
    return f'{{{name}{car}"event_time":"{time}","speed":130.0,"rpm":1,"gear":1}}'


def fleet(spark):
    return spark.createDataFrame([(1, 10, 1, 1)], "car_id long, driver_id long, model_id long, color_id long")


def test_damaged_messages_are_told_with_their_text(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*MESSAGES, None])], "value_no int, value string")
    found = {r.value_no: r for r in decode_checked(rows, RAW_EVENT, keep=("value_no",)).collect()}
    for i, (text, (event_id, damaged)) in enumerate(MESSAGES.items()):
        assert (found[i].event_id, found[i].damaged, found[i].text) == (event_id, damaged, text if damaged else None), text
    assert found[len(MESSAGES)].damaged and found[len(MESSAGES)].text is None
    plain = decode(rows, RAW_EVENT, keep=("value_no",)).orderBy("value_no").collect()
    checked = decode_checked(rows, RAW_EVENT, keep=("value_no",)).drop("damaged", "text").orderBy("value_no").collect()
    assert plain == checked
    assert decode_checked(rows.limit(0), RAW_EVENT).count() == 0


def test_a_schema_may_use_the_name_of_the_corrupt_column(spark):
    rows = spark.createDataFrame([('{"_corrupt":"x"}',), ("[",)], "value string")
    schema = spark.createDataFrame([], "_corrupt string, _corrupt_record int").schema
    found = decode_checked(rows, schema).collect()
    assert [(r._corrupt, r.damaged) for r in found] == [("x", False), (None, True)]


def test_one_parse_tells_and_decodes(spark):
    plan = decode_checked(spark.createDataFrame([("{}",)], "value string"), RAW_EVENT).where("damaged and speed > 1") \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_quarantine_keeps_every_message_once(spark, scratch, monkeypatch):
    topics = os.path.join(scratch, "t")
    send(spark, MESSAGES, topics)
    real, calls = jobs.topic_batch_writer, []

    def dying(topic, *args, **options):
        write = real(topic, *args, **options)

        def once(batch, batch_id):
            if topic == "good" and not calls:
                calls.append(1)
                raise RuntimeError("the driver dies")
            write(batch, batch_id)
        return once

    def run():
        await_or_stop(jobs.start_quarantine(spark, checkpoint=f"{scratch}/ck", topics_root=topics, sink="good",
                                            bad_sink="bad", trigger="available-now"), 120)

    monkeypatch.setattr(jobs, "topic_batch_writer", dying)
    with pytest.raises(Exception, match="driver dies"):  # the damaged ones are published by then
        run()
    run()
    send(spark, ["[", event("z")], topics)
    run()

    def texts(topic):
        return sorted(bytes(r.value).decode() for r in read_topic(spark, topic, root=topics, streaming=False).collect())

    assert texts("bad") == sorted([t for t, (_, damaged) in MESSAGES.items() if damaged] + ["["])
    assert texts("good") == sorted([t for t, (_, damaged) in MESSAGES.items() if not damaged] + [event("z")])


def test_repeats_go_over_batches_and_rows_without_an_id_stay(spark, scratch):
    topics = os.path.join(scratch, "t")

    def run(**options):
        await_or_stop(jobs.start_enrichment(spark, fleet(spark), car_models(spark), car_colors(spark), topics_root=topics,
                                            trigger="available-now", **options), 120)

    def ids(topic):
        records = decode(read_topic(spark, topic, root=topics, streaming=False), ENRICHED_EVENT)
        return sorted(r.event_id or "-" for r in records.collect())

    for texts in ([event("a"), event("a"), event("b"), event(None), event(None), "["],
                  [event("b"), event("c"), event(None)], [event("a"), event("c")]):
        send(spark, texts, topics)
        run(checkpoint=f"{scratch}/ck", dedup_within="1 day")
    assert ids(ENRICHED_TOPIC) == ["-", "-", "-", "-", "a", "b", "c"]
    run(checkpoint=f"{scratch}/ck2", sink="plain", producer="plain")
    assert len(ids("plain")) == 11


def test_once_within_on_a_batch(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("a", None, None), ("a", None, None), (None, 1, None)],
                                 "k string, n int, at timestamp")
    assert once_within(rows, ["k", "n"], "at", "1 hour").count() == 4
    assert once_within(rows.limit(0), ["k"], "at", "1 hour").count() == 0


def test_dedup_in_the_counter(spark, scratch):
    topics = os.path.join(scratch, "t")
    for texts in ([event("a"), event("b")], [event("a"), event("c")]):
        send(spark, texts, topics, ALERT_TOPIC)
        counter, query = jobs.start_partial_counter(spark, out_dir=f"{scratch}/out", checkpoint=f"{scratch}/ck",
                                                    trigger="available-now", topics_root=topics, dedup_within="1 day")
        await_or_stop(query, 120)
    assert [r.num_of_rows for r in counter.read(spark).collect()] == [3]


def test_order_by_car_holds_over_hops(spark, scratch):
    topics = os.path.join(scratch, "t")
    for hour in (1, 2):  # a third of all and more on car 1, some without a car; shuffled by hash
        rows = spark.range(600).select(F.concat(
            F.lit('{"event_id":"'), F.col("id"), F.lit(f'","event_time":"2024-01-01T0{hour}:'),
            F.lpad((F.col("id") * 7 % 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.col("id") % 59).cast("string"), 2, "0"),
            F.lit('.000000+00:00","car_id":'),
            F.when(F.col("id") % 2 == 0, "1").when(F.col("id") % 7 == 0, "null").otherwise((F.col("id") % 5).cast("string")),
            F.lit(',"speed":130.0,"rpm":1,"gear":1}')).alias("value"))
        write_topic(rows.orderBy(F.xxhash64("value")), RAW_TOPIC, root=topics)
        main(["enrich", "--dims", _dims(spark, scratch), "--topics", topics, "--available-now", "--ordered"], spark=spark)
        main(["detect", "--topics", topics, "--available-now", "--ordered"], spark=spark)

    def breaks(topic):
        placed = decode(record_positions(spark, topic, topics), ENRICHED_EVENT, keep=("batch", "file", "row"))
        return {r.car_id: r for r in order_breaks(placed, ["car_id"], "event_time").collect()}

    found = breaks(ALERT_TOPIC)
    assert sum(r.n_records for r in found.values()) == 1200 and None in found
    assert all(r.n_breaks == 0 and r["first"] < "2024-01-01T02" <= r["last"] for r in found.values())
    assert sum(r.n_breaks for r in breaks(RAW_TOPIC).values()) > 100
    keys = read_topic(spark, ALERT_TOPIC, root=topics, streaming=False)
    assert keys.where(~F.col("key").cast("string").eqNullSafe(F.get_json_object(F.col("value").cast("string"), "$.car_id"))).count() == 0


def _dims(spark, scratch):
    root = os.path.join(scratch, "dims")
    if not os.path.exists(root):
        main(["dims", "--out", root], spark=spark)
    return root


def test_a_hot_key_is_split_in_order(spark, scratch):
    rows = spark.range(50_000).select(F.lit(b"1").alias("key"), F.lit(b"v").alias("value"), (F.col("id") * 7919 % 50_000).alias("at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in in_key_order(rows, ["at"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 50_000 and max(sizes) < 15_000
    placed = spark.createDataFrame([("b0", "f0", 0, "k", 1), ("b0", "f0", 1, "k", 3), ("b0", "f1", 0, "k", 2), ("b1", "f0", 0, "k", 2),
                                    ("b1", "f0", 1, "k", 1), ("b1", "f0", 2, "j", 0), ("b1", "f0", 3, "j", None)],
                                   "batch string, file string, row long, car string, at int")
    found = {r.car: tuple(r)[1:] for r in order_breaks(placed, ["car"], "at").collect()}
    assert found == {"k": (5, 2, 1, 1), "j": (1, 0, 0, 0)}


def test_order_needs_a_key(spark, scratch):
    with pytest.raises(ValueError, match="key"):
        topic_stream_writer(spark.createDataFrame([], "value string, at int"), "x", "ck", root=scratch, order_by=("at",))


@pytest.mark.parametrize("mode", ["update", "append"])
def test_windows_held_are_those_above_the_watermark(spark, scratch, mode):
    inbox, ck = f"{scratch}/in", f"{scratch}/ck"
    assert held_windows(spark, ck).count() == 0 and last_batch(spark, ck) == -1
    rows = spark.range(0, 600).select(  # 10 hours, a row a minute
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("at"), F.lit("Black").alias("color_name"),
        F.lit(1.0).alias("speed"), F.lit(1).alias("gear"), F.lit(1).alias("rpm"))
    for part in ("id < 300", "id >= 300"):
        rows.withColumn("id", (F.unix_seconds("at") - 1_704_067_200) / 60).where(part).drop("id").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        materialize(window_metrics(stream, "at", watermark="2 hours"), output_mode=mode, out_dir=f"{scratch}/out", checkpoint=ck,
                    key_cols=("window_start", "window_end"))
        newest = rows.where(f"unix_seconds(at) < {1_704_067_200 + 60 * (300 if part == 'id < 300' else 600)}").agg(F.max("at")).first()[0]
        assert watermark_ms(spark, ck) == int(newest.timestamp() - 7200) * 1000
        held = held_windows(spark, ck)
        want = (newest.timestamp() - 7200)
        assert held.where("behind").count() == 0
        ends = [r.s for r in held.select(F.unix_seconds(F.col("window_end").cast("timestamp")).alias("s")).collect()]
        assert sorted(ends) == [e for e in range(1_704_067_200 + 900, int(newest.timestamp()) + 901, 900) if e > want]
    summary = state_summary(spark, ck).first()
    assert (summary.n_held, summary.n_behind, summary.batch_id) == (len(ends), 0, last_batch(spark, ck))
    main(["audit", "--checkpoint", ck], spark=spark)
