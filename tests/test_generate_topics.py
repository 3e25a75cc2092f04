import os

import pytest
from pyspark.sql import functions as F

from gearwatch.functions.codec import decode, encode
from gearwatch.schemas import ALERT_EVENT, RAW_EVENT, TOPIC_RECORD
from gearwatch.sources.dims import random_cars, read_dimension, write_dimension
from gearwatch.sources.generate import INJECTED_ALERT, injected_alert, synth_events
from gearwatch.sources.topics import (
    PRODUCER_OPTIONS,
    kafka_sink_options,
    kafka_source_options,
    read_topic,
    write_topic,
)


def test_random_cars_ranges_and_determinism(spark):
    cars = random_cars(spark, 2000, salt=3)
    s = cars.agg(*[f(c) for c in cars.columns for f in (F.min, F.max)]).first()
    assert 1000000 <= s[0] and s[1] <= 9999999 and 100000000 <= s[2] and s[3] <= 999999999
    assert (s[4], s[5], s[6], s[7]) == (1, 7, 1, 7)
    assert cars.collect() == random_cars(spark, 2000, salt=3).collect()
    assert cars.collect() != random_cars(spark, 2000, salt=4).collect()


def test_synth_events(spark):
    fleet = random_cars(spark, 20)
    ev = synth_events(spark.range(5000), fleet)
    assert [f.name for f in ev.schema.fields] == [f.name for f in RAW_EVENT.fields]
    s = ev.agg(F.min("speed"), F.max("speed"), F.min("rpm"), F.max("rpm"), F.min("gear"), F.max("gear"),
               F.countDistinct("event_id"), F.countDistinct("car_id"),
               F.max(F.abs(F.col("speed") * 100 - F.round(F.col("speed") * 100)))).first()
    assert 0 <= s[0] and s[1] <= 180 and 500 <= s[2] and s[3] <= 7000 and (s[4], s[5]) == (1, 6)
    assert s[6] == 5000 and s[7] == fleet.select("car_id").distinct().count() and s[8] < 1e-6
    with pytest.raises(ValueError):
        synth_events(spark.range(3), fleet.limit(0))


def test_injected_alert(spark):
    df = injected_alert(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ALERT_EVENT]
    r = df.first()
    assert (r.car_id, r.speed, r.expected_gear) == (INJECTED_ALERT["car_id"], 150.5, 6)
    assert r.event_time.endswith("+00:00")


def test_dimension_write_read(spark, scratch):
    path = os.path.join(scratch, "cars", "v=1")
    write_dimension(random_cars(spark, 20), path)
    assert read_dimension(spark, path).count() == 20


def test_file_topic_batch_and_stream(spark, scratch):
    rows = [(f"e{i}", "2025-10-17T12:00:00.100000+00:00", i, 50.0, 1000, 2) for i in range(4)]
    raw = spark.createDataFrame(rows, RAW_EVENT)
    fields = [f.name for f in RAW_EVENT.fields]
    write_topic(encode(raw, fields, key="event_id"), "t1", root=scratch)
    back = read_topic(spark, "t1", root=scratch, streaming=False)
    assert back.schema == TOPIC_RECORD
    assert sorted(bytes(r.key).decode() for r in back.collect()) == ["e0", "e1", "e2", "e3"]
    assert sorted(map(tuple, decode(back, RAW_EVENT).collect())) == sorted(map(tuple, raw.collect()))
    stream = read_topic(spark, "t1", root=scratch, streaming=True)
    assert stream.isStreaming
    for wrong in ({"starting_offsets": "newest"}, {"starting_offsets": "latest", "streaming": False}):
        with pytest.raises(ValueError):
            read_topic(spark, "t1", root=scratch, **wrong)


def test_kafka_option_builders():
    assert kafka_source_options("k:9092", "sensors-sample") == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "sensors-sample", "startingOffsets": "earliest"}
    opts = kafka_sink_options("k:9092", "alert-data", PRODUCER_OPTIONS)
    assert opts["topic"] == "alert-data" and opts["kafka.acks"] == "all"


def test_generator_and_injection_jobs(spark, scratch):
    from gearwatch.streaming.jobs import publish_alert, run_generator
    from gearwatch.sources.topics import ALERT_TOPIC, RAW_TOPIC
    run_generator(spark.range(50), random_cars(spark, 20), topics_root=scratch)
    raw = read_topic(spark, RAW_TOPIC, root=scratch, streaming=False)
    assert raw.count() == 50 and raw.where("key IS NULL").count() == 0
    publish_alert(spark, topics_root=scratch)
    alert = decode(read_topic(spark, ALERT_TOPIC, root=scratch, streaming=False), ALERT_EVENT).first()
    assert (alert.brand_name, alert.model_name, alert.speed) == ("Kia", "Rio", 150.5)


def test_synth_events_follow_the_producer_pace(spark):
    import datetime as dt
    ev = synth_events(spark.range(5), random_cars(spark, 3))
    times = sorted(dt.datetime.fromisoformat(r.event_time) for r in ev.collect())
    assert [(b - a).total_seconds() for a, b in zip(times, times[1:])] == [0.5] * 4


def test_jobs_pass_source_options_on(spark, monkeypatch):
    """Kafka itself is not here: its reader must be asked for the right offsets and bounds."""
    from gearwatch.streaming import jobs
    asked = []

    class Reached(Exception):
        pass

    def reader(spark, topic, **options):
        asked.append((topic, options))
        raise Reached

    monkeypatch.setattr(jobs, "read_topic", reader)
    options = {"bootstrap_servers": "k:9092", "starting_offsets": "latest", "max_offsets_per_trigger": 500}
    for start in (jobs.start_enrichment, jobs.start_detection, jobs.start_counter, jobs.start_fused_counter):
        with pytest.raises(Reached):
            start(spark, checkpoint="ck", max_files_per_trigger=None, **options)
    with pytest.raises(Reached):
        jobs.debug_tap(spark, **options)
    assert [t for t, _ in asked] == ["sensors-sample", "samples-enriched", "alert-data", "sensors-sample", "alert-data"]
    assert all(o == {"root": None, **options} for _, o in asked)


def test_cli_passes_source_options_on(spark, monkeypatch):
    from gearwatch import cli
    from gearwatch.streaming import jobs
    seen = {}
    monkeypatch.setattr(jobs, "start_detection", lambda spark, **o: seen.update(o))
    monkeypatch.setattr(cli, "_wait", lambda *a: None)
    cli.main(["detect", "--bootstrap-servers", "k:9092", "--checkpoint", "ck", "--starting-offsets", "latest",
              "--max-offsets-per-trigger", "9"], spark)
    assert (seen["starting_offsets"], seen["max_offsets_per_trigger"], seen["checkpoint"]) == ("latest", 9, "ck")
