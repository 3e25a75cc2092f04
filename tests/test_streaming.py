import datetime as dt
import json
import os
import time

import pytest


from gearwatch.functions.bands import classify_bands
from gearwatch.plans.chain import counting_stage
from gearwatch.schemas import RAW_EVENT
from gearwatch.streaming.runner import await_or_stop, read_materialized, start_materialize

from tests.conftest import SF0001

# one alert per file, processed one file per micro-batch (FIXTURES.md section 3)
LATE_BATCHES = ["2025-10-17T12:00:00.100000+00:00", "2025-10-20T12:00:00.100000+00:00",
                "2025-10-20T12:01:00.100000+00:00", "2025-10-17T12:02:00.100000+00:00",
                "2025-10-20T12:03:00.100000+00:00"]
W1017, W1020 = dt.datetime(2025, 10, 17, 12, 0), dt.datetime(2025, 10, 20, 12, 0)


def _alert_files(folder):
    os.makedirs(folder)
    base = time.time() - 1000
    for i, t in enumerate(LATE_BATCHES):
        p = os.path.join(folder, f"b{i}.json")
        with open(p, "w") as f:
            f.write(json.dumps({"event_id": f"a{i}", "event_time": t, "color_name": "Black",
                                "speed": 130.0, "rpm": 3000, "gear": 4, "expected_gear": 5}) + "\n")
        os.utime(p, (base + i * 10, base + i * 10))


@pytest.mark.parametrize("mode,expected,dropped", [
    ("complete", {W1017: 2, W1020: 3}, 0),
    ("update", {W1017: 1, W1020: 3}, 1),
    ("append", {W1017: 1}, 1),
])
def test_late_data_by_output_mode(spark, scratch, mode, expected, dropped):
    src = os.path.join(scratch, "alerts")
    _alert_files(src)
    records = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
    metrics = counting_stage(records, watermark="48 hours")
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    q = start_materialize(metrics, output_mode=mode, out_dir=out, checkpoint=ck)
    assert await_or_stop(q, 300)
    got = read_materialized(spark, out, mode, metrics.schema, ("window_start", "window_end"))
    assert {r.window_start: r.num_of_rows for r in got.collect()} == expected
    assert {r.window_start: r.num_of_black for r in got.collect()} == expected
    drops = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                for p in q.recentProgress if p.get("stateOperators"))
    assert drops == dropped


def test_restart_on_same_checkpoint(spark, scratch):
    src, out, ck = (os.path.join(scratch, p) for p in ("in", "out", "ck"))
    rows = [(f"e{i}", None, i, 10.0 * i, 1000, 1) for i in range(6)]
    spark.createDataFrame(rows[:5], RAW_EVENT).coalesce(1).write.parquet(src)
    stream = classify_bands(spark.readStream.schema(RAW_EVENT).parquet(src))
    counts = []
    for step in range(3):
        if step == 1:
            spark.createDataFrame(rows[5:], RAW_EVENT).write.mode("append").parquet(src)
        q = start_materialize(stream, output_mode="append", out_dir=out, checkpoint=ck)
        assert await_or_stop(q, 300)
        counts.append(spark.read.parquet(out).count())
    assert counts == [5, 6, 6]
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [f"e{i}" for i in range(6)]


def test_stream_equals_batch(spark):
    from gearwatch.plans.catalog import QUERIES
    bag = lambda df: sorted(tuple(r) for r in df.collect())
    assert bag(QUERIES["stream_window_complete"](spark, SF0001)) == \
        bag(QUERIES["fused_alert_windows"](spark, SF0001))
    assert bag(QUERIES["stream_alerts"](spark, SF0001).select("event_id")) == \
        bag(QUERIES["alerts_any"](spark, SF0001).select("event_id"))


def test_timeout_stops_a_running_query(spark, scratch):
    from gearwatch.streaming.runner import start_sink
    q = start_sink(spark.readStream.format("rate").load(), sink="memory", query_name="gw_rate_probe",
                   trigger="1 second")
    assert await_or_stop(q, 2) is False
    assert not q.isActive


def test_stream_table_reads_folder_and_single_file_tables(spark, scratch):
    from gearwatch.plans.catalog import stream_table
    spark.read.parquet(os.path.join(SF0001, "events.parquet")).repartition(3) \
        .write.parquet(os.path.join(scratch, "events.parquet"))  # a table stored as a folder
    for sf in (scratch, SF0001):
        out = os.path.join(scratch, "out-" + os.path.basename(sf))
        q = start_materialize(stream_table(spark, sf, "events"), output_mode="append",
                              out_dir=out, checkpoint=out + "-ck")
        assert await_or_stop(q, 300)
        assert spark.read.parquet(out).count() == 1000


def test_retried_batch_replaces_its_output(spark, scratch):
    """A batch that wrote its rows and then failed is re-run on restart without duplicates."""
    from gearwatch.streaming import runner
    src = os.path.join(scratch, "alerts")
    _alert_files(src)
    metrics = counting_stage(spark.readStream.text(src), watermark="48 hours")
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    write = runner._batch_writer(out)

    def write_then_fail(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost before commit")

    q = metrics.writeStream.outputMode("update").foreachBatch(write_then_fail) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        q.awaitTermination(120)
    assert spark.read.parquet(out).count() > 0  # the failed batch left its rows behind
    q = start_materialize(metrics, output_mode="update", out_dir=out, checkpoint=ck)
    assert await_or_stop(q, 300)
    assert spark.read.parquet(out).groupBy("batch_id", "window_start").count() \
        .where("count > 1").count() == 0
    got = read_materialized(spark, out, "update", metrics.schema, ("window_start", "window_end"))
    assert {r.window_start: r.num_of_rows for r in got.collect()} == {W1017: 2, W1020: 3}


def test_debug_tap_runs_bounded(spark, scratch):

    from gearwatch.streaming.jobs import debug_tap, publish_alert
    publish_alert(spark, topics_root=scratch)
    t0 = time.time()
    debug_tap(spark, topics_root=scratch, seconds=3)
    assert time.time() - t0 < 60
    assert not [q for q in spark.streams.active if q.name is None and q.isActive]


def test_fused_stream_equals_staged_chain(spark, scratch):
    from gearwatch.plans.catalog import QUERIES, RAW_FIELDS
    from gearwatch.functions.codec import encode
    from gearwatch.plans.chain import fused_from_records
    from gearwatch.sources.dims import car_colors, car_models
    from gearwatch.sources.testdata import telemetry_cars, telemetry_events
    from gearwatch.sources.topics import RAW_TOPIC, read_topic, write_topic
    topics = os.path.join(scratch, "topics")
    write_topic(encode(telemetry_events(spark, SF0001), RAW_FIELDS, key="event_id"), RAW_TOPIC, root=topics)
    metrics = fused_from_records(read_topic(spark, RAW_TOPIC, root=topics),
                                 telemetry_cars(spark, SF0001), car_models(spark), car_colors(spark),
                                 watermark="48 hours")
    out = os.path.join(scratch, "out")
    q = start_materialize(metrics, output_mode="complete", out_dir=out, checkpoint=out + "-ck")
    assert await_or_stop(q, 300)
    got = read_materialized(spark, out, "complete", metrics.schema)
    want = QUERIES["topic_chain_stream"](spark, SF0001)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_complete_mode_keeps_two_results(spark, scratch):
    src = os.path.join(scratch, "alerts")
    _alert_files(src)
    metrics = counting_stage(spark.readStream.option("maxFilesPerTrigger", 1).text(src))
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    q = start_materialize(metrics, output_mode="complete", out_dir=out, checkpoint=ck)
    assert await_or_stop(q, 300)
    stored = spark.read.parquet(out)
    assert stored.select("batch_id").distinct().count() == 2  # five batches ran, two are kept
    got = read_materialized(spark, out, "complete", metrics.schema)
    assert {r.window_start: r.num_of_rows for r in got.collect()} == {W1017: 2, W1020: 3}


def test_table_stream_backfill_advances_in_bounded_batches(spark, scratch):
    from gearwatch.plans.catalog import stream_table
    spark.read.parquet(os.path.join(SF0001, "events.parquet")).repartition(3) \
        .write.parquet(os.path.join(scratch, "events.parquet"))
    out = os.path.join(scratch, "out")
    q = start_materialize(stream_table(spark, scratch, "events", max_files_per_trigger=1),
                          output_mode="append", out_dir=out, checkpoint=out + "-ck")
    assert await_or_stop(q, 300)
    data_batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(data_batches) == 3 and sum(p["numInputRows"] for p in data_batches) == 1000
    assert spark.read.parquet(out).count() == 1000
