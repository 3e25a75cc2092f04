"""Backlogs in several micro-batches, topics with several writers, restarts, sinks and triggers."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from gearwatch.cli import main
from gearwatch.functions.codec import encode
from gearwatch.operators.enrich import to_enriched_record
from gearwatch.plans import catalog
from gearwatch.plans.chain import ENRICHED_FIELDS
from gearwatch.schemas import ENRICHED_EVENT, RAW_EVENT
from gearwatch.sources.topics import ALERT_TOPIC, ENRICHED_TOPIC, RAW_TOPIC, read_topic, topic_stream_writer, write_topic
from gearwatch.streaming import jobs
from gearwatch.streaming.runner import LateRowsDropped, await_or_stop, materialize, start_sink

from tests.conftest import SF0001


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """The sf0.001 tables, events dealt at random to five files."""
    sf = str(tmp_path_factory.mktemp("sf"))
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    events.repartition(5, F.xxhash64("event_id")).write.parquet(f"{sf}/events.parquet")
    spark.read.parquet(f"{SF0001}/customer.parquet").write.parquet(f"{sf}/customer.parquet")
    return sf


def _windows(df):
    return tuple(df.agg(F.count("*"), F.sum("num_of_rows")).first())


@pytest.mark.parametrize("name, expected", [
    ("stream_window_update", (752, 865)), ("stream_window_complete", (752, 865)),
    ("stream_window_append", (702, 810)), ("stream_restart", (752, 865)), ("topic_chain_stream", (752, 865))])
def test_shuffled_files_lose_nothing(spark, many_files, name, expected):
    assert _windows(catalog.QUERIES[name](spark, many_files)) == expected


def test_one_file_a_batch_needs_a_long_watermark(spark, many_files, scratch):
    source = catalog._stream_events(spark, many_files, max_files_per_trigger=1)

    def run(name, watermark):
        return materialize(catalog._stream_windows(spark, many_files, source, watermark), output_mode="update",
                           out_dir=f"{scratch}/{name}", checkpoint=f"{scratch}/{name}-ck", key_cols=catalog.WINDOW_KEYS)

    assert _windows(run("long", "40 days")) == (752, 865)
    with pytest.raises(LateRowsDropped, match=r"\d+ rows lay behind the watermark"):
        run("short", "48 hours")


def test_published_alert_reaches_the_counter(spark, scratch):
    topics = f"{scratch}/topics"
    enriched = encode(to_enriched_record(catalog._enriched(spark, SF0001)), ENRICHED_FIELDS)
    write_topic(enriched, ENRICHED_TOPIC, root=topics)
    detect = {"checkpoint": f"{scratch}/ck", "topics_root": topics, "trigger": "available-now"}
    await_or_stop(jobs.start_detection(spark, **detect), 300)
    alerts = lambda: read_topic(spark, ALERT_TOPIC, root=topics, streaming=False).count()
    assert alerts() == 865
    jobs.publish_alert(spark, topics_root=topics, event_time=catalog.INJECT_AT)
    assert alerts() == 866
    await_or_stop(jobs.start_detection(spark, **detect), 300)  # goes on: nothing new, nothing twice
    assert alerts() == 866
    metrics = jobs.counter_frame(spark, topics_root=topics)
    counted = materialize(metrics, output_mode="complete", out_dir=f"{scratch}/out", checkpoint=f"{scratch}/ck-count")
    assert counted.agg(F.sum("num_of_rows")).first()[0] == 866


def _raw(spark, first, n):
    return encode(spark.createDataFrame([(f"e{i}", "2025-10-17T12:00:00.100000+00:00", i, 130.0, 1000, 2)
                                         for i in range(first, first + n)], RAW_EVENT),
                  [f.name for f in RAW_EVENT.fields], key="event_id")


def test_two_streams_and_a_batch_feed_one_topic(spark, scratch):
    for part in ("a", "b"):
        write_topic(_raw(spark, 0, 30), part, root=scratch)
        source = read_topic(spark, part, root=scratch)
        q = topic_stream_writer(source, "both", f"{scratch}/ck-{part}", producer=part, root=scratch).trigger(availableNow=True).start()
        assert await_or_stop(q, 300)
    write_topic(_raw(spark, 0, 5), "both", root=scratch)
    assert read_topic(spark, "both", root=scratch, streaming=False).count() == 65
    with pytest.raises(ValueError, match="written with the checkpoint"):
        topic_stream_writer(read_topic(spark, "a", root=scratch), "both", f"{scratch}/other", producer="a", root=scratch)


def test_a_committed_batch_is_not_written_again(spark, scratch):
    """A batch whose records are there, but whose commit was lost with the driver, runs again."""
    write_topic(_raw(spark, 0, 30), RAW_TOPIC, root=scratch)
    source = read_topic(spark, RAW_TOPIC, root=scratch)
    ck = f"{scratch}/ck"
    run = lambda: topic_stream_writer(source, "t", ck, root=scratch).trigger(availableNow=True).start()
    assert await_or_stop(run(), 300)
    for name in os.listdir(f"{ck}/commits"):
        os.remove(f"{ck}/commits/{name}")
    assert await_or_stop(run(), 300)
    assert read_topic(spark, "t", root=scratch, streaming=False).count() == 30


def test_cli_restart_keeps_every_event(spark, scratch):
    dims, topics = f"{scratch}/dims", f"{scratch}/topics"
    assert main(["dims", "--out", dims, "--cars", "20"], spark) == 0
    enriched = []
    for first, n in ((0, 100), (100, 50)):
        write_topic(_raw(spark, first, n), RAW_TOPIC, root=topics)
        assert main(["enrich", "--dims", dims, "--topics", topics, "--available-now"], spark) == 0
        records = read_topic(spark, ENRICHED_TOPIC, root=topics, streaming=False)
        enriched.append((records.count(), records.select("value").distinct().count()))
    assert enriched == [(100, 100), (150, 150)]
    with pytest.raises(ValueError, match="written with the checkpoint"):
        main(["enrich", "--dims", dims, "--topics", topics, "--available-now", "--checkpoint", f"{scratch}/new"], spark)


def test_cli_backlog_fails_rather_than_lose_rows(spark, many_files, scratch):
    topics = f"{scratch}/topics"
    alerts = encode(to_enriched_record(catalog._alerts(spark, SF0001)), ENRICHED_FIELDS)
    write_topic(alerts.repartition(4, F.xxhash64("value")), ALERT_TOPIC, root=topics)
    job = ["count", "--topics", topics, "--available-now", "--max-files-per-trigger", "1", "--mode", "update"]
    with pytest.raises(LateRowsDropped):
        main([*job, "--checkpoint", f"{scratch}/a"], spark)
    assert main([*job, "--checkpoint", f"{scratch}/b", "--watermark", "40 days"], spark) == 0
    assert main([*job, "--checkpoint", f"{scratch}/c", "--allow-late-drops"], spark) == 0


def _alert_topic(spark, root):
    row = ("a", "2025-10-17T12:00:00.100000+00:00", 1, 2, "Kia", "Rio", "Black", 130.0, 3000, 4, 5)
    write_topic(encode(spark.createDataFrame([row] * 7, ENRICHED_EVENT), ENRICHED_FIELDS), ALERT_TOPIC, root=root)


def test_tap_shows_alerts_with_their_time(spark, scratch):
    _alert_topic(spark, scratch)
    jobs.debug_tap(spark, topics_root=scratch, seconds=8, sink="memory", query_name="gw_tap")
    rows = spark.table("gw_tap").collect()
    assert len(rows) == 7 and rows[0].asDict().keys() == set(jobs.TAP_COLUMNS)
    assert rows[0].event_time_ts.isoformat() == "2025-10-17T12:00:00.100000" and rows[0].color_name == "Black"


def test_console_sinks(spark, scratch):
    _alert_topic(spark, scratch)
    code = ("from gearwatch.cli import main\n"
            f"main(['tap', '--topics', {scratch!r}, '--seconds', '15'])\n"
            f"main(['count', '--topics', {scratch!r}, '--available-now'])\n"
            f"main(['schema', '--topics', {scratch!r}])\n")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=here, capture_output=True, text=True, timeout=300).stdout
    assert "only showing top 5 rows" in out  # the tap
    assert "|2025-10-17 12:00:00|2025-10-17 12:15:00|7          |7           |" in out  # complete counter
    assert "|-- value: binary" in out and "|-- expected_gear: integer" in out


@pytest.mark.parametrize("trigger", ["1 second", None])
def test_triggers_keep_running(spark, scratch, trigger):
    """Processing-time and immediate triggers take what comes while they run."""
    _alert_topic(spark, scratch)
    name = f"gw_trigger_{trigger is None}"
    q = start_sink(jobs.counter_frame(spark, topics_root=scratch), sink="memory", output_mode="complete",
                   query_name=name, trigger=trigger, checkpoint=f"{scratch}/ck-{name}")
    try:
        for total in (7, 14):
            deadline = time.time() + 60
            while not (spark.table(name).agg(F.sum("num_of_rows")).first()[0] or 0) == total and time.time() < deadline:
                time.sleep(0.5)
            assert spark.table(name).agg(F.sum("num_of_rows")).first()[0] == total and q.isActive
            if total == 7:
                _alert_topic(spark, scratch)
    finally:
        q.stop()


def test_scratch_copies_are_given_up(spark):
    from gearwatch.session import shared_root
    root = shared_root(spark).removeprefix("file:") + "/gearwatch"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    for name in ("stream_restart", "stream_fused", "topic_chain_stream", "inject_alert"):
        catalog.QUERIES[name](spark, SF0001)
    for folder in set(os.listdir(root)) - before:
        assert os.listdir(f"{root}/{folder}") == ["out"]
