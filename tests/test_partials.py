"""Counters that fold partial results: any order of files, late rows, restarts, compaction."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from gearwatch.operators.windows import window_metrics
from gearwatch.plans.catalog import _stream_timed_alerts, fused_alert_windows
from gearwatch.session import children
from gearwatch.sources.testdata import read_table
from gearwatch.streaming.partials import WindowCounter
from gearwatch.streaming.runner import LateRowsDropped, await_or_stop, late_mark, materialize
from gearwatch.streaming.tables import FoldedTable, newest_of, summed_of
from tests.conftest import SF0001

DAY = "86400 seconds"


def newest_first(spark, folder):
    """The events in four files, newest first; returns a function that opens them as a stream."""
    events = read_table(spark, SF0001, "events").select("event_id", "ts", "user_id", "value", "props")
    bounds = [r.q for r in events.selectExpr("explode(percentile_approx(unix_micros(cast(ts as timestamp)), array(0.25, 0.5, 0.75))) q").collect()]
    part = sum((F.unix_micros(F.col("ts").cast("timestamp")) >= b).cast("int") for b in bounds)
    for k in (3, 2, 1, 0):
        events.where(part == k).coalesce(1).write.parquet(out := os.path.join(folder, f"part={3 - k}"))
        stamp = 1_700_000_000 + 10 * (3 - k)
        for name in os.listdir(out):
            os.utime(os.path.join(out, name), (stamp, stamp))

    def stream():
        source = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", "true").parquet(folder))
        return _stream_timed_alerts(spark, SF0001, source)

    return stream


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def counter_of(stream, scratch, **options):
    return WindowCounter(stream(), os.path.join(scratch, "out"), time_col="ts", **options)


def run(counter, stream, scratch):
    await_or_stop(counter.start(stream(), os.path.join(scratch, "ck"), "available-now"), 300)


def test_any_order_of_files_counts_every_row(spark, scratch):
    stream = newest_first(spark, os.path.join(scratch, "in"))
    counter = counter_of(stream, scratch, compact_every=3)
    run(counter, stream, scratch)
    expected = rows_of(fused_alert_windows(spark, SF0001))
    assert len(expected) == 752 and rows_of(counter.read(spark)) == expected
    run(counter, stream, scratch)  # nothing new
    assert rows_of(counter.read(spark)) == expected


def test_guard_fails_every_run_until_the_delay_is_mended(spark, scratch):
    stream = newest_first(spark, os.path.join(scratch, "in"))
    for _ in range(3):
        counter = counter_of(stream, scratch, delay="48 hours", late="raise")
        with pytest.raises(Exception, match="behind the watermark"):
            run(counter, stream, scratch)
        assert counter.read(spark).agg(F.sum("num_of_rows")).first()[0] < 865
    counter = counter_of(stream, scratch, delay="60 days", late="raise")
    run(counter, stream, scratch)
    found = counter.read(spark)
    assert (found.count(), found.agg(F.sum("num_of_rows")).first()[0]) == (752, 865)
    assert rows_of(found) == rows_of(fused_alert_windows(spark, SF0001))


def test_late_rows_are_kept_apart_whole(spark, scratch):
    stream = newest_first(spark, os.path.join(scratch, "in"))
    counter = counter_of(stream, scratch, delay="48 hours", late="side")
    assert counter.late_rows(spark).count() == 0
    run(counter, stream, scratch)
    late = counter.late_rows(spark)
    counted = counter.read(spark).agg(F.sum("num_of_rows")).first()[0]
    assert 0 < late.count() and counted + late.count() == 865
    both = counter.read(spark).unionByName(window_metrics(late, "ts"))
    totals = both.groupBy("window_start").agg(F.sum("num_of_rows").alias("n"))
    assert rows_of(totals) == rows_of(fused_alert_windows(spark, SF0001).select("window_start", F.col("num_of_rows").alias("n")))


def test_a_batch_that_runs_again_replaces_itself(spark, scratch):
    stream = newest_first(spark, os.path.join(scratch, "in"))
    counter = counter_of(stream, scratch, compact_every=2)
    real, failed = counter.table, []

    def failing(session):
        if len(failed) < 3 and failed.append(1) is None and len(failed) == 3:
            raise RuntimeError("the driver dies")
        return real(session)

    counter.table = failing
    with pytest.raises(Exception, match="driver dies"):
        run(counter, stream, scratch)
    counter.table = real
    run(counter, stream, scratch)
    assert rows_of(counter.read(spark)) == rows_of(fused_alert_windows(spark, SF0001))
    table = real(spark)
    table.write(counter.read(spark).withColumn("newest", F.lit(None).cast("timestamp_ntz")), table.pointer())  # folded: no effect
    assert rows_of(counter.read(spark)) == rows_of(fused_alert_windows(spark, SF0001))


def test_lossy_run_of_a_stateful_counter_fails_ever_after(spark, scratch):
    stream = newest_first(spark, os.path.join(scratch, "in"))
    out, ck = os.path.join(scratch, "update"), os.path.join(scratch, "ck-update")
    for _ in range(3):
        with pytest.raises(LateRowsDropped):
            materialize(window_metrics(stream(), "ts", watermark="48 hours"), output_mode="update", out_dir=out,
                        checkpoint=ck, key_cols=("window_start", "window_end"))
    assert os.path.exists(late_mark(ck))
    whole = materialize(window_metrics(stream(), "ts", watermark="60 days"), output_mode="update",
                        out_dir=out + "2", checkpoint=ck + "2", key_cols=("window_start", "window_end"))
    assert (whole.count(), whole.agg(F.sum("num_of_rows")).first()[0]) == (752, 865)


def test_empty_source_and_unknown_mode(spark, scratch):
    schema = "ts timestamp_ntz, color_name string, speed double, gear int, rpm int"
    os.makedirs(os.path.join(scratch, "in"))
    rows = spark.readStream.schema(schema).parquet(os.path.join(scratch, "in"))
    counter = WindowCounter(rows, os.path.join(scratch, "out"), time_col="ts", late="raise")
    await_or_stop(counter.start(rows, os.path.join(scratch, "ck"), "available-now"), 120)
    assert counter.read(spark).collect() == [] and counter.table(spark).compact() == -1
    with pytest.raises(ValueError):
        WindowCounter(rows, scratch, time_col="ts", late="lose")


@pytest.mark.parametrize("kind", ["newest", "summed"])
def test_table_stays_at_two_results_while_a_reader_runs(spark, scratch, kind):
    schema = spark.createDataFrame([], "k int, n bigint").schema
    fold = newest_of(["k"], ["n"]) if kind == "newest" else summed_of(["k"], ["n"], [])
    table = FoldedTable(spark, os.path.join(scratch, "t"), schema, fold)
    wrong, stop = [], threading.Event()

    def reader():
        last = -1
        while not stop.is_set():
            found = {r.k: r.n for r in table.read().collect()}
            whole = max(found.values(), default=-1)
            # every batch n gives key 0 the value n (newest) or 1 (summed): never less than was seen before
            if found.get(0, -1) < last or whole != found.get(0, -1):
                wrong.append(found)
            last = found.get(0, -1)

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for n in range(20):
            table.write(spark.createDataFrame([(0, n if kind == "newest" else 1), (1, 0)], schema), n)
            if n % 4 == 3:
                table.compact()
                assert len(children(spark, f"{table.path}/base")) <= 2 and len(children(spark, f"{table.path}/delta")) <= 8
                assert len(children(spark, f"{table.path}/_pointers")) <= 2
    finally:
        stop.set()
        thread.join()
    assert not wrong
    assert rows_of(table.read()) == [(0, 19 if kind == "newest" else 20), (1, 0)]


def test_compaction_that_died_is_done_again(spark, scratch):
    schema = spark.createDataFrame([], "k int, n bigint").schema
    table = FoldedTable(spark, os.path.join(scratch, "t"), schema, summed_of(["k"], ["n"], []))
    for n in range(3):
        table.write(spark.createDataFrame([(0, 1)], schema), n)
    spark.createDataFrame([(0, 99, 2)], table.schema).write.parquet(f"{table.path}/base/2")  # no pointer: half done
    assert rows_of(table.read()) == [(0, 3)]
    assert table.compact() == 2 and rows_of(table.read()) == [(0, 3)] and table.compact() == 2
