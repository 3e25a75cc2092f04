"""File-backed topics: batches appear whole or not at all, once; readers that begin at the latest record."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gearwatch.schemas import TOPIC_RECORD
from gearwatch.sources import topics
from gearwatch.sources.topics import read_topic, record_positions, start_position, topic_path, topic_stream_writer, write_topic
from gearwatch.streaming.runner import await_or_stop, with_trigger


def inbox(spark, scratch, first, last):
    """A file of records with the numbers from ``first`` on, as the source of a stream."""
    folder = os.path.join(scratch, "in")
    spark.range(first, last).select(F.col("id").cast("string").cast("binary").alias("value")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("value binary").parquet(folder)


def publish(spark, df, scratch, checkpoint="ck"):
    writer = topic_stream_writer(df, "t", os.path.join(scratch, checkpoint), root=scratch)
    await_or_stop(with_trigger(writer, "available-now").start(), 300)


def values(df):
    return sorted(int(bytes(r.value)) for r in df.select("value").collect())


def published(spark, scratch):
    """What a batch reader and a new stream reader see now."""
    batch = values(read_topic(spark, "t", root=scratch, streaming=False))
    name = f"seen{os.urandom(4).hex()}"
    query = with_trigger(read_topic(spark, "t", root=scratch).writeStream.format("memory").queryName(name), "available-now").start()
    query.awaitTermination(120)
    assert values(spark.table(name)) == batch
    return batch


@pytest.mark.parametrize("markers", ["true", "false"])
def test_a_writer_killed_between_files_shows_nothing(spark, scratch, monkeypatch, markers):
    """The first of two files is written, the second fails; with and without the committer's own marker."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", markers)
    try:
        publish(spark, inbox(spark, scratch, 0, 10), scratch)
        source = inbox(spark, scratch, 10, 20)
        real = topics._as_record

        def broken(df):
            fails = F.when(F.col("value") == F.lit(b"15"), F.raise_error(F.lit("killed")).cast("binary")).otherwise(F.col("value"))
            return real(df.repartition(2, F.col("value") == F.lit(b"15")).withColumn("value", fails))

        monkeypatch.setattr(topics, "_as_record", lambda df: real(df))
        publish_real, died = topics._publish, []

        def dying(records, root, topic, batch):
            if not died:
                died.append(batch)
                return publish_real(broken(records), root, topic, batch)
            return publish_real(records, root, topic, batch)

        monkeypatch.setattr(topics, "_publish", dying)
        with pytest.raises(Exception, match="killed"):
            publish(spark, source, scratch)
        assert published(spark, scratch) == list(range(10))
        publish(spark, source, scratch)
        assert published(spark, scratch) == list(range(20))
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_writer_killed_around_the_rename_publishes_once(spark, scratch, monkeypatch, dies):
    source = inbox(spark, scratch, 0, 10)
    real, died = topics.rename_folder, []

    def rename(session, path, to):
        if not died and died.append(1) is None:
            if dies == "after":
                real(session, path, to)
            raise RuntimeError("the driver dies")
        real(session, path, to)

    monkeypatch.setattr(topics, "rename_folder", rename)
    with pytest.raises(Exception, match="driver dies"):
        publish(spark, source, scratch)
    whole = list(range(10))
    assert os.path.isdir(os.path.join(scratch, "t"))
    if dies == "after":
        assert published(spark, scratch) == whole
    else:  # staged, but no reader sees it
        staged = [f for _, _, names in os.walk(os.path.join(scratch, "t", "_staging")) for f in names if f.endswith(".parquet")]
        assert staged and published(spark, scratch) == []
    publish(spark, source, scratch)
    assert published(spark, scratch) == whole


def test_latest_starts_behind_what_is_there_and_goes_on_from_there(spark, scratch):
    write_topic(spark.range(3).select(F.col("id").cast("string").alias("value")), "t", root=scratch)
    publish(spark, inbox(spark, scratch, 10, 12), scratch)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "reader")

    def read():
        records = read_topic(spark, "t", root=scratch, starting_offsets="latest", checkpoint=ck)
        assert records.schema == TOPIC_RECORD
        query = with_trigger(records.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck),
                             "available-now").start()
        query.awaitTermination(120)
        return values(spark.read.schema(TOPIC_RECORD).parquet(out))

    assert read() == []
    publish(spark, inbox(spark, scratch, 12, 14), scratch)  # the same producer's next batch
    assert read() == [12, 13]
    write_topic(spark.range(20, 22).select(F.col("id").cast("string").alias("value")), "t", root=scratch)
    publish(spark, inbox(spark, scratch, 30, 31), scratch)
    assert read() == [12, 13, 20, 21, 30]  # a restart keeps the position, and reads nothing twice
    assert read() == [12, 13, 20, 21, 30]


def test_position_is_bound_to_the_checkpoint(spark, scratch):
    write_topic(spark.range(2).select(F.col("id").cast("string").alias("value")), "t", root=scratch)
    path = topic_path(scratch, "t")
    first = start_position(spark, path, os.path.join(scratch, "a"))
    write_topic(spark.range(2).select(F.col("id").cast("string").alias("value")), "t", root=scratch)
    assert start_position(spark, path, os.path.join(scratch, "a")) == first
    assert len(start_position(spark, path, os.path.join(scratch, "b"))["batch"]) == 2
    assert len(start_position(spark, path, None)["batch"]) == 2


def test_streams_cannot_take_names_that_are_passed_over(spark, scratch):
    for name in ("batch", "_x", ".x", ""):
        with pytest.raises(ValueError):
            topic_stream_writer(inbox(spark, scratch, 0, 1), "t", os.path.join(scratch, "ck"), producer=name, root=scratch)


def test_records_that_one_task_wrote_are_read_by_several(spark, scratch):
    """A file of 300,000 records has row groups enough for the readers, and positions say where each record lies."""
    value = F.concat(F.sha2(F.col("id").cast("string"), 512), F.col("id").cast("string"))
    write_topic(spark.range(0, 300_000, 1, 1).select(value.alias("value")), "t", root=scratch)
    (batch,) = os.listdir(os.path.join(scratch, "t", "batch"))
    (file,) = (x for x in os.listdir(os.path.join(scratch, "t", "batch", batch)) if x.endswith(".parquet"))
    assert pq.ParquetFile(os.path.join(scratch, "t", "batch", batch, file)).num_row_groups >= 3
    found = record_positions(spark, "t", scratch)
    assert "regexp" not in found._jdf.queryExecution().toString()  # tried from every character of each record's path
    parts = found.withColumn("task", F.spark_partition_id()).groupBy("producer", "batch", "file").agg(
        F.countDistinct("task").alias("tasks"), F.count_if(F.expr("substr(CAST(value AS STRING), 129) = row")).alias("n")).collect()
    assert [(r.producer, r.batch, r.file, r.n) for r in parts] == [("batch", batch, file, 300_000)]
    assert parts[0].tasks >= 3


def test_latest_looks_at_a_path_from_its_end(spark, scratch):
    write_topic(spark.range(2).select(F.col("id").cast("string").alias("value")), "t", root=scratch)
    records = read_topic(spark, "t", root=scratch, starting_offsets="latest")
    plan = records._jdf.queryExecution().logical().toString()
    assert "file_path" in plan and "regexp" not in plan  # a pattern would be tried from every character, for every record
