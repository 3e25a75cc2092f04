"""Topics: Kafka when a broker is configured, otherwise a folder of Parquet records.

A file-backed topic is a folder with one sub-folder per producer, and in it one for each batch that was published:
a batch write adds one to the producer ``batch``, a stream one for each of its micro-batches.  Publishing is atomic: the
records are written to a staging folder that readers pass over, which then gets its final name in one rename, so a
reader sees all of a batch or none, however its writer ends.  A micro-batch that runs again after it was
published is left as it is.  (The store has to rename a folder in one step, as HDFS and local disks do; for
others use a broker.)  A reader takes all producers' batches, also of those that come later, so batch
jobs and any number of streams (under different producer names) can feed one topic.  A record has the columns of
a Kafka record that the jobs use (``key``, ``value``, ``timestamp``).

Records can be kept in order by key: a writer with ``order_by`` deals them by key and sorts them, so the order of a
key's records is that of their positions (batch, file, row; ``record_positions``).  A key with too many records for one
file goes on in the next.

Reading a topic as a stream from the first file is the ``earliest`` offset; each new file is new data.  With ``latest`` a
reader begins behind what is published when it first starts: that position is kept beside its checkpoint, and a
restart goes on from there.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gearwatch.schemas import TOPIC_RECORD
from gearwatch.session import children, path_exists, read_text, rename_folder, write_text

# Fixed values that must equal the reference: the three topic names of the chain.
RAW_TOPIC = "sensors-sample"
ENRICHED_TOPIC = "samples-enriched"
ALERT_TOPIC = "alert-data"

# Fixed values that must equal the reference: the keyed producer's settings.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.linger.ms": "5"}


BATCH_PRODUCER = "batch"

# A file is read by at most as many tasks as it has row groups: few writing tasks do not mean few reading ones.
ROW_GROUP_BYTES = 8 << 20


def kafka_source_options(bootstrap_servers: str, topic: str,
                         starting_offsets: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def kafka_sink_options(bootstrap_servers: str, topic: str,
                       producer: dict[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **(producer or {})}


def topic_path(root: str, topic: str) -> str:
    return os.path.join(root, topic)


def read_topic(
    spark: SparkSession,
    topic: str,
    *,
    root: str | None = None,
    bootstrap_servers: str | None = None,
    streaming: bool = True,
    starting_offsets: str = "earliest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Open a topic as a (streaming) DataFrame with at least ``key, value, timestamp``.

    ``starting_offsets="latest"`` leaves out what is published already; of a file-backed topic, what was when a
    stream with this ``checkpoint`` was first opened (without one: now).

    A micro-batch is bounded by ``max_offsets_per_trigger`` records (Kafka) or
    ``max_files_per_trigger`` files (file-backed topic)."""
    if bootstrap_servers:
        reader = spark.readStream if streaming else spark.read
        opts = kafka_source_options(bootstrap_servers, topic, starting_offsets)
        if not streaming:
            opts.pop("startingOffsets")
        elif max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        return reader.format("kafka").options(**opts).load()
    if root is None:
        raise ValueError("a file-backed topic needs root=")
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError("a file-backed topic is read from the earliest or the latest record on")
    if starting_offsets == "latest" and not streaming:
        raise ValueError("a batch read has no latest offset to wait at")
    path = topic_path(root, topic)
    if not streaming:
        return spark.read.schema(TOPIC_RECORD).option("recursiveFileLookup", "true").parquet(path)
    reader = spark.readStream.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = reader.parquet(path)
    if starting_offsets == "earliest":
        return records
    batch = _from_end(F.col("_metadata.file_path"), 3, 2)
    return records.where(_behind(batch, start_position(spark, path, checkpoint))).select(*records.columns)


def _from_end(path: Column, first: int, n: int = 1) -> Column:
    """``n`` parts of a file's path, from the ``first`` from its end on.

    Found from the end, for every record: a pattern that ends there would be tried from each character of the path."""
    return F.substring_index(F.substring_index(path, "/", -first), "/", n)


def start_position(spark: SparkSession, path: str, checkpoint: str | None) -> dict[str, list[str]]:
    """Per producer, what was published when a reader first started: a stream's last batch, all of the batch writes.

    Kept in a file beside ``checkpoint``."""
    mark = f"{checkpoint.rstrip('/')}.start-{os.path.basename(path)}" if checkpoint else None
    if mark and path_exists(spark, mark):
        return json.loads(read_text(spark, mark))
    position = {}
    for producer in children(spark, path):
        names = sorted(n for n in children(spark, f"{path}/{producer}") if n[0] not in "_.")
        if producer[0] not in "_." and names:
            position[producer] = names if producer == BATCH_PRODUCER else names[-1:]
    if mark:
        write_text(spark, mark, json.dumps(position))
    return position


def _behind(batch: Column, position: dict[str, list[str]]) -> Column:
    """Whether a folder (producer/batch) was published after ``position``."""
    after = ~batch.isin([f"{BATCH_PRODUCER}/{name}" for name in position.get(BATCH_PRODUCER, ())])
    for producer, names in position.items():
        if producer != BATCH_PRODUCER:  # a stream's batches are numbered, so names are in order
            after &= ~batch.startswith(f"{producer}/") | (batch > f"{producer}/{names[-1]}")
    return after


def _publish(records: DataFrame, root: str, topic: str, batch: str) -> None:
    """Write ``records`` as the topic's folder ``batch`` (producer/name): all of it appears at once."""
    spark, path = records.sparkSession, topic_path(root, topic)
    staged = f"{path}/_staging/{batch}"  # readers pass over names that begin with _; a batch that failed is overwritten
    records.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(staged)
    rename_folder(spark, staged, f"{path}/{batch}")


def _as_record(df: DataFrame) -> DataFrame:
    key = F.col("key").cast("binary") if "key" in df.columns else F.lit(None).cast("binary")
    return df.select(key.alias("key"), F.col("value").cast("binary").alias("value"),
                     F.current_timestamp().alias("timestamp"))


def write_topic(
    df: DataFrame,
    topic: str,
    *,
    root: str | None = None,
    bootstrap_servers: str | None = None,
    producer_options: dict[str, str] | None = None,
) -> None:
    """Batch write of ``value`` (and ``key`` if present) records to a topic."""
    if bootstrap_servers:
        cols = [c for c in ("key", "value") if c in df.columns]
        (df.select(*cols).write.format("kafka")
         .options(**kafka_sink_options(bootstrap_servers, topic, producer_options)).save())
        return
    if root is None:
        raise ValueError("a file-backed topic needs root=")
    _publish(_as_record(df), root, topic, f"{BATCH_PRODUCER}/{uuid.uuid4().hex}")


def claim_producer(spark: SparkSession, folder: str, checkpoint: str) -> None:
    """Bind a producer's folder to one checkpoint.

    Another checkpoint would number its batches from 0 again: they would be taken for batches
    that are there already, and their records lost.
    """
    mark = f"{folder}/_checkpoint"
    if not path_exists(spark, mark):
        if path_exists(spark, folder):
            raise ValueError(f"{folder} holds records of an unknown checkpoint")
        write_text(spark, mark, checkpoint)
    elif (bound := read_text(spark, mark)) != checkpoint:
        raise ValueError(f"{folder} was written with the checkpoint {bound}, not {checkpoint}: go on with that one, "
                         "or choose another producer name to send all records again")


def in_key_order(records: DataFrame, order_by: Sequence[str], *, whole_keys: bool = False) -> DataFrame:
    """Records dealt by ``key`` and, within it, sorted by ``order_by``; NULL keys are a key like any other.

    They are dealt by ranges of both, so a key that holds a large part of all records is split over tasks, in order.
    ``whole_keys`` deals by key alone, for a broker, which keeps a key in one partition in any case."""
    dealt = records.repartition("key") if whole_keys else records.repartitionByRange("key", *order_by)
    return dealt.sortWithinPartitions("key", *order_by)


def topic_stream_writer(
    df: DataFrame,
    topic: str,
    checkpoint: str,
    *,
    producer: str = "stream",
    root: str | None = None,
    bootstrap_servers: str | None = None,
    order_by: Sequence[str] = (),
) -> DataStreamWriter:
    """Append-mode, checkpointed stream writer into a topic (call ``.start()``).

    ``producer`` names this stream among the writers of a file-backed topic.  With ``order_by`` (columns beside the
    record) each micro-batch is sent in ``in_key_order``."""
    if order_by and "key" not in df.columns:
        raise ValueError("records without a key have no order by key")
    if bootstrap_servers and order_by:
        options = kafka_sink_options(bootstrap_servers, topic)

        def send(batch: DataFrame, batch_id: int) -> None:
            (in_key_order(batch, order_by, whole_keys=True).select("key", "value").write.format("kafka")
             .options(**options).save())
        return df.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).outputMode("append")
    if bootstrap_servers:
        cols = [c for c in ("key", "value") if c in df.columns]
        return (df.select(*cols).writeStream.format("kafka")
                .options(**kafka_sink_options(bootstrap_servers, topic))
                .option("checkpointLocation", checkpoint).outputMode("append"))
    if root is None:
        raise ValueError("a file-backed topic needs root=")
    if producer == BATCH_PRODUCER or producer[:1] in ("", "_", "."):
        raise ValueError(f"{producer!r} cannot name a stream's producer")
    folder = f"{topic_path(root, topic)}/{producer}"
    claim_producer(df.sparkSession, folder, checkpoint)

    ordered = (lambda batch, batch_id: in_key_order(batch, order_by)) if order_by else None
    return (df.writeStream.foreachBatch(topic_batch_writer(topic, producer, root, ordered))
            .option("checkpointLocation", checkpoint).outputMode("append"))


def topic_batch_writer(topic: str, producer: str, root: str,
                       transform: Callable[[DataFrame, int], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: publish each micro-batch (what ``transform`` makes of it and its number) once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{producer}/{batch_id:012d}"
        if not path_exists(batch.sparkSession, f"{topic_path(root, topic)}/{name}"):
            _publish(_as_record(transform(batch, batch_id) if transform else batch), root, topic, name)
    return write


def record_positions(spark: SparkSession, topic: str, root: str) -> DataFrame:
    """The records of a file-backed topic with where each lies: ``producer, batch, file, row``.

    The batches of one stream and the files of a batch are numbered, so their names are in order."""
    path = F.col("_metadata.file_path")
    where = [_from_end(path, 3 - i).alias(name) for i, name in enumerate(("producer", "batch", "file"))]
    records = read_topic(spark, topic, root=root, streaming=False)
    return records.select(*records.columns, *where, F.col("_metadata.row_index").alias("row"))


def order_breaks(records: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """Per key of records with their positions: ``n_records``, ``n_breaks`` (records that lie behind one of a later time)
    and the times of the ``first`` and ``last`` record by position.

    Neighbours are compared within a file, files by their ends, so no task holds a key's records.  Records
    of several producers have no order among them; rows without a time are left out."""
    keys = list(keys)
    timed = records.where(F.col(time_col).isNotNull())
    in_file = Window.partitionBy("batch", "file", *keys).orderBy("row")
    ends = (timed.withColumn("__before", F.lag(time_col).over(in_file))
            .groupBy("batch", "file", *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__before") > F.col(time_col)).alias("breaks"),
                 F.min_by(time_col, "row").alias("first"), F.max_by(time_col, "row").alias("last")))
    over_files = Window.partitionBy(*keys).orderBy("batch", "file")  # one row a file
    joined = ends.withColumn("breaks", F.col("breaks") + F.coalesce(
        (F.lag("last").over(over_files) > F.col("first")).cast("bigint"), F.lit(0)))
    place = F.struct("batch", "file")
    return joined.groupBy(*keys).agg(F.sum("n").alias("n_records"), F.sum("breaks").alias("n_breaks"),
                                     F.min_by("first", place).alias("first"), F.max_by("last", place).alias("last"))
