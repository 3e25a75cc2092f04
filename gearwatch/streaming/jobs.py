"""The jobs: the three long-running stream jobs (enrichment, detection, window
counter), their fused single-query alternative, the event generator and the
manual alert publisher.

Each stream job reads a topic (Kafka with ``bootstrap_servers``, else a file-backed topic
under ``topics_root``), transforms with the same functions as the batch plans,
and writes checkpointed output.  The dimension tables are read once when the
job starts (a stream-static join); to refresh them, write a new versioned
path and restart the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from gearwatch.functions.codec import decode, decode_checked, encode
from gearwatch.functions.eventtime import parse_event_time
from gearwatch.operators.rules import DEFAULT_RULES, Rule
from gearwatch.operators.windows import COUNTED_COLORS, WATERMARK, WINDOW
from gearwatch.plans.chain import (
    SENT_ORDER,
    counting_stage,
    decode_once,
    detection_stage,
    enrichment_stage,
    fused_from_records,
)
from gearwatch.schemas import ALERT_EVENT, ENRICHED_EVENT, RAW_EVENT
from gearwatch.session import path_exists, read_text, write_text
from gearwatch.sources.dims import current_version, read_version
from gearwatch.sources.generate import injected_alert, synth_events
from gearwatch.sources.topics import (
    ALERT_TOPIC,
    ENRICHED_TOPIC,
    PRODUCER_OPTIONS,
    RAW_TOPIC,
    claim_producer,
    read_topic,
    topic_batch_writer,
    topic_path,
    topic_stream_writer,
    write_topic,
)
from gearwatch.streaming.partials import WindowCounter
from gearwatch.streaming.runner import start_sink, with_trigger

# Fixed values that must equal the reference: the counter's trigger and console rows.
COUNTER_TRIGGER = "1 minute"
COUNTER_ROWS = 50

# What the jobs pass on to read_topic: where to begin, and how much a micro-batch takes.
SOURCE_OPTIONS = ("topics_root", "bootstrap_servers", "starting_offsets", "max_files_per_trigger",
                  "max_offsets_per_trigger", "checkpoint")


def open_topic(spark: SparkSession, topic: str, topics_root: str | None = None, **options) -> DataFrame:
    """``read_topic`` as a stream with the options that a job was given (None: the default)."""
    if options.get("bootstrap_servers"):
        options.pop("checkpoint", None)  # a broker's reader keeps its position in the checkpoint itself
    return read_topic(spark, topic, root=topics_root, **{k: v for k, v in options.items() if v is not None})


def start_enrichment(spark: SparkSession, cars: DataFrame | None = None,
                     models: DataFrame | None = None, colors: DataFrame | None = None, *,
                     checkpoint: str, profiles: DataFrame | None = None,
                     topics_root: str | None = None,
                     bootstrap_servers: str | None = None, source: str = RAW_TOPIC,
                     sink: str = ENRICHED_TOPIC, trigger: str | None = None, producer: str = "enrich",
                     broadcast_max_bytes: int | None = None, dedup_within: str | None = None,
                     ordered: bool = False, **source_options) -> StreamingQuery:
    """Raw topic -> enriched topic.  A fleet too large to broadcast should be
    passed as ``profiles`` from ``save_profiles`` (bucketed by car id).
    ``dedup_within``: an event id that is published again within that span is left out.  ``ordered``: records are
    keyed by car and each micro-batch is sent in order of event time by car.
    ``source_options``: ``SOURCE_OPTIONS``, the last three."""
    raw = open_topic(spark, source, topics_root, bootstrap_servers=bootstrap_servers, checkpoint=checkpoint,
                     **source_options)
    out = enrichment_stage(raw, cars, models, colors, profiles=profiles, dedup_within=dedup_within, ordered=ordered,
                           broadcast_max_bytes=broadcast_max_bytes)
    writer = topic_stream_writer(out, sink, checkpoint, producer=producer, root=topics_root,
                                 bootstrap_servers=bootstrap_servers, order_by=SENT_ORDER if ordered else ())
    return with_trigger(writer, trigger).start()


def start_refreshed_enrichment(spark: SparkSession, dims_root: str, *, checkpoint: str, topics_root: str,
                               source: str = RAW_TOPIC, sink: str = ENRICHED_TOPIC, trigger: str | None = None,
                               producer: str = "enrich", broadcast_max_bytes: int | None = None,
                               **source_options) -> StreamingQuery:
    """Raw topic -> enriched topic, with the dimensions of ``publish_dimension`` under ``dims_root`` (``cars``,
    ``car_models``, ``car_colors``) looked up again for every micro-batch: no restart for a new version.

    The versions that a batch took are kept beside the checkpoint, so a batch that runs again takes the same."""
    raw = open_topic(spark, source, topics_root, checkpoint=checkpoint, **source_options)
    names = ("cars", "car_models", "car_colors")

    def enriched(batch: DataFrame, batch_id: int) -> DataFrame:
        session, mark = batch.sparkSession, f"{checkpoint.rstrip('/')}.dims/{batch_id:012d}"
        if not path_exists(session, mark):
            versions = [current_version(session, f"{dims_root}/{name}") for name in names]
            write_text(session, mark, " ".join(map(str, versions)))
        versions = map(int, read_text(session, mark).split())
        dims = [read_version(session, f"{dims_root}/{name}", v) for name, v in zip(names, versions)]
        return enrichment_stage(batch, *dims, broadcast_max_bytes=broadcast_max_bytes)

    claim_producer(spark, f"{topic_path(topics_root, sink)}/{producer}", checkpoint)
    writer = (raw.writeStream.foreachBatch(topic_batch_writer(sink, producer, topics_root, enriched))
              .option("checkpointLocation", checkpoint))
    return with_trigger(writer, trigger).start()


def start_detection(spark: SparkSession, *, checkpoint: str, topics_root: str | None = None,
                    bootstrap_servers: str | None = None, source: str = ENRICHED_TOPIC,
                    sink: str = ALERT_TOPIC, rules: Sequence[Rule] = DEFAULT_RULES,
                    trigger: str | None = None, producer: str = "detect", dedup_within: str | None = None,
                    ordered: bool = False, **source_options) -> StreamingQuery:
    """Enriched topic -> alert topic; ``dedup_within`` and ``ordered`` as in ``start_enrichment``."""
    records = open_topic(spark, source, topics_root, bootstrap_servers=bootstrap_servers, checkpoint=checkpoint,
                         **source_options)
    alerts = detection_stage(records, rules, dedup_within=dedup_within, ordered=ordered)
    writer = topic_stream_writer(alerts, sink, checkpoint, producer=producer, root=topics_root,
                                 bootstrap_servers=bootstrap_servers, order_by=SENT_ORDER if ordered else ())
    return with_trigger(writer, trigger).start()


def start_quarantine(spark: SparkSession, *, checkpoint: str, topics_root: str, schema: StructType = RAW_EVENT,
                     source: str = RAW_TOPIC, sink: str = f"{RAW_TOPIC}-checked", bad_sink: str = f"{RAW_TOPIC}-damaged",
                     trigger: str | None = None, producer: str = "quarantine", **source_options) -> StreamingQuery:
    """A topic -> its whole records in one topic, its damaged messages as they came in another (``decode_checked``).

    Both are written from one persisted parse of the micro-batch; a batch that runs again leaves what it has published."""
    for topic in (sink, bad_sink):
        claim_producer(spark, f"{topic_path(topics_root, topic)}/{producer}", checkpoint)
    good_out, bad_out = (topic_batch_writer(topic, producer, topics_root) for topic in (sink, bad_sink))

    def split(batch: DataFrame, batch_id: int) -> None:
        parsed = decode_checked(batch, schema, keep=("key", "value")).select("key", "value", "damaged").persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            bad_out(parsed.where("damaged"), batch_id)
            good_out(parsed.where("not damaged"), batch_id)
        finally:
            parsed.unpersist()

    raw = open_topic(spark, source, topics_root, checkpoint=checkpoint, **source_options)
    return with_trigger(raw.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint), trigger).start()


def counter_frame(spark: SparkSession, *, topics_root: str | None = None,
                  bootstrap_servers: str | None = None, source: str = ALERT_TOPIC,
                  window: str = WINDOW, watermark: str | None = WATERMARK,
                  categories: Sequence[str] = COUNTED_COLORS, **source_options) -> DataFrame:
    """Alert topic -> window metrics, as a stream.

    A backlog that is read in several micro-batches is not in order of event time: its
    ``watermark`` should be at least as long as the backlog's time span, else rows are dropped
    (``await_or_stop(..., keep_all=True)`` makes that an error)."""
    records = open_topic(spark, source, topics_root, bootstrap_servers=bootstrap_servers, **source_options)
    return counting_stage(records, window=window, watermark=watermark, categories=categories)


def start_counter(spark: SparkSession, *, checkpoint: str, topics_root: str | None = None,
                  bootstrap_servers: str | None = None, output_mode: str = "complete",
                  sink: str = "console", trigger: str | None = COUNTER_TRIGGER,
                  num_rows: int = COUNTER_ROWS, **frame_opts) -> StreamingQuery:
    """The window counter.  ``complete`` re-emits every window each trigger and keeps
    all windows in state; ``update`` emits changed windows and lets the watermark
    evict state, which is the mode to use for a long-running job."""
    metrics = counter_frame(spark, topics_root=topics_root, checkpoint=checkpoint,
                            bootstrap_servers=bootstrap_servers, **frame_opts)
    return start_sink(metrics, sink=sink, output_mode=output_mode, checkpoint=checkpoint,
                      trigger=trigger, num_rows=num_rows)


def timed_alerts(spark: SparkSession, *, topics_root: str | None = None, bootstrap_servers: str | None = None,
                 source: str = ALERT_TOPIC, dedup_within: str | None = None, **source_options) -> DataFrame:
    """Alert topic -> alerts with ``event_time_ts``, as a stream."""
    records = open_topic(spark, source, topics_root, bootstrap_servers=bootstrap_servers, **source_options)
    return decode_once(records, ENRICHED_EVENT, dedup_within).withColumn("event_time_ts", parse_event_time(F.col("event_time")))


def start_partial_counter(spark: SparkSession, *, out_dir: str, checkpoint: str, trigger: str | None = COUNTER_TRIGGER,
                          topics_root: str | None = None, bootstrap_servers: str | None = None,
                          source: str = ALERT_TOPIC, window: str = WINDOW, delay: str = WATERMARK, late: str = "keep",
                          categories: Sequence[str] = COUNTED_COLORS, compact_every: int | None = None,
                          **source_options) -> tuple[WindowCounter, StreamingQuery]:
    """The window counter as a table of partial counts: any order of the backlog, no state (see ``partials``)."""
    rows = timed_alerts(spark, topics_root=topics_root, bootstrap_servers=bootstrap_servers, source=source,
                        checkpoint=checkpoint, **source_options)
    counter = WindowCounter(rows, out_dir, window=window, delay=delay, late=late, categories=categories,
                            compact_every=compact_every)
    return counter, counter.start(rows, checkpoint, trigger)


def start_fused_counter(spark: SparkSession, cars: DataFrame | None = None,
                        models: DataFrame | None = None, colors: DataFrame | None = None, *,
                        checkpoint: str, profiles: DataFrame | None = None,
                        topics_root: str | None = None, bootstrap_servers: str | None = None,
                        source: str = RAW_TOPIC, output_mode: str = "update",
                        sink: str = "console", trigger: str | None = COUNTER_TRIGGER,
                        window: str = WINDOW, watermark: str | None = WATERMARK,
                        broadcast_max_bytes: int | None = None, **source_options) -> StreamingQuery:
    """Raw topic -> window metrics of alerts in one streaming query.

    Replaces enrichment + detection + counter when the intermediate topics
    are not needed by anyone else: no JSON re-encoding, and the alert filter
    runs before the enrichment joins."""
    raw = open_topic(spark, source, topics_root, bootstrap_servers=bootstrap_servers, checkpoint=checkpoint,
                     **source_options)
    metrics = fused_from_records(raw, cars, models, colors, window=window, watermark=watermark,
                                 profiles=profiles, broadcast_max_bytes=broadcast_max_bytes)
    return start_sink(metrics, sink=sink, output_mode=output_mode, checkpoint=checkpoint,
                      trigger=trigger, num_rows=COUNTER_ROWS)


# Fixed values that must equal the reference: columns, rows and seconds of the console tap.
TAP_COLUMNS = ("event_time", "event_time_ts", "speed", "rpm", "gear", "color_name")
TAP_ROWS = 5
TAP_SECONDS = 20


def tap_frame(spark: SparkSession, *, topics_root: str | None = None, bootstrap_servers: str | None = None,
              source: str = ALERT_TOPIC, **source_options) -> DataFrame:
    """Alerts with their parsed time, as a stream of ``TAP_COLUMNS``."""
    records = open_topic(spark, source, topics_root, bootstrap_servers=bootstrap_servers, **source_options)
    alerts = decode(records, ENRICHED_EVENT)
    return alerts.withColumn("event_time_ts", parse_event_time(F.col("event_time"))).select(*TAP_COLUMNS)


def debug_tap(spark: SparkSession, *, seconds: float = TAP_SECONDS, num_rows: int = TAP_ROWS, sink: str = "console",
              query_name: str | None = None, **frame_options) -> None:
    """Print parsed alert times to the console for a bounded time, then stop."""
    query = start_sink(tap_frame(spark, **frame_options), sink=sink, output_mode="append", num_rows=num_rows,
                       query_name=query_name)
    query.awaitTermination(seconds)
    query.stop()


def run_generator(ids: DataFrame, cars: DataFrame, *, topics_root: str | None = None,
                  bootstrap_servers: str | None = None, topic: str = RAW_TOPIC,
                  time_col: str | None = None, id_col: str = "id") -> None:
    """Batch job: one synthetic sensor event per row of ``ids``, published keyed by event id.

    Replaces a driver-side producer loop: generation, encoding and the topic
    write all run on the executors (``spark.range(n)`` is a fine id source).
    """
    events = synth_events(ids, cars, id_col=id_col, time_col=time_col)
    write_topic(encode(events, [f.name for f in RAW_EVENT.fields], key="event_id"), topic,
                root=topics_root, bootstrap_servers=bootstrap_servers,
                producer_options=PRODUCER_OPTIONS)


def publish_alert(spark: SparkSession, *, topics_root: str | None = None,
                  bootstrap_servers: str | None = None, topic: str = ALERT_TOPIC, **fields) -> None:
    """Write the single manual test alert (unkeyed) to the alert topic."""
    record = encode(injected_alert(spark, **fields), [f.name for f in ALERT_EVENT.fields])
    write_topic(record, topic, root=topics_root, bootstrap_servers=bootstrap_servers)
