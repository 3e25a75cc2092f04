"""Command-line entry points for the jobs (``python -m gearwatch.cli <job> ...`` or spark-submit).

Jobs, in the order they are usually started:

* ``dims``     write the cars, car_models and car_colors dimensions (Parquet, versioned paths)
* ``generate`` publish synthetic sensor events (keyed by event id) to the raw topic
* ``enrich``   stream: raw topic -> enriched topic
* ``detect``   stream: enriched topic -> alert topic
* ``count``    stream: alert topic -> window metrics (console by default, complete mode)
* ``fused``    stream: raw topic -> window metrics of alerts in one query (no intermediate topics)
* ``quarantine`` stream: raw topic -> a topic of its whole records and one of its damaged messages
* ``audit``    the windows that a counter's checkpoint holds, and its watermark
* ``inject``   publish one fixed alert to the alert topic
* ``tap``      print parsed alerts to the console for some seconds
* ``schema``   print the schemas of a topic's records and of the wire records
* ``smoke``    storage round trip of a small table, and a topic-source check

Topics are Kafka with ``--bootstrap-servers``, otherwise folders under ``--topics``.  A job's
checkpoint is the same at every start: beside the file-backed topics (``--topics``), or for
Kafka in the session's ``spark.checkpoint.dir``; ``--checkpoint`` names another one.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from gearwatch.session import build_session, configured_root


def _dims_paths(root: str, version: str) -> dict[str, str]:
    return {name: os.path.join(root, name, f"v={version}") for name in ("cars", "car_models", "car_colors")}


def _load_dims(spark: SparkSession, root: str, version: str):
    from gearwatch.sources.dims import read_dimension
    p = _dims_paths(root, version)
    return read_dimension(spark, p["cars"]), read_dimension(spark, p["car_models"]), \
        read_dimension(spark, p["car_colors"])


def _wait(query, args, ckpt: str) -> None:
    """Until the query ends (``--available-now``) or is stopped; at most ``--timeout`` seconds.

    A backlog that ``--available-now`` works off must not lose rows behind the watermark."""
    from gearwatch.streaming.runner import await_or_stop
    await_or_stop(query, args.timeout, keep_all=args.available_now and not args.allow_late_drops, checkpoint=ckpt)


def default_checkpoint(spark: SparkSession, args) -> str:
    """A job's checkpoint: the same folder whenever it is started on the same topics."""
    name = "-".join(str(x) for x in (args.job, getattr(args, "mode", None)) if x)
    if getattr(args, "topics", None):
        return os.path.join(args.topics, "_checkpoints", name)
    root = configured_root(spark)
    if root is None:
        raise SystemExit("give --checkpoint, or set spark.checkpoint.dir: a restart must find the same folder")
    return os.path.join(root, "gearwatch", "checkpoints", name)


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="gearwatch")
    sub = ap.add_subparsers(dest="job", required=True)

    def topics(p):
        p.add_argument("--topics", help="folder of file-backed topics")
        p.add_argument("--bootstrap-servers", help="Kafka brokers (needs the Kafka connector)")

    def streaming(p):
        p.add_argument("--checkpoint", help="checkpoint folder (default: one that is the same at every start)")
        p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        p.add_argument("--timeout", type=float, default=None, help="stop after this many seconds")
        p.add_argument("--max-files-per-trigger", type=int, default=None,
                       help="bound a micro-batch of a file-backed topic (then give --watermark the backlog's span)")
        p.add_argument("--max-offsets-per-trigger", type=int, default=None, help="bound a micro-batch of a Kafka topic")
        p.add_argument("--starting-offsets", default=None, help="earliest (default) or latest")
        p.add_argument("--allow-late-drops", action="store_true",
                       help="with --available-now: rows behind the watermark may be dropped")

    p = sub.add_parser("dims")
    p.add_argument("--out", required=True)
    p.add_argument("--version", default="1")
    p.add_argument("--cars", type=int, default=20)
    p.add_argument("--salt", type=int, default=0)

    p = sub.add_parser("generate")
    p.add_argument("--dims", required=True)
    p.add_argument("--version", default="1")
    p.add_argument("--events", type=int, default=100)
    topics(p)

    for name in ("enrich", "detect"):
        p = sub.add_parser(name)
        if name == "enrich":
            p.add_argument("--dims", required=True)
            p.add_argument("--version", default="1")
        topics(p)
        streaming(p)
        p.add_argument("--dedup-within", help="leave out an event id that is published again within this span, e.g. '1 day'")
        p.add_argument("--ordered", action="store_true", help="key records by car and send them in order of event time")

    p = sub.add_parser("quarantine")
    p.add_argument("--sink", help="topic of whole records")
    p.add_argument("--bad-sink", help="topic of damaged messages")
    topics(p)
    streaming(p)

    p = sub.add_parser("audit")
    p.add_argument("--checkpoint", required=True, help="a counter's checkpoint")

    p = sub.add_parser("count")
    topics(p)
    streaming(p)
    p.add_argument("--mode", default="complete", choices=("complete", "update", "append", "partials"),
                   help="partials: count each micro-batch by itself into a table (--out); loses no row in any order")
    p.add_argument("--trigger", default="1 minute")
    p.add_argument("--watermark", default="48 hours")
    p.add_argument("--window", default="15 minutes")
    p.add_argument("--out", help="with --mode partials: the folder of the result table")
    p.add_argument("--late", default="keep", choices=("keep", "raise", "side"),
                   help="with --mode partials: rows behind the watermark count, fail their batch, or are kept apart")
    p.add_argument("--dedup-within", help="with --mode partials: as for detect")
    p.add_argument("--compact-every", type=int, default=100, help="with --mode partials: micro-batches from fold to fold")

    p = sub.add_parser("fused")
    p.add_argument("--dims", required=True)
    p.add_argument("--version", default="1")
    topics(p)
    streaming(p)
    p.add_argument("--mode", default="update", choices=("complete", "update", "append"))
    p.add_argument("--trigger", default="1 minute")
    p.add_argument("--watermark", default="48 hours")

    for name in ("inject", "schema"):
        topics(sub.add_parser(name))

    p = sub.add_parser("tap")
    topics(p)
    p.add_argument("--seconds", type=float, default=20)
    p.add_argument("--starting-offsets", default=None)

    p = sub.add_parser("smoke")
    p.add_argument("--out", required=True)
    topics(p)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session(f"gearwatch-{args.job}")
    topic_opts = {"topics_root": getattr(args, "topics", None),
                  "bootstrap_servers": getattr(args, "bootstrap_servers", None)}
    ckpt = None
    if hasattr(args, "checkpoint"):
        ckpt = args.checkpoint or default_checkpoint(spark, args)
        if getattr(args, "mode", None) and not args.allow_late_drops:
            from gearwatch.streaming.runner import refuse_lossy
            refuse_lossy(spark, ckpt)
    trigger = "available-now" if getattr(args, "available_now", False) else None
    stream_opts = {k: getattr(args, k, None)
                   for k in ("max_files_per_trigger", "max_offsets_per_trigger", "starting_offsets")}

    if args.job == "dims":
        from gearwatch.sources.dims import car_colors, car_models, random_cars, write_dimension
        paths = _dims_paths(args.out, args.version)
        write_dimension(random_cars(spark, args.cars, args.salt), paths["cars"])
        write_dimension(car_models(spark), paths["car_models"])
        write_dimension(car_colors(spark), paths["car_colors"])
    elif args.job == "generate":
        from gearwatch.streaming.jobs import run_generator
        cars, _, _ = _load_dims(spark, args.dims, args.version)
        run_generator(spark.range(args.events), cars, **topic_opts)
    elif args.job == "enrich":
        from gearwatch.streaming.jobs import start_enrichment
        cars, models, colors = _load_dims(spark, args.dims, args.version)
        q = start_enrichment(spark, cars, models, colors, checkpoint=ckpt, trigger=trigger,
                             dedup_within=args.dedup_within, ordered=args.ordered, **topic_opts, **stream_opts)
        _wait(q, args, ckpt)
    elif args.job == "detect":
        from gearwatch.streaming.jobs import start_detection
        q = start_detection(spark, checkpoint=ckpt, trigger=trigger, dedup_within=args.dedup_within,
                            ordered=args.ordered, **topic_opts, **stream_opts)
        _wait(q, args, ckpt)
    elif args.job == "quarantine":
        from gearwatch.streaming.jobs import start_quarantine
        if args.bootstrap_servers or not args.topics:
            raise SystemExit("quarantine works on file-backed topics (--topics)")
        sinks = {k: v for k, v in (("sink", args.sink), ("bad_sink", args.bad_sink)) if v}
        q = start_quarantine(spark, checkpoint=ckpt, topics_root=args.topics, trigger=trigger, **sinks, **stream_opts)
        _wait(q, args, ckpt)
    elif args.job == "audit":
        from gearwatch.streaming.audit import state_summary
        state_summary(spark, ckpt).show(truncate=False)
    elif args.job == "count" and args.mode == "partials":
        from gearwatch.streaming.jobs import start_partial_counter
        if not args.out:
            raise SystemExit("--mode partials needs --out")
        counter, q = start_partial_counter(spark, out_dir=args.out, checkpoint=ckpt, trigger=trigger or args.trigger,
                                           window=args.window, delay=args.watermark, late=args.late,
                                           compact_every=args.compact_every, dedup_within=args.dedup_within,
                                           **topic_opts, **stream_opts)
        _wait(q, args, ckpt)
        counter.read(spark).orderBy("window_start").show(50, truncate=False)
    elif args.job == "count":
        from gearwatch.streaming.jobs import start_counter
        q = start_counter(spark, checkpoint=ckpt, output_mode=args.mode,
                          trigger=trigger or args.trigger, window=args.window,
                          watermark=args.watermark, **topic_opts, **stream_opts)
        _wait(q, args, ckpt)
    elif args.job == "fused":
        from gearwatch.streaming.jobs import start_fused_counter
        cars, models, colors = _load_dims(spark, args.dims, args.version)
        q = start_fused_counter(spark, cars, models, colors, checkpoint=ckpt, output_mode=args.mode,
                                trigger=trigger or args.trigger, watermark=args.watermark,
                                **topic_opts, **stream_opts)
        _wait(q, args, ckpt)
    elif args.job == "tap":
        from gearwatch.streaming.jobs import debug_tap
        debug_tap(spark, seconds=args.seconds, starting_offsets=args.starting_offsets, **topic_opts)
    elif args.job == "schema":
        from gearwatch.schemas import ALERT_EVENT, RAW_EVENT, TOPIC_RECORD
        from gearwatch.sources.topics import RAW_TOPIC
        from gearwatch.streaming.jobs import open_topic
        if args.bootstrap_servers:
            open_topic(spark, RAW_TOPIC, **topic_opts).printSchema()
        for schema in (TOPIC_RECORD, RAW_EVENT, ALERT_EVENT):
            spark.createDataFrame([], schema).printSchema()
    elif args.job == "inject":
        from gearwatch.streaming.jobs import publish_alert
        publish_alert(spark, **topic_opts)
    elif args.job == "smoke":
        from gearwatch.sources.dims import read_dimension, smoke_table, write_dimension
        from gearwatch.sources.topics import RAW_TOPIC, read_topic
        write_dimension(smoke_table(spark), args.out)
        print(f"storage round trip: {read_dimension(spark, args.out).count()} rows")
        try:  # new messages only, as a connector check reads
            read_topic(spark, RAW_TOPIC, root=args.topics, bootstrap_servers=args.bootstrap_servers, starting_offsets="latest")
            print("topic source: available")
        except AnalysisException as exc:  # no connector, no such folder: report it, as a smoke check does
            print(f"topic source: not available ({exc.getCondition() or type(exc).__name__})")
    return 0


if __name__ == "__main__":
    sys.exit(main())
