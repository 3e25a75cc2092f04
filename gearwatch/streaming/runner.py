"""Start streaming queries and collect their results into durable tables.

``materialize`` runs a streaming DataFrame until the input available now is
processed and returns its result as a batch DataFrame read from a table in the
shared folder; nothing passes through the driver.  The table per output mode:

* append   - Parquet file sink (exactly-once through the sink's commit log);
* complete - each micro-batch writes the whole result into one of two
  alternating ``slot=`` partitions (dynamic overwrite, so a retried batch
  replaces itself and a reader always finds the previous result intact);
  the result is the newest batch; storage stays at two results however long
  the query runs;
* update   - each micro-batch writes its changed rows the same way; the
  result is the newest row per key.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gearwatch.session import path_exists, read_text, write_text


def with_trigger(writer, trigger: str | None):
    """``None`` = as soon as possible; ``"available-now"``; or a processing-time interval."""
    if trigger is None:
        return writer
    if trigger == "available-now":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_sink(
    df: DataFrame,
    *,
    sink: str = "console",
    output_mode: str = "append",
    checkpoint: str | None = None,
    trigger: str | None = None,
    num_rows: int = 20,
    truncate: bool = False,
    query_name: str | None = None,
    path: str | None = None,
) -> StreamingQuery:
    """Start a stream into ``console``, ``memory`` (tests only) or ``parquet``."""
    writer = df.writeStream.outputMode(output_mode).format(sink)
    if sink == "console":
        writer = writer.option("numRows", num_rows).option("truncate", str(truncate).lower())
    if sink == "parquet":
        if path is None or checkpoint is None:
            raise ValueError("a parquet sink needs path= and checkpoint=")
        writer = writer.option("path", path)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if query_name is not None:
        writer = writer.queryName(query_name)
    return with_trigger(writer, trigger).start()


class LateRowsDropped(RuntimeError):
    """A run lost rows behind its watermark that it was meant to keep."""


def late_mark(checkpoint: str) -> str:
    """The file that says that a run with this checkpoint lost rows: its offsets are committed, so they stay lost."""
    return f"{checkpoint.rstrip('/')}.late-rows"


def refuse_lossy(spark: SparkSession, checkpoint: str) -> None:
    """Fails if an earlier run with this checkpoint dropped rows that it was meant to keep."""
    if path_exists(spark, late_mark(checkpoint)):
        raise LateRowsDropped(f"an earlier run lost rows ({read_text(spark, late_mark(checkpoint))}); begin with a new "
                              "checkpoint and result folder")


def await_or_stop(query: StreamingQuery, timeout_s: float | None = None, *, keep_all: bool = False,
                  checkpoint: str | None = None) -> bool:
    """Wait up to ``timeout_s`` seconds (forever if None); stop the query if still running.

    Returns True if the query ended by itself.  A query that failed re-raises.  With ``keep_all``,
    rows dropped behind the watermark are an error: a backlog read in several micro-batches
    is not in order of event time, and one batch's watermark can rule out the next one's rows.
    The offsets are committed by then: with ``checkpoint`` a mark beside it makes every later run
    that asks ``refuse_lossy`` fail as well.
    """
    dropped: dict[int, int] = {}
    deadline = None if timeout_s is None else time.monotonic() + timeout_s

    def look() -> None:  # the query keeps only its last progress reports
        for report in query.recentProgress:
            states = report["stateOperators"] or ()
            dropped[report["batchId"]] = max(dropped.get(report["batchId"], 0),
                                             sum(s.get("numRowsDroppedByWatermark", 0) for s in states))

    while True:
        left = 1.0 if deadline is None else min(1.0, deadline - time.monotonic())
        ended = query.awaitTermination(max(left, 0.01)) if query.exception() is None else True
        look()
        if ended or left <= 0:
            break
    if not ended:
        query.stop()
    if keep_all and checkpoint and sum(dropped.values()):
        spark = SparkSession.active()
        if not path_exists(spark, late_mark(checkpoint)):
            write_text(spark, late_mark(checkpoint), f"{sum(dropped.values())} rows behind the watermark")
    if query.exception() is not None:
        raise query.exception()
    if keep_all and sum(dropped.values()):
        raise LateRowsDropped(f"{sum(dropped.values())} rows lay behind the watermark and were dropped; "
                              "read the backlog in one micro-batch, or delay the watermark by its time span")
    return bool(ended)


def _batch_writer(out_dir: str, slots: int | None = None):
    """foreachBatch writer: rows tagged with ``batch_id``, partitioned by it, or by
    ``slot = batch_id % slots`` to keep only the last ``slots`` batches."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        part = "batch_id"
        if slots:
            rows, part = rows.withColumn("slot", F.lit(batch_id % slots).cast("int")), "slot"
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(part).parquet(out_dir))
    return write


def start_materialize(df: DataFrame, *, output_mode: str, out_dir: str, checkpoint: str,
                      trigger: str | None = "available-now") -> StreamingQuery:
    """Start the query that writes ``df``'s stream into ``out_dir`` (see module doc)."""
    if output_mode == "append":
        writer = (df.writeStream.format("parquet").outputMode("append")
                  .option("path", out_dir).option("checkpointLocation", checkpoint))
    elif output_mode in ("complete", "update"):
        slots = 2 if output_mode == "complete" else None
        writer = (df.writeStream.outputMode(output_mode)
                  .foreachBatch(_batch_writer(out_dir, slots))
                  .option("checkpointLocation", checkpoint))
    else:
        raise ValueError(f"unknown output mode {output_mode!r}")
    return with_trigger(writer, trigger).start()


def read_materialized(spark, out_dir: str, output_mode: str, schema,
                      key_cols: Sequence[str] = ()) -> DataFrame:
    """The result table of ``start_materialize`` as a batch DataFrame."""
    cols = [f.name for f in schema.fields]
    if output_mode == "append":
        return spark.read.schema(schema).parquet(out_dir)
    try:
        table = spark.read.parquet(out_dir)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no batch had a row yet
            return spark.createDataFrame([], schema)
        raise
    if output_mode == "complete":
        newest = table.agg(F.max("batch_id").alias("batch_id"))
        return table.join(F.broadcast(newest), "batch_id").select(*cols)
    if not key_cols:
        raise ValueError("update mode needs key_cols to fold changes")
    values = [c for c in cols if c not in key_cols]
    folded = table.groupBy(*key_cols).agg(
        F.max_by(F.struct(*values), F.col("batch_id")).alias("__last"))
    return folded.select(*key_cols, *[F.col(f"__last.{c}").alias(c) for c in values]).select(*cols)


def materialize(df: DataFrame, *, output_mode: str, out_dir: str, checkpoint: str,
                key_cols: Sequence[str] = (), timeout_s: float | None = None,
                keep_all: bool = True) -> DataFrame:
    """Run ``df`` over the input available now (``availableNow``) and return its result.

    Fails if rows are dropped behind the watermark, unless ``keep_all=False`` allows it;
    there is no time limit unless ``timeout_s`` sets one."""
    if keep_all:
        refuse_lossy(df.sparkSession, checkpoint)
    query = start_materialize(df, output_mode=output_mode, out_dir=out_dir, checkpoint=checkpoint)
    if not await_or_stop(query, timeout_s, keep_all=keep_all, checkpoint=checkpoint):
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    return read_materialized(df.sparkSession, out_dir, output_mode, df.schema, key_cols)
