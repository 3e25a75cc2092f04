"""Window counts of a stream that lose no row, whatever the order that files come in.

The counters of ``jobs`` keep their windows in Spark's state store: the watermark of one micro-batch can rule out rows
of the next, and complete mode, which rules out none, keeps every window for ever.  Here each micro-batch is counted by
itself and its partial counts and maxima, which can be merged in any order, go into a folded table
(``tables``).  There is no state, a batch that runs again replaces its own part, and a backlog can be read in
any order, one file at a time.

``late`` says what becomes of rows whose window had ended ``delay`` before the newest row of the batches before
(the rows that a stateful counter in update mode drops):

* ``keep``  - they count as all others;
* ``raise`` - the batch fails before anything of it is written, so its offsets stay uncommitted and every later run
  fails as well, until ``delay`` is long enough;
* ``side``  - they are kept apart, whole, in ``late/`` beside the table, and do not count.

The watermark is worked out from what the table holds of earlier batches, so a restart with another ``delay`` uses that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType

from gearwatch.functions.eventtime import utc_of_instant
from gearwatch.operators.windows import COUNTED_COLORS, MAXIMA, WATERMARK, WINDOW, category_count_name, window_metrics
from gearwatch.session import children
from gearwatch.streaming.runner import LateRowsDropped, with_trigger
from gearwatch.streaming.tables import FoldedTable, summed_of

KEYS = ["window_start", "window_end"]
LATE = ("keep", "raise", "side")


def partial_metrics(rows: DataFrame, time_col: str, **options) -> DataFrame:
    """``window_metrics`` of a batch with ``newest``, the largest time in the window (UTC wall clock)."""
    maxima = [*options.pop("maxima", MAXIMA), (time_col, "newest")]
    found = window_metrics(rows, time_col, maxima=maxima, **options)
    if isinstance(found.schema["newest"].dataType, TimestampNTZType):
        return found
    return found.withColumn("newest", utc_of_instant(F.col("newest")))


class WindowCounter:
    """The folded table of a counter's partial results, and what a micro-batch does with it."""

    def __init__(self, rows: DataFrame, out_dir: str, *, time_col: str = "event_time_ts", window: str = WINDOW,
                 delay: str = WATERMARK, late: str = "keep", categories: Sequence[str] = COUNTED_COLORS,
                 maxima: Sequence[tuple[str, str]] = MAXIMA, compact_every: int | None = None):
        if late not in LATE:
            raise ValueError(f"late must be one of {LATE}")
        self.out_dir, self.time_col, self.delay, self.late = out_dir.rstrip("/"), time_col, delay, late
        self.options = {"window": window, "categories": tuple(categories), "maxima": tuple(maxima)}
        self.compact_every, self.row_schema = compact_every, rows.schema
        empty = rows.sparkSession.createDataFrame([], rows.schema)
        self.schema = partial_metrics(empty, time_col, **self.options).schema
        counts = ["num_of_rows", *(category_count_name(c) for c in categories)]
        self.fold = summed_of(KEYS, counts, [*(out for _, out in maxima), "newest"])

    def table(self, spark: SparkSession) -> FoldedTable:
        return FoldedTable(spark, f"{self.out_dir}/counts", self.schema, self.fold)

    def _behind(self, table: FoldedTable, batch_id: int) -> Column | None:
        """Whether a window had ended before the watermark that the earlier batches set; None: there is none."""
        mark = table.rows(before=batch_id).agg((F.max("newest") - F.expr(f"interval {self.delay}")).alias("mark")).first().mark
        return None if mark is None else F.col("window_end") <= F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        table = self.table(batch.sparkSession)
        if batch_id <= table.pointer():  # counted, and folded already: the run before ended behind that
            return
        found = partial_metrics(batch, self.time_col, **self.options)
        behind = None if self.late == "keep" else self._behind(table, batch_id)
        if behind is None:
            table.write(found, batch_id)
        else:
            found = found.persist()  # some rows a window
            try:
                if self.late == "raise":
                    lost = found.where(behind).agg(F.sum("num_of_rows").alias("n")).first().n
                    if lost:
                        raise LateRowsDropped(f"{lost} rows of batch {batch_id} lie behind the watermark of {self.delay}; "
                                              "nothing of the batch was written: give a delay of the backlog's time span")
                else:
                    ended = F.window(F.col(self.time_col), self.options["window"]).getField("end")
                    if not isinstance(batch.schema[self.time_col].dataType, TimestampNTZType):
                        ended = utc_of_instant(ended)
                    late = batch.withColumn("window_end", ended).where(behind).drop("window_end")
                    late.write.mode("overwrite").parquet(f"{self.out_dir}/late/batch_id={batch_id}")
                table.write(found.where(~behind), batch_id)
            finally:
                found.unpersist()
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            table.compact()

    def start(self, rows: DataFrame, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return with_trigger(writer, trigger).start()

    def read(self, spark: SparkSession) -> DataFrame:
        """The window metrics over all batches."""
        return self.table(spark).read().drop("newest")

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """The rows that were kept apart, with the ``batch_id`` that brought them."""
        schema = StructType([*self.row_schema.fields, StructField("batch_id", LongType())])
        if not children(spark, f"{self.out_dir}/late"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.out_dir}/late")
