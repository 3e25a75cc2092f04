"""Records that come more than once, as after a hop that delivers at least once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once_within(rows: DataFrame, keys: Sequence[str], arrival: str, span: str) -> DataFrame:
    """Each key once: a row goes if one of its key arrived before it, at most ``span`` earlier by the clock ``arrival``.

    Which of several rows of a key in one micro-batch stays is open: they have to be repeats.  A row with a NULL in
    its key has no identity and always stays, as does, in a stream, one without an ``arrival``.  ``arrival`` should be the
    time that a record was published, which grows from batch to batch; ``span`` has to cover how much later a repeat can
    come, and how far the partitions of a topic can lie apart: a stream drops rows that arrived more than ``span`` before the newest of the
    batches before (``await_or_stop(keep_all=True)`` makes that an error).  It also bounds the state (one entry a key seen within it: use the RocksDB state store for many).  Repeats of one key meet in one
    task, at most as many as were sent.  A batch frame holds all its rows, so there ``span`` does not matter.
    """
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    named, unnamed = rows.where(known), rows.where(~known)
    if not rows.isStreaming:
        return named.dropDuplicates(list(keys)).unionByName(unnamed)
    named, unnamed = (rows.where(x) for x in (known & F.col(arrival).isNotNull(), ~known | F.col(arrival).isNull()))
    return named.withWatermark(arrival, span).dropDuplicatesWithinWatermark(list(keys)).unionByName(unnamed)
