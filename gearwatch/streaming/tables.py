"""Result tables that a stream folds as it goes, with a pointer that readers follow.

A folded table is a folder:

* ``delta/batch_id=N`` - what micro-batch N adds; a batch that runs again replaces its own part;
* ``base/N``           - everything up to batch N, folded;
* ``_pointers/N``      - an empty file: ``base/N`` is whole.  The largest counts.

``compact`` folds the newest base and the deltas behind it into the next base and then sets its pointer, one
file that is created or not.  A reader takes the base that the pointer names and the deltas behind it, so it sees every
batch once whenever it looks.  What the base before needs stays until the next compaction: a reader that
had begun with it ends well, and the table holds at most two bases and the deltas since the older one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from gearwatch.session import children, delete, path_exists, write_text


class FoldedTable:
    """``fold`` turns rows of several batches (with ``batch_id``) into one row a key; it has to be associative, and
    keeps ``batch_id`` (the newest) as a column."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, fold: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.fold = spark, path.rstrip("/"), fold
        self.schema = StructType([*schema.fields]).add("batch_id", LongType())

    def _delta(self, batch_id: int) -> str:
        return f"{self.path}/delta/batch_id={batch_id}"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of a micro-batch; those of an earlier run of the same batch go."""
        if batch_id > self.pointer():  # else it is in a base already
            names = [f.name for f in self.schema.fields if f.name != "batch_id"]
            rows.select(*names).write.mode("overwrite").parquet(self._delta(batch_id))

    def pointer(self) -> int:
        """The batch up to which the newest whole base holds everything; -1: there is none."""
        return max((int(name) for name in children(self.spark, f"{self.path}/_pointers")), default=-1)

    def deltas(self) -> list[int]:
        """Batches whose deltas are whole."""
        found = (int(name.partition("=")[2]) for name in children(self.spark, f"{self.path}/delta") if name.startswith("batch_id="))
        return sorted(n for n in found if path_exists(self.spark, f"{self._delta(n)}/_SUCCESS"))

    def rows(self, before: int | None = None) -> DataFrame:
        """The rows of the newest base and of the deltas behind it (``before``: of batches below that number only)."""
        base = self.pointer()
        behind = [self._delta(n) for n in self.deltas() if n > base and (before is None or n < before)]
        reader = self.spark.read.schema(self.schema)
        parts = [reader.parquet(f"{self.path}/base/{base}")] if base >= 0 else []
        if behind:
            parts.append(reader.option("basePath", f"{self.path}/delta").parquet(*behind))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """One row a key, over all batches."""
        return self.fold(self.rows()).select(*(f.name for f in self.schema.fields if f.name != "batch_id"))

    def compact(self) -> int:
        """Fold what is there into a new base, and give up what no reader of the base before it needs.

        Returns the batch that the table is folded up to."""
        old, behind = self.pointer(), self.deltas()
        new = max(behind, default=-1)
        if new <= old:
            return old
        self.fold(self.rows()).select(*(f.name for f in self.schema.fields)).write.mode("overwrite").parquet(f"{self.path}/base/{new}")
        write_text(self.spark, f"{self.path}/_pointers/{new}", "")
        for name in children(self.spark, f"{self.path}/base"):
            if int(name) < old:
                delete(self.spark, f"{self.path}/base/{name}")
        for name in children(self.spark, f"{self.path}/_pointers"):
            if int(name) < old:
                delete(self.spark, f"{self.path}/_pointers/{name}")
        for n in behind:
            if n <= old:
                delete(self.spark, self._delta(n))
        return new


def newest_of(keys: list[str], values: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Fold of update-mode results: the newest row of a key counts."""
    def fold(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*values, "batch_id"), F.col("batch_id")).alias("last")
        return rows.groupBy(*keys).agg(last).select(*keys, "last.*")
    return fold


def summed_of(keys: list[str], sums: list[str], maxima: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Fold of partial results: counts add up, maxima stay the largest."""
    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in [*maxima, "batch_id"]))
    return fold
