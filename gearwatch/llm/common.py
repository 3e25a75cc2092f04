"""Helpers shared by the operators: shared scratch, whole-text batches, text bytes as numpy."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import gearwatch

T = TypeVar("T")
TEXT_CHUNK = 4 << 20  # characters that a worker keeps unpacked at a time; one longer text is taken alone


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package, wherever the driver was started.

    Once for each application, as a zip from the driver's file server; a package that was submitted as
    a zip (``--py-files``) is there already.
    """
    sc, package = spark.sparkContext, Path(gearwatch.__file__).parent
    if sc.applicationId in _SHIPPED or not package.is_dir():
        return
    with zipfile.ZipFile(packed := Path(tempfile.mkdtemp(prefix="llm-code-"), "gearwatch.zip"), "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(str(packed))
    _SHIPPED.add(sc.applicationId)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: StructType | str, keeps: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers.

    ``keeps``: ``run`` asks for ``worker_state``; otherwise a worker first lets go of what an earlier step left there.
    Behind each task it gives back the memory that is free again.
    """
    ship_package(df.sparkSession)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release_state()
        yield from run(batches)
        give_back()

    return df.mapInArrow(alone, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from the session's ``spark.checkpoint.dir``.

    Only a session without one (tests on a local master) gets a temporary folder.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, kept in the shared folder, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def part_count(spark: SparkSession, rows: int, part_rows: int) -> int:
    """Parts for narrow ``rows`` that are known to be so few: ``part_rows`` in each, as far as that keeps all cores busy."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // part_rows))


_HELD: list[tuple[object, object]] = []


def worker_state(key: object, build: Callable[[], T]) -> T:
    """What ``build`` makes, kept by this worker process until it is asked for something else.

    Workers go on from job to job: so they hold one operator's tables at a time, not those of all, and none
    while they run a step that needs none (``map_batches``).
    """
    if not _HELD or _HELD[0][0] != key:
        _HELD.clear()
        _HELD.append((key, build()))
    return _HELD[0][1]


def release_state() -> None:
    """Let go of what this worker process keeps (by name: a function that is sent to workers has copies of its globals)."""
    _HELD.clear()


def give_back() -> None:
    """Return freed memory to the system: workers wait for further tasks beside the executor and others that run."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # glibc has it
        trim(0)


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = TEXT_CHUNK) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) in runs of about ``limit`` characters, nulls as empty texts.

    Expects the id in the first and the text in the second column.
    """
    for batch in batches:
        ids, column = batch.column(0), batch.column(1).fill_null("")
        sizes = np.asarray(pc.utf8_length(column), np.int64)
        start = size = 0
        for i, n in enumerate(sizes.tolist(), 1):
            size += n
            if size >= limit or i == len(sizes):
                yield ids.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, size = i, 0


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one array of its UTF-8 bytes and the offsets of its rows (nulls: empty)."""
    column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
