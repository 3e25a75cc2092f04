"""Session construction and the shared working folder.

Jobs never pick a machine-local folder on a cluster: checkpoints, stream
state and materialised tables go under ``spark.checkpoint.dir``, the shared
folder the cluster names.  Only a local-mode session without that setting (a
test run) gets a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a session this library builds itself (tests, bench, scripts).
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}
# State store: the window metrics keep one row per window (96 a day, whatever
# the event volume), so Spark's default in-memory provider fits and commits
# faster.  For large keyed state, set
#   spark.sql.streaming.stateStore.providerClass =
#   org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider

_LOCAL_ROOT: str | None = None


def build_session(app_name: str = "gearwatch", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def configured_root(spark: SparkSession) -> str | None:
    """The shared folder that the session names (``spark.checkpoint.dir`` or the context's), if any."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    return root.rstrip("/") if root else None


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    If the session names none, only a local-mode session may fall back to a
    private temporary folder; a cluster session must name one.
    """
    global _LOCAL_ROOT
    root = configured_root(spark)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="gearwatch-")
    return _LOCAL_ROOT


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared root (not created here)."""
    return os.path.join(shared_root(spark), "gearwatch", f"{name}-{uuid.uuid4().hex[:12]}")


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of any path that Spark can read."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.getFileStatus(where).isDirectory()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new text file; fails if there is one already."""
    fs, where = _hadoop(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, where = _hadoop(spark, path)  # not through a reader: those pass over names like "_checkpoint"
    opened = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = _hadoop(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(where)] if fs.exists(where) else []


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder its final name, which must be free; on HDFS and local disks in one step."""
    fs, where = _hadoop(spark, path)
    _, target = _hadoop(spark, to)
    if fs.exists(target):
        raise FileExistsError(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(where, target):
        raise OSError(f"{path} cannot be renamed to {to}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that the caller itself wrote."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a working folder that ``fresh_dir`` named, or one below it."""
    root = os.path.join(shared_root(spark), "gearwatch") + "/"
    if not path.startswith(root) or ".." in path:
        raise ValueError(f"{path} is no working folder of this library")
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)
