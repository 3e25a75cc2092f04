"""Join strategy helpers: broadcast only what the planner has sized, salt hot and NULL keys otherwise."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# A broadcast side is copied to every executor: bound it by the planner's size estimate
# (file sizes of a Parquet table; exact for literal tables).
BROADCAST_MAX_BYTES = 32 << 20
# A key is hot from this share of the rows on; so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 1024
SALT_BUCKETS = 64
# A table that holds every key once per salt names the salt column after their number.
SALT_COLUMN = "salt_of_{}"
_SALT_NAME = re.compile(r"salt_of_(\d+)$")


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (planning only, no job; huge if it knows nothing)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast only if the planner sizes it at ``max_bytes`` or less.

    A frame it cannot size is not hinted; adaptive execution may still broadcast it, by the
    bytes its shuffle really wrote.  ``max_bytes=0`` asks for a shuffle join.
    """
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    if max_bytes <= 0:
        return df.hint("merge"), False
    small = planned_bytes(df) <= max_bytes
    return (F.broadcast(df) if small else df), small


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Non-NULL values of ``key`` that hold at least ``share`` of the rows of ``df``, heaviest first.

    One job: the counts are a partial (map-side) aggregate, the total is observed on the way, and
    at most ``1 / share`` keys can qualify, so the list is bounded whatever the size of ``df``.
    """
    total = Observation()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).observe(total, F.sum("n").alias("rows"))
    heaviest = counts.where(F.col(key).isNotNull()).orderBy(F.desc("n"), key).limit(int(1 / share)).collect()
    rows = (total.get.get("rows") or 0) if heaviest else 0
    return [r[0] for r in heaviest if r["n"] >= max(2, rows * share)]


def row_salt(columns: Sequence[str], buckets: int) -> Column:
    """A salt in ``[0, buckets)`` from the content of a row (NULLs count too)."""
    marks = [F.col(c).isNull() for c in columns]
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns], *marks), F.lit(buckets)).cast("int")


def with_every_salt(right: DataFrame, buckets: int) -> DataFrame:
    """Each row of ``right`` once per salt, in a column that names the number of salts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias(SALT_COLUMN.format(buckets))
    return right.select("*", salts)


def salts_of(df: DataFrame) -> int | None:
    """How many salts a table made by ``with_every_salt`` has, else None."""
    return next((int(m[1]) for c in df.columns if (m := _SALT_NAME.match(c))), None)


def salted_left_join(left: DataFrame, right: DataFrame, key: str, salt_from: Sequence[str], buckets: int,
                     hot: Sequence) -> DataFrame:
    """Left outer equi-join on ``key`` that spreads ``hot`` and NULL keys over ``buckets`` tasks.

    Left rows with such a key get a salt from a hash of ``salt_from``; right rows of a hot key are copied
    once per salt.  Every left row still meets exactly the right rows of its key (a NULL key
    none), so the result equals the plain left join.  Other keys keep salt 0 and are not copied.
    Hot rows are found with an in-set test on the bounded key list, not a join.
    """
    spread = F.col(key).isNull() | F.col(key).isin(list(hot))
    salted = left.withColumn("__salt", F.when(spread, row_salt(salt_from, buckets)).otherwise(F.lit(0)))
    copies = F.when(F.col(key).isin(list(hot)), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(right.withColumn("__salt", F.explode(copies)), [key, "__salt"], "left").drop("__salt")


def evenly_salted_left_join(left: DataFrame, right: DataFrame, key: str, salt_from: Sequence[str]) -> DataFrame:
    """Left outer equi-join with a ``right`` made by ``with_every_salt``: all rows are salted.

    Needs no look at the data beforehand, so it serves streams and bucketed tables.
    """
    salt = SALT_COLUMN.format(salts_of(right))
    salted = left.withColumn(salt, row_salt(salt_from, salts_of(right)))
    return salted.join(right, [key, salt], "left").drop(salt)


def left_join_checked(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    broadcast_max_bytes: int | None = None,
    right_is_small: bool = False,
    skew: str = "auto",
    salt_buckets: int = SALT_BUCKETS,
    hot_share: float = HOT_SHARE,
    salt_from: Sequence[str] | None = None,
) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` with the join strategy chosen by checked sizes.

    1. ``right`` sized within ``broadcast_max_bytes``, or known to be small (``right_is_small``, checked
       by the caller): broadcast hash join, no shuffle of ``left``.
    2. ``right`` made by ``with_every_salt`` (e.g. a bucketed table): all left rows are salted.
    3. Otherwise a shuffle join.  A batch input is counted by key first, and keys with at least
       ``hot_share`` of the rows, and NULL keys, are spread over ``salt_buckets`` tasks; a stream
       cannot be counted, so all its rows are salted and ``right`` is copied that often.
       ``skew="aqe"`` leaves hot partitions to AQE's skew-join split (batch only).
    """
    if skew not in ("auto", "aqe"):
        raise ValueError(f"unknown skew strategy {skew!r}")
    columns = list(salt_from) if salt_from else left.columns
    if salts_of(right) is not None:
        return evenly_salted_left_join(left, right, key, columns)
    right, small = (F.broadcast(right), True) if right_is_small else broadcast_if_small(right, broadcast_max_bytes)
    if small or (skew == "aqe" and not left.isStreaming):
        return left.join(right, key, "left")
    if left.isStreaming:
        return evenly_salted_left_join(left, with_every_salt(right, salt_buckets), key, columns)
    return salted_left_join(left, right, key, columns, salt_buckets, hot_keys(left, key, hot_share))
