"""Operator 3, exact top-k inner products by MaxScore.

A query's terms are the dimensions; a dimension's postings in a shard are the vectors' components, and
its weight is the query's component.  Measured from the end of the shard's range that the weight likes
least, every contribution is 0 or more and at most |weight| times the range: the term's score bound.  Terms
are put in order of their bounds.  The terms whose bounds together cannot lift a vector to the query's k-th best
score so far are non-essential.  Block by block of a shard, the postings of the essential terms
are traversed and summed; vectors that could still reach the threshold are probed in the other terms,
from the largest bound down, for as long as they stay competitive.  The threshold rises with every
block.  The best of each shard are merged.

Scores are integers.  64-bit floats hold them exactly as long as all sums stay below 2**53; a shard and its queries that
could exceed that are summed as 64-bit integers, beyond 2**62 as Python's.  Shards have about
``SHARD`` vectors and meet at most ``QUERIES`` queries at a time; both are dealt by hashed ids.

Defined results: a vector that is null, or holds a null or non-finite component, takes no part, as query
or candidate; so does a row without an id.  Components that a shorter vector lacks count as 0.  Rows that share an
id are candidates each (never for the query of that id), and one query, with the smallest of their vectors.  A query finds all candidates if there
are fewer than k; an empty table gives an empty result; other columns are neither read nor returned.  What does not fit a
long (a scaled component, a score) is given as the nearest long.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearwatch.llm.common import ship_package

SHARD = 1 << 15
QUERIES = 1 << 13
_BLOCK = 2048


def maxscore(query: np.ndarray, ranges: tuple[np.ndarray, np.ndarray], blocks: list[tuple[np.ndarray, np.ndarray]],
             k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the ``k`` best candidates of a shard, ties to smaller ids.

    ``blocks`` holds (ids, postings), postings[term] being the term's components of those vectors.
    """
    low, high = ranges
    least = np.where(query >= 0, low, high)  # contributions are measured from here
    bounds = np.abs(query) * (high - low)
    order = np.argsort(-bounds, kind="stable")  # the terms, largest bound first
    order = order[bounds[order] > 0]
    rest = np.zeros(len(order) + 1, query.dtype)  # what the terms from here on add at most
    rest[:-1] = np.cumsum(bounds[order][::-1])[::-1]
    base = query @ least
    ids, scores, threshold = np.zeros(0, np.int64), np.zeros(0, query.dtype), None
    for block_ids, postings in blocks:
        needed = 0 if threshold is None else threshold - base
        essential = int(np.searchsorted(-rest, -needed, side="right")) if needed > 0 else 0
        # without its first ``essential`` terms no vector gets there: they are traversed, the others are probed
        essential = max(min(essential, len(order)), min(1, len(order)))
        terms = order[:essential]
        found = query[terms] @ (postings[terms] - least[terms, None]) if len(terms) else np.zeros(len(block_ids), query.dtype)
        at = np.flatnonzero((found + rest[essential] >= needed) & (block_ids != own))
        found = found[at]
        for n in range(essential, len(order), 8):
            if not len(at):
                break
            terms = order[n : n + 8]
            found = found + query[terms] @ (postings[np.ix_(terms, at)] - least[terms, None])
            near = found + rest[min(n + 8, len(order))] >= needed
            at, found = at[near], found[near]
        if len(at):
            ids, scores = np.append(ids, block_ids[at]), np.append(scores, found + base)
            best = np.argsort(ids, kind="stable")
            best = best[np.argsort(-scores[best], kind="stable")][:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                threshold = scores[-1]
    return ids, scores


def _matrix(vectors: pd.Series, width: int, kind: type) -> np.ndarray:
    out = np.zeros((len(vectors), width), kind)
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


def quantised(vector: Column, scale: int = 1024) -> Column:
    """Components as floor(scale * x); null unless the vector is whole and finite."""
    floats = F.transform(vector, lambda x: x.cast("double"))
    usable = vector.isNotNull() & F.forall(
        floats, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(usable, F.transform(floats, lambda x: F.floor(x * scale)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` best other vectors.

    ``is_query`` chooses the queries by the id, under the name ``vec_id``.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col)).alias("v"))
    rows = rows.where("vec_id is not null and v is not null")
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(math.ceil(total / shard), min(2 * cores, math.ceil(total / _BLOCK)), 1)
    groups = max(math.ceil(asked / queries), 1)

    def dealt(own: Column, every: int, names: tuple[str, str]) -> list[Column | str]:
        """A row's own group, and all groups of the other kind that it has to meet."""
        return [own.cast("int").alias(names[0]), F.explode(F.sequence(F.lit(0), F.lit(every - 1))).alias(names[1]),
                "vec_id", "v"]

    candidates = rows.select(*dealt(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)), groups, ("shard", "part")))
    asked_rows = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).select(
        *dealt(F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(groups)), shards, ("part", "shard")))

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            width = max(max(map(len, left.v)), max(map(len, right.v)))
            left = left.sort_values("vec_id")
            ids = left.vec_id.to_numpy()
            most = [max(abs(int(side(x))) for x in v if len(x) for side in (np.min, np.max)) if v.map(len).any() else 0
                    for v in (left.v, right.v)]
            sums = 4 * width * most[0] * most[1]  # no sum or bound below exceeds it
            kind = np.float64 if sums < 2**53 else np.int64 if sums < 2**62 else object
            asking, postings = _matrix(right.v, width, kind), np.ascontiguousarray(_matrix(left.v, width, kind).T)
            ranges = postings.min(axis=1), postings.max(axis=1)
            blocks = [(ids[i : i + _BLOCK], np.ascontiguousarray(postings[:, i : i + _BLOCK]))
                      for i in range(0, len(ids), _BLOCK)]
            for own, query in zip(right.vec_id.tolist(), asking):
                found, scores = maxscore(query, ranges, blocks, k, own)
                if kind is object:
                    scores = np.array([min(max(x, -2**63), 2**63 - 1) for x in scores], object)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    ship_package(vectors.sparkSession)
    best = candidates.groupBy("shard", "part").cogroup(asked_rows.groupBy("shard", "part")).applyInPandas(
        search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
