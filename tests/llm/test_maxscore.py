"""Operator 3 against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearwatch.llm import maxscore, queries
from gearwatch.llm.maxscore import top_k
from tests.llm.helpers import SF


def brute(rows, k):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in usable:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, a in asked.items():
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in usable if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def check(df, rows, k=10):
    assert sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, k)


def test_op3_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op3_maxscore(spark, SF), rows)


@pytest.mark.parametrize("shard, asked, block", [(1 << 15, 1 << 13, 2048), (40, 3, 16)])
def test_ties_nulls_and_repeats(spark, monkeypatch, shard, asked, block):
    monkeypatch.setattr(maxscore, "_BLOCK", block)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.25]) for _ in range(6)]) for i in range(0, 900, 4)]
    rows += [rows[0], rows[1], (100, [9.0] * 6), (1001, None), (1002, [None] * 6), (1003, [math.nan] * 6),
             (1100, [math.inf] * 6), (None, [1.0] * 6), (1200, [1.0]), (1300, [])]
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                    "vec_id bigint, embedding array<float>, v string, shard int")
    check(top_k(vectors, F.col("vec_id") % 100 == 0, 10, shard=shard, queries=asked), rows)
    assert top_k(vectors.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    few = vectors.where("vec_id in (100, 104)")
    check(top_k(few, F.col("vec_id") % 100 == 0), [(r.vec_id, r.embedding) for r in few.collect()])


def test_bounds_spare_work(spark):
    """Terms of little weight are probed only for candidates that compete."""
    rng = np.random.default_rng(3)
    data = np.floor(rng.normal(0, 1, (4000, 32)) * np.geomspace(300, 1, 32))
    ids = np.arange(4000)
    blocks = [(ids[i:i + 500], np.ascontiguousarray(data[i:i + 500].T)) for i in range(0, 4000, 500)]
    ranges = data.min(axis=0), data.max(axis=0)
    for q in range(20):
        found, scores = maxscore.maxscore(data[q], ranges, blocks, 10, q)
        exact = data @ data[q]
        best = [i for i in np.lexsort((ids, -exact)) if i != q][:10]
        assert found.tolist() == best and scores.tolist() == exact[best].tolist()


@pytest.mark.parametrize("large", [1e9, 1e11, 3e12])
def test_large_components_are_exact(spark, large):
    """Sums past 2^53 and past 2^62 beside small ones; scores that fit a long are exact."""
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(301, [large, 0.0, 1.0, 0.0, 0.0, -1.0]), (302, [-large, 0.0, 0.0, 0.0, 0.0, 0.5]), (303, [0.1] * 6)]
    check(top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0), rows)


def test_scores_past_a_long_are_the_nearest_long(spark):
    rows = [(0, [1e12]), (1, [1e12]), (2, [-1e12]), (3, [2e12])]
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()
    assert {r.vec_id: r.score for r in found} == {1: 2**63 - 1, 3: 2**63 - 1, 2: -2**63}
