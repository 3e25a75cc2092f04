"""Operator 12: bags against words counted one by one, held-out accuracy, unseen misspellings."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearwatch.llm import collocations, queries, toxicity
from gearwatch.llm.toxicity import subwords, toxicity_model, toxicity_scores, train
from tests.llm.helpers import empty_documents, odd_documents

SF01 = "/root/testdata/sf0.1"
INSULTS = ["idiot", "moron", "worthless", "scoundrel"]
LABELS = "doc_id long, toxic int"
DOCS = "doc_id long, text string"


def prose(n, seed=0, size=60):
    """(id, text, label): every third text holds two insults."""
    rng = random.Random(seed)
    plain = ["".join(rng.choices(["ba", "ke", "li", "mon", "tu", "ra", "so"], k=rng.randint(1, 4))) for _ in range(300)]
    out = []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, size))
        if i % 3 == 0:
            words[:2] = rng.choices(INSULTS, k=2)
            rng.shuffle(words)
        out.append((i, " ".join(words), int(i % 3 == 0)))
    return out


def grams_by_hand(word):
    marked = f"<{word.lower()}>"
    return [marked[i:i + n] for n in range(3, 6) for i in range(len(marked) - n + 1)]


def test_subwords_are_the_marked_words_ngrams():
    words = ["a", "Idiot", "ÀÉ", "日本語", "idiots", "👩‍👧"]
    buckets, owner = subwords(words)
    by_gram = {}
    for k, word in enumerate(words):
        own = buckets[owner == k].tolist()
        assert len(own) == len(grams_by_hand(word))
        # grams of one length in order of place
        for bucket, gram in zip(own, grams_by_hand(word)):
            assert by_gram.setdefault(gram, bucket) == bucket
    assert len(set(by_gram.values())) == len(by_gram)
    assert all(len(x) == 0 for x in subwords([]))


def test_score_is_the_mean_of_words_means(spark):
    rng = np.random.default_rng(0)
    model = {"evidence": rng.normal(size=1 << 18).astype(np.float32) * 9, "bias": -0.5}
    texts = ["one two. two three", "A", "", None, "Straße idiot,idiot\tx", " . "]
    found = toxicity_scores(spark.createDataFrame(list(enumerate(texts)), DOCS), model).orderBy("doc_id").collect()
    for row, text in zip(found, texts):
        words = Counter(re.findall(r"[^\x20\x09.,;:!?\n-\r]+", text or ""))
        total = sum(c * model["evidence"][subwords([w])[0]].mean() for w, c in words.items())
        expected = 1 / (1 + np.exp(-(total / max(sum(words.values()), 1) - 0.5)))
        assert row.score == pytest.approx(expected, abs=1e-6) and row.predicted == int(row.score >= 0.3)


def test_long_texts_step_by_step(spark, monkeypatch):
    """Cut anywhere, a text has the same score."""
    model = {"evidence": np.random.default_rng(1).normal(size=1 << 18).astype(np.float32) * 9, "bias": 0.1}
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcde.", k=rng.randint(1, 8))) for _ in range(2000))
    batch = toxicity.pa.RecordBatch.from_arrays([toxicity.pa.array([1, 2, 3]), toxicity.pa.array(["x", text, "y z"])], ["id", "text"])
    scored = []
    for step in (1 << 20, 300):
        monkeypatch.setattr(collocations, "_STEP", step)
        total, words = np.zeros(3), np.zeros(3)
        for found in collocations.stretches(*toxicity.byte_column(batch.column(1)), np.arange(3)):
            buckets, owner, share = toxicity._word_bags(found, (3, 5), 18)
            worth = np.bincount(owner, model["evidence"][buckets] * share, len(found.vocabulary))
            total += np.bincount(found.code[:found.heads], worth[found.ids[:found.heads]], 3)
            words += np.bincount(found.code[:found.heads], minlength=3)
        scored.append(total / words)
    assert np.allclose(*scored)


def peak_mb(task):
    tracemalloc.start()
    try:
        task()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_scoring_holds_a_step_of_a_batch(spark, monkeypatch):
    """A batch of 12 MB, hardly a word twice."""
    runs = []
    monkeypatch.setattr(toxicity, "map_batches", lambda source, run, schema: runs.append(run) or source)
    toxicity_scores(spark.createDataFrame([], DOCS), {"evidence": np.ones(1 << 18, np.float32), "bias": 0.0})
    texts = [" ".join(f"{i * 200 + k:08d}" for k in range(200)) for i in range(6500)]
    batch = toxicity.pa.RecordBatch.from_arrays([toxicity.pa.array(range(6500)), toxicity.pa.array(texts)], ["id", "text"])
    found = []
    assert peak_mb(lambda: found.extend(runs[0](iter([batch])))) < 250
    assert [b.num_rows for b in found] == [6500]


def test_training_holds_the_bags_once():
    rng = np.random.default_rng(4)
    bags = [(np.sort(rng.permutation(4096)[:3000]).astype(np.int32), np.full(3000, 1 / 3000, np.float32)) for _ in range(960)]
    size = sum(b.nbytes + s.nbytes for b, s in bags) / 1e6
    assert peak_mb(lambda: train(bags, np.arange(960) % 2, bits=12)) < size / 2


def test_unseen_misspellings_and_inflections(spark):
    rows = prose(600)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], LABELS)
    model = toxicity_model(docs, labels, F.lit(True))
    clean = [text for _, text, t in prose(90, seed=0) if not t][:40]
    tries = ["idiott", "idioot", "idiots", "moronic", "worthles", "worthlesss", "scoundrels", "xscoundrel"]
    texts = clean + [f"{w} {v} {c}" for w, v, c in zip(tries, tries[1:] + tries[:1], clean)]  # two, as in training
    found = toxicity_scores(spark.createDataFrame(list(enumerate(texts)), DOCS), model).orderBy("doc_id").collect()
    assert sum(r.predicted for r in found[:40]) <= 1
    assert sum(r.predicted for r in found[40:]) >= 7


def test_held_out_accuracy_of_the_query(spark):
    found = queries.op12_toxicity(spark, SF01)
    assert found.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    told = found.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in told)
    toxic, clean = ([r.predicted for r in told if r.toxic == k] for k in (1, 0))
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.06


def test_held_out_labels_are_not_learnt(spark):
    """Labels of the held-out fold turned round: every score stays."""
    rows = prose(300)
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], LABELS)
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity_model(docs, x, ~held)["evidence"] for x in (labels, turned))
    assert np.array_equal(one, two)


def test_training_is_joint():
    rng = random.Random(2)
    bags = []
    for i in range(200):
        used = np.unique(np.array([rng.randrange(50) for _ in range(10)] + [60 if i % 2 else 61]))
        bags.append((used.astype(np.int32), np.full(len(used), 1 / len(used), np.float32)))
    vectors, weights, bias = train(bags, np.arange(200) % 2, bits=6)
    worth = vectors @ (weights[:, 1] - weights[:, 0])
    assert worth[60] > 2 * abs(worth[:50]).max() and worth[61] < -2 * abs(worth[:50]).max()
    assert not vectors[62].any() and np.abs(vectors[60]).max() > 0 and len(bias) == 2


def test_odd_rows_labels_and_clashing_columns(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(2, 0), (9, 0), (9, 1), (5, 1), (9, None), (None, 1), (999, 1), (10, 0), (10, 0)], LABELS)
    model = toxicity_model(docs, labels, F.lit(True))
    found = toxicity_scores(docs.selectExpr("*", "1 AS score", "2 AS predicted"), model)
    assert found.columns == ["doc_id", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {}
    for r in rows:
        assert by_id.setdefault(r.doc_id, r.score) == r.score


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0), ([(1, None)], 0.0)])
def test_too_few_labels(spark, labels, score):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], DOCS)
    model = toxicity_model(docs, spark.createDataFrame(labels, LABELS), F.lit(True))
    assert [r.score for r in toxicity_scores(docs, model).collect()] == [score] * 2


def test_one_id_on_a_third_of_all_rows(spark):
    rows = prose(300)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(7, "same id other text")] * 150, DOCS)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], LABELS)
    model = toxicity_model(docs, labels, F.lit(True))
    assert toxicity_scores(docs, model).count() == 450


def test_empty(spark):
    docs = empty_documents(spark)
    model = toxicity_model(docs, spark.createDataFrame([], LABELS), F.lit(True))
    assert toxicity_scores(docs, model).collect() == []
