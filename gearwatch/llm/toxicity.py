"""Operator 12, toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (``GRAMS``, with a mark at either end), each hashed to one of 2^``BITS``
vectors.  A word's vector is the mean of its n-grams', a text's vector the mean of its words', and a linear softmax over the
labels reads it.  Vectors and softmax are trained jointly in numpy, by gradient descent with steps scaled as
in AdaGrad.  A misspelt or inflected word that no training text holds still shares most of its n-grams.

Training takes a bounded sample: about ``SAMPLE`` labelled rows a label, those with the smallest hashed ids, whole texts.
Executors turn them into averaged bags (at most 2^``BITS`` numbers each, whatever a text's length); one task
trains on the bags and hands back the vectors.  Scoring folds vectors and softmax into one number an n-gram, so a
text's score is one pass over its words, step by step for long texts; nothing is shuffled.

Defined results: a null or empty text, or one without a word, gets the share that the softmax gives to no evidence; every
row gives one row, repeated rows included; a row without an id is neither held out nor learnt from; several labels
of one id count as the greatest, null labels as none, and of rows that share a labelled id one is learnt
from; without labels all scores are 0, with a single label value all are 0 or 1 as it says; an empty table gives an
empty result; of the documents only id and text are read, of the labels id and label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.collocations import Words, stretches
from gearwatch.llm.common import byte_column, checkpointed, map_batches

GRAMS = (3, 5)
BITS = 18
WIDTH = 8  # numbers a vector
SAMPLE = (9000, 3000)  # rows to learn from, of label 0 and of label 1
STEPS, EPOCHS = 2000, (8, 30)  # as many passes over the sample as make these steps, within these bounds
RATE, SCALE, BATCH = 0.5, 10.0, 64
_STEP = 1 << 20  # bytes of text whose n-grams are taken together: some 100 bytes each in a worker
DAMPING = 0.01  # slope squares that every vector starts with: n-grams of a few texts only learn slowly
_P = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str], grams: tuple[int, int] = GRAMS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, number of its word); words shorter than an n-gram are one n-gram with their marks."""
    marked = [f"<{w.lower()}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(marked)), sizes)
    left = ends[owner] - np.arange(len(points))
    buckets, owners, known = [], [], np.zeros(len(points), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, min(grams[1], len(points)) + 1):
            known[: len(points) - n + 1] ^= points[n - 1 :]
            known *= _P
            known ^= known >> np.uint64(29)
            if n >= grams[0]:
                at = np.flatnonzero(left >= n)
                buckets.append((known[at] * np.uint64(2 * n + 1) * _P >> np.uint64(64 - bits)).astype(np.int64))
                owners.append(owner[at])
    return np.concatenate([np.zeros(0, np.int64), *buckets]), np.concatenate([np.zeros(0, np.int64), *owners])


def _word_bags(found: Words, grams: tuple[int, int], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word, share of the word) of a stretch's vocabulary."""
    buckets, owner = subwords(found.vocabulary.to_pylist(), grams, bits)
    return buckets, owner, 1 / np.bincount(owner, minlength=len(found.vocabulary))[owner]


def _worth(found: Words, evidence: np.ndarray, grams: tuple[int, int], bits: int) -> np.ndarray:
    """Each word of a stretch's vocabulary: the mean evidence of its n-grams."""
    buckets, owner, share = _word_bags(found, grams, bits)
    return np.bincount(owner, evidence[buckets] * share, len(found.vocabulary))


def _averaged_bags(rows: DataFrame, grams: tuple[int, int], bits: int) -> DataFrame:
    """``label``, ``drawn`` and the averaged bag (``buckets``, ``shares``) of (label, drawn, text) rows."""

    def bag(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, total, parts = 0, np.zeros(0), []
        for found in stretches(data, np.array([0, len(data)]), np.zeros(1, np.int64), _STEP):
            counts = np.bincount(found.ids[: found.heads], minlength=len(found.vocabulary))
            buckets, owner, share = _word_bags(found, grams, bits)
            parts.append((buckets, share * counts[owner]))
            words += found.heads
            if len(parts) > 8:
                parts = [_added(parts)]
        buckets, total = _added(parts)
        return buckets.astype(np.int32), (total / max(words, 1)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_column(batch.column(2))
            for i, (label, drawn) in enumerate(zip(batch.column(0), batch.column(1))):
                buckets, shares = bag(data[offsets[i] : offsets[i + 1]])
                yield pa.RecordBatch.from_arrays([pa.array([label.as_py()], pa.int32()), pa.array([drawn.as_py()], pa.int64()),
                                                  pa.array([buckets.tobytes()]), pa.array([shares.tobytes()])],
                                                 ["label", "drawn", "buckets", "shares"])

    return map_batches(rows, run, "label int, drawn bigint, buckets binary, shares binary")


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0)
    buckets, place = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
    return buckets, np.bincount(place, np.concatenate([s for _, s in parts]), len(buckets))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, width: int = WIDTH,
          rate: float = RATE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, softmax weights, softmax bias) fitted to averaged bags, the same for the same bags in the same order.

    Beside the bags it holds one batch: what a batch needs is made again each time."""
    rng = np.random.default_rng(12)
    order = rng.permutation(len(bags))
    vectors = np.zeros((1 << bits, width), np.float32)  # an n-gram never seen says nothing
    weights, bias = (rng.normal(size=(width, 2)) * 0.3).astype(np.float32), np.zeros(2, np.float32)
    seen, seen_weights, seen_bias = np.full(1 << bits, DAMPING, np.float32), np.full((width, 2), 1e-8), np.full(2, 1e-8)
    places = np.zeros(1 << bits, np.int32)
    batches = [order[at : at + BATCH] for at in range(0, len(order), BATCH)]
    for _ in range(min(max(STEPS // max(len(batches), 1), EPOCHS[0]), EPOCHS[1])):
        for k in rng.permutation(len(batches)):
            part, truth = [bags[i] for i in batches[k]], labels[batches[k]]
            buckets = np.concatenate([b for b, _ in part])
            places[buckets] = -1
            used = np.flatnonzero(places)
            places[used] = np.arange(len(used))
            place, rows = places[buckets], np.repeat(np.arange(len(part)), [len(b) for b, _ in part])
            places[used] = 0
            bag = np.zeros((len(truth), len(used)), np.float32)
            bag[rows, place] = np.concatenate([s for _, s in part]) * SCALE
            rows_of = vectors[used]
            means = bag @ rows_of
            scores = means @ weights + bias
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = scores / scores.sum(axis=1, keepdims=True)
            error[np.arange(len(truth)), truth] -= 1
            slope, slope_weights, slope_bias = bag.T @ (error @ weights.T), means.T @ error, error.sum(axis=0)
            seen[used] += (slope**2).mean(axis=1)
            vectors[used] = rows_of - rate * slope / np.sqrt(seen[used])[:, None]
            seen_weights += slope_weights**2
            weights -= (rate * slope_weights / np.sqrt(seen_weights)).astype(np.float32)
            seen_bias += slope_bias**2
            bias -= (rate * slope_bias / np.sqrt(seen_bias)).astype(np.float32)
    return vectors, weights, bias


def toxicity_model(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample: tuple[int, int] = SAMPLE, grams: tuple[int, int] = GRAMS,
                   bits: int = BITS) -> dict:
    """``evidence`` (for label 1, of each n-gram) and ``bias``, with the ``vectors``, ``weights`` and ``softmax_bias`` that
    they come from; ``training`` says which rows of ``labels`` may be learnt from."""
    named = labels.where(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    named = named.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").withColumn(
        "drawn", F.xxhash64(F.col("id").cast("string"), F.lit(12)))
    named = checkpointed(named)
    counts = {r.label: r["count"] for r in named.groupBy("label").count().collect()}  # two rows
    if len(counts) < 2:
        return {"evidence": np.zeros(1 << bits, np.float32), "bias": np.inf if 1 in counts else -np.inf}
    # hashes are spread evenly: below this bound lie about as many as are wanted
    below = [int((min(sample[k] / counts[k], 1) - 0.5) * (2**64 - 1)) for k in (0, 1)]
    below = [min(x, 2**63 - 1) for x in below]
    chosen = named.where(F.col("drawn") <= F.when(F.col("label") == 0, F.lit(below[0])).otherwise(F.lit(below[1])))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(  # some 12,000 rows of two numbers
        F.min("label").alias("label"), F.min("drawn").alias("drawn"), F.min_by("text", F.xxhash64("text")).alias("text"))
    bags = _averaged_bags(rows.select("label", "drawn", "text"), grams, bits)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        truth, held = [], []
        for batch in batches:
            truth += batch.column(0).to_pylist()
            held += [(np.frombuffer(b.as_buffer(), np.int32), np.frombuffer(s.as_buffer(), np.float32))
                     for b, s in zip(batch.column(2), batch.column(3))]  # where they came: no copies
        if held:
            vectors, weights, bias = train(held, np.array(truth), bits)
            yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float32).tobytes()]) for x in (vectors, weights, bias)],
                                             ["vectors", "weights", "bias"])

    fitted = map_batches(bags.repartition(1).sortWithinPartitions("drawn"), fit, "vectors binary, weights binary, bias binary")
    row = fitted.collect()[0]  # 2^BITS vectors, some 8 MB
    weights = np.frombuffer(row.weights, np.float32).reshape(-1, 2)
    vectors, bias = np.frombuffer(row.vectors, np.float32).reshape(-1, len(weights)), np.frombuffer(row.bias, np.float32)
    return {"evidence": vectors @ (weights[:, 1] - weights[:, 0]) * np.float32(SCALE), "bias": float(bias[1] - bias[0]),
            "vectors": vectors, "weights": weights, "softmax_bias": bias}


def toxicity_scores(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
                    grams: tuple[int, int] = GRAMS) -> DataFrame:
    """id, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model["evidence"], model["bias"]))
    bits = len(model["evidence"]).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence, bias = shared.value
        for batch in batches:
            rows = batch.num_rows
            total, words = np.zeros(rows), np.zeros(rows, np.int64)
            for found in stretches(*byte_column(batch.column(1)), np.arange(rows), _STEP):
                if not len(found.ids):
                    continue
                worth = _worth(found, evidence, grams, bits)
                code = found.code[: found.heads]
                total += np.bincount(code, worth[found.ids[: found.heads]], rows)
                words += np.bincount(code, minlength=rows)
            score = 1 / (1 + np.exp(-np.clip(total / np.maximum(words, 1) + bias, -700, 700)))
            if np.isinf(bias):
                score[:] = float(bias > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             ["id", "score", "predicted"])

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
