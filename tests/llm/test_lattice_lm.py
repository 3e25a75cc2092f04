"""Operator 8 against enumerated segmentations and counts by hand."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gearwatch.llm import lattice_lm, queries
from gearwatch.llm.lattice_lm import Pieces, fit_pieces, lattice_scores, vocabulary, word_table, words_of
from tests.llm.helpers import SF, empty_documents, odd_documents, random_texts, texts_by_id

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def toy():
    strings = ["▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb", "é"]
    p = np.linspace(1, 2, len(strings) + 256)
    return Pieces(strings + [""] * 256, list(range(len(strings), len(strings) + 256)), np.log(p / p.sum()))


def segmentations(pieces, word):
    """All ways to spell a word, as lists of piece numbers."""
    if not word:
        yield []
        return
    for number, piece in enumerate(pieces.pieces):
        if piece and word.startswith(piece):
            for rest in segmentations(pieces, word[len(piece):]):
                yield [number, *rest]
    if word[0] not in pieces.pieces:
        for rest in segmentations(pieces, word[1:]):
            yield [*(int(pieces.byte_pieces[b]) for b in word[0].encode()), *rest]


@settings(max_examples=150, deadline=None)
@given(words=st.lists(st.text("abéx▁", max_size=9), min_size=1, max_size=6), long=st.sampled_from([2, 512]))
def test_lattice_sums_all_segmentations(words, long):
    kept, lattice_lm._LONG = lattice_lm._LONG, long
    try:
        pieces, words = toy(), ["▁" + w for w in words]
        logp, lattice = pieces.initial, pieces.lattice(words)
        found, counts = lattice.log_probabilities(logp), np.arange(1, len(words) + 1)
        expected = np.zeros(len(logp))
        for word, value, count in zip(words, found, counts):
            ways = [(math.exp(logp[w].sum()), w) for w in segmentations(pieces, word)]
            total = sum(p for p, _ in ways)
            assert value == pytest.approx(math.log(total), abs=1e-9)
            for p, way in ways:
                np.add.at(expected, way, count * p / total)
        assert lattice.expected_counts(logp, counts) == pytest.approx(expected, abs=1e-9)
    finally:
        lattice_lm._LONG = kept


def test_vocabulary():
    pieces = vocabulary(MODEL)
    assert len(pieces.byte_pieces) == 256 and np.exp(pieces.initial).sum() == pytest.approx(1)
    the = pieces.lattice(["▁the", "▁☃", "▁" + "é" * 2000])
    assert np.isfinite(the.log_probabilities(pieces.initial)).all()
    assert the.log_probabilities(pieces.initial)[0] >= pieces.initial[pieces.pieces.index("▁the")]


def brute_base(rows, fold):
    """{id: (n_tokens, n_known, N, base)} by the contract."""
    counts = Counter()
    for i, text in rows:
        if i is not None and zlib.crc32(str(i).encode()) % fold != 2:
            counts.update(words_of(text) + [None])
    total, distinct = sum(counts.values()), len(counts)
    for i, text in rows:
        tokens = words_of(text) + [None]
        yield (i, text), (len(tokens), sum(counts[t] > 0 for t in tokens), total,
                          sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens))


def check(df, docs, fold=7):
    rows = df.collect()
    want = [(i, *w) for (i, _), w in brute_base(texts_by_id(docs), fold)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, sorted(want, key=key)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % fold == 2)
    return {r.doc_id: r for r in rows}


def test_op8_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = check(queries.op8_lattice_lm(spark, SF), docs)
    # the model's score, from its own weights and each word's lattice
    crc = F.crc32(F.col("doc_id").cast("string")) % 7
    words = word_table(docs, crc != 2, "text").cache()
    n = docs.where(crc != 2).count()
    logp, end = fit_pieces(words, n, MODEL)
    assert np.exp(logp).sum() + math.exp(end) == pytest.approx(1)
    for i, text in texts_by_id(docs)[:40]:
        spelled = ["▁" + w.decode() for w in words_of(text)]
        want = (vocabulary(MODEL).lattice(spelled).log_probabilities(logp).sum() if spelled else 0) + end
        assert found[i].score == pytest.approx(want / math.log(10), rel=1e-6)
    # fitted weights explain held-out text better than the vocabulary's own scores
    held = [["▁" + w.decode() for w in words_of(t)] for i, t in texts_by_id(docs) if zlib.crc32(str(i).encode()) % 7 == 2]
    held = [w for w in held if w]
    pieces = vocabulary(MODEL)
    gain = sum(pieces.lattice(w).log_probabilities(logp).sum() - pieces.lattice(w).log_probabilities(pieces.initial).sum() for w in held)
    assert gain > 0


@pytest.mark.parametrize("hot", [0, 5, 300_000])
def test_rare_and_hot_words_agree(spark, hot):
    docs = odd_documents(spark, random_texts(60, 4) + ["z" * 1500])
    crc = F.crc32(F.col("doc_id").cast("string")) % 7
    found = check(lattice_scores(docs, crc != 2, crc == 2, MODEL, hot_words=hot), docs)
    scores = {i: r.score for i, r in found.items()}
    assert all(math.isfinite(s) and s < 0 for s in scores.values())
    _SEEN.append(scores)
    assert scores == pytest.approx(_SEEN[0], rel=1e-9)


_SEEN = []


def test_long_and_held_out_words_in_every_row(spark):
    """Frequent words are looked up whatever their length and wherever they occur; only the others are joined."""
    long, unseen = "é" * 100, "held" * 40
    texts = [f"{long} a{i % 7} {long}" + (f" {unseen} {unseen}" if zlib.crc32(str(i).encode()) % 7 == 2 else "") for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    crc = F.crc32(F.col("doc_id").cast("string")) % 7
    scores = []
    for hot in (0, 3, 300_000):
        found = check(lattice_scores(docs, crc != 2, crc == 2, MODEL, hot_words=hot), docs)
        scores.append({i: r.score for i, r in found.items()})
    assert scores[0] == pytest.approx(scores[1], rel=1e-9) and scores[0] == pytest.approx(scores[2], rel=1e-9)
    counted = {bytes(r.word).decode(): (r.c, r.n) for r in word_table(docs, crc != 2, "text").collect()}
    assert counted[unseen] == (0, sum(t.count(unseen) for t in texts)) and counted[long][1] == 400


def test_vocabulary_and_training_both_move_the_weights(spark):
    pieces = vocabulary(MODEL)
    the, other = pieces.pieces.index("▁the"), pieces.pieces.index("▁world")

    def fitted(c, **options):
        words = spark.createDataFrame([(b"the", c, c), (b"world", 10, 10)], "word binary, c bigint, n bigint")
        logp, end = fit_pieces(words, 5, MODEL, **options)
        assert np.exp(logp).sum() + math.exp(end) == pytest.approx(1) and np.isfinite(logp).all()
        return logp

    assert fitted(1000)[the] > fitted(10)[the]  # more of it in the training documents
    weak, strong = fitted(1000, prior=0.01), fitted(1000, prior=10.0)
    unseen = np.ones(len(weak), bool)
    unseen[[the, other]] = False
    assert weak[the] > strong[the] and strong[unseen].mean() > weak[unseen].mean()
    # the prior keeps its share at any size, and what is not trained on keeps the vocabulary's order
    large = fitted(10_000_000, prior=0.1)
    rest = np.setdiff1d(np.flatnonzero(unseen), [n for _, ns in pieces.lattice(["▁the", "▁world"]).edges for n in ns])
    assert (np.exp(large[rest]).sum() / np.exp(pieces.initial[rest]).sum()) == pytest.approx(0.1 / 1.1, rel=0.01)
    assert np.allclose(np.diff(large[rest]), np.diff(pieces.initial[rest]))
    # nothing to learn from: the vocabulary's own scores
    nothing = fit_pieces(spark.createDataFrame([], "word binary, c bigint, n bigint"), 0, MODEL)[0]
    assert np.allclose(nothing - pieces.initial, (nothing - pieces.initial)[0])


def test_empty_tables(spark):
    docs = empty_documents(spark)
    assert lattice_scores(docs, F.lit(True), F.lit(False), MODEL).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    row = lattice_scores(docs, F.lit(False), F.lit(True), MODEL).first()  # nothing to learn from
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)
