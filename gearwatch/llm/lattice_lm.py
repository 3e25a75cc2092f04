"""Operator 8, subword-lattice likelihood of whole texts.

The model is a unigram model over the pieces of an existing vocabulary and one end piece: a text is made by
drawing pieces until the end piece comes.  A word (with its word mark) spans a lattice of all its
segmentations into pieces, and its probability is the sum over them, by the forward recursion in log
space.  Pieces do not span words, so a text's probability is the product over its words and the end.
A character that is no piece is spelled by its UTF-8 byte pieces.

The pieces' weights are the vocabulary's own scores (its ranks, as a Zipf law), brought up to date by the
training documents in ``ROUNDS`` rounds of expectation maximisation: each distinct training word, weighted by
its count, gives its pieces' expected counts (forward and backward over the same lattice).  In every round
the vocabulary's scores are the prior of these counts: they stand for ``PRIOR`` further pieces for each
piece expected, and for one if there is nothing to learn from, at any size of the corpus.  The base score is an
add-one unigram model over whole words.

How it runs: words are counted by one shuffle into a table that grows with the corpus.  The most
frequent words of all documents, held-out ones too, at most ``HOT_WORDS``, are broadcast with their scores (words of
more than ``HOT_BYTES`` bytes by their SHA-256, so the table is bounded); the other words of a document, few and
none of them frequent, are joined to the table by word, and added up by document.  Rows of one
document only meet as partial sums.  Lattices are evaluated once for each distinct word, many in step.

Defined results: a null text counts as empty (one token, the end); every input row gives one row; a
row without an id is neither trained on nor held out; with no training rows N and V are 0; an empty
table gives an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import checkpointed, map_batches, text_chunks, worker_state

HOT_WORDS = 300_000
HOT_BYTES = 64
ROUNDS = 2
MARK = "▁"
PRIOR = 0.1  # weight of the vocabulary's scores, in expected pieces
_PSEUDO = 0.1  # added to the count of ends
_BATCH_CHARS = 1 << 18
_LONG = 512  # longer words are taken one by one
_FLUSH = 200_000  # distinct words that a worker counts before it passes them on


class Pieces:
    """The vocabulary: piece numbers by string, and the lattice of words over it."""

    def __init__(self, pieces: list[str], byte_pieces: list[int], initial: np.ndarray):
        self.pieces, self.byte_pieces, self.initial = pieces, np.array(byte_pieces), initial
        prefixes: list[dict[str, int]] = []  # by length: prefix -> piece number, -1 if it only begins one
        for number, piece in enumerate(pieces):
            for size in range(1, len(piece) + 1):
                if len(prefixes) < size:
                    prefixes.append({})
                if size < len(piece):
                    prefixes[size - 1].setdefault(piece[:size], -1)
                else:
                    prefixes[size - 1][piece] = number
        self.longest = len(prefixes)
        self.known = []
        for table in prefixes:
            hashes = self._hashes(list(table))
            order = np.argsort(hashes)
            if len(np.unique(hashes)) != len(hashes):
                raise ValueError("two pieces have one hash")
            self.known.append((hashes[order], np.array(list(table.values()))[order]))

    @staticmethod
    def load(model_path: str) -> "Pieces":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces, scores, single = [], [], {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                single[int(model.id_to_piece(i)[3:5], 16)] = len(pieces)
                pieces.append("")  # never found as a string
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces.append(model.id_to_piece(i))
            else:
                continue
            scores.append(model.get_score(i))
        # scores are ranks below zero; pieces without one come last
        rank = np.array([-s if -1e8 < s < 0 else len(pieces) for s in scores])
        weights = 1 / (rank + 2.7)
        return Pieces(pieces, [single[b] for b in range(256)], np.log(weights / weights.sum()))

    @staticmethod
    def _hashes(strings: list[str]) -> np.ndarray:
        out = np.zeros(len(strings), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(max(map(len, strings), default=0)):
                here = np.array([k < len(s) for s in strings])
                code = np.array([ord(s[k]) if k < len(s) else 0 for s in strings], np.uint64)
                out = np.where(here, (out + code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), out)
        return out

    def lattice(self, words: list[str]) -> "Lattice":
        return Lattice(self, words)


class Lattice:
    """All places where pieces fit into ``words`` (their marks included), longest word first."""

    def __init__(self, vocabulary: Pieces, words: list[str]):
        self.vocabulary = vocabulary
        self.order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        words = [words[i] for i in self.order]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(codes))  # characters to the word's end
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []  # by length: (first character, piece)
        at, hashes = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        single = np.zeros(len(codes), bool)
        with np.errstate(over="ignore"):
            for size, (known, numbers) in enumerate(vocabulary.known, 1):
                fits = left[at] >= size
                at, hashes = at[fits], hashes[fits]
                if not len(at):
                    break
                hashes = (hashes + codes[at + size - 1] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                found = known[place] == hashes
                at, hashes, number = at[found], hashes[found], numbers[place[found]]
                whole = number >= 0
                self.edges.append((at[whole], number[whole]))
                if size == 1:
                    single[at[whole]] = True
        self.spelled = np.flatnonzero(~single)  # characters that only bytes spell
        spelled = [list(chr(int(codes[i])).encode("utf-8", "surrogatepass")) for i in self.spelled]
        self.spelled_by = [vocabulary.byte_pieces[b] for b in spelled]
        self.width = len(codes)

    def weights(self, logp: np.ndarray) -> list[np.ndarray]:
        """By piece length: the log weight of the edge that begins at each character (-inf: none)."""
        out = []
        for at, number in self.edges:
            row = np.full(self.width, -np.inf)
            row[at] = logp[number]
            out.append(row)
        if len(self.spelled):
            out[:] = out or [np.full(self.width, -np.inf)]
            out[0][self.spelled] = [logp[x].sum() for x in self.spelled_by]
        return out

    def forward(self, weights: list[np.ndarray], backward: bool = False) -> np.ndarray:
        """Log sums over all ways from each word's front to each node (or from each node to its end).

        Node ``k`` of word ``w`` has number ``starts[w] + w + k``.
        """
        nodes = np.full(self.width + len(self.sizes), -np.inf)
        base, sizes = self.starts + np.arange(len(self.sizes)), self.sizes
        first = base + sizes if backward else base
        nodes[first] = 0.0
        alone = int(np.searchsorted(-sizes, -_LONG, side="left"))  # so many words are longer
        for w in range(alone):
            self._one(nodes, weights, w, backward)
        base, sizes, starts, first = base[alone:], sizes[alone:], self.starts[alone:], first[alone:]
        active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
        for step, n in enumerate(active.tolist(), 1):
            terms = np.full((min(step, len(weights)), n), -np.inf)
            for size in range(1, len(terms) + 1):
                if backward:  # from node (size of word - step), an edge of ``size`` characters onwards
                    place = sizes[:n] - step
                    terms[size - 1] = nodes[first[:n] - step + size] + weights[size - 1][starts[:n] + place]
                else:
                    terms[size - 1] = nodes[first[:n] + step - size] + weights[size - 1][starts[:n] + step - size]
            top = terms.max(axis=0)
            total = top + np.log(np.exp(terms - top).sum(axis=0))
            nodes[first[:n] - step if backward else first[:n] + step] = total
        return nodes

    def _one(self, nodes: np.ndarray, weights: list[np.ndarray], w: int, backward: bool) -> None:
        n, start = int(self.sizes[w]), int(self.starts[w])
        rows = [row[start : start + n].tolist() for row in weights]
        sums = [0.0] * (n + 1)
        for step in range(1, n + 1):
            terms = []
            for size in range(1, min(step, len(rows)) + 1):
                weight = rows[size - 1][n - step if backward else step - size]
                if weight > -math.inf:
                    terms.append(weight + sums[step - size])
            top = max(terms)
            sums[step] = top + math.log(sum(math.exp(t - top) for t in terms))
        base = start + w
        nodes[base : base + n + 1] = sums[::-1] if backward else sums

    def log_probabilities(self, logp: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's marginal probability, in the words' given order."""
        out = np.zeros(len(self.sizes))
        nodes = self.forward(self.weights(logp))
        out[self.order] = nodes[self.starts + np.arange(len(self.sizes)) + self.sizes]
        return out

    def expected_counts(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations of all words, ``counts`` times each."""
        weights = self.weights(logp)
        front, back = self.forward(weights), self.forward(weights, backward=True)
        word = np.repeat(np.arange(len(self.sizes)), self.sizes)
        total = front[self.starts + np.arange(len(self.sizes)) + self.sizes]
        times = np.asarray(counts, float)[self.order]
        out = np.zeros(len(logp))

        def used(at: np.ndarray, size: int) -> np.ndarray:
            w = word[at]
            return np.exp(front[at + w] + weights[size - 1][at] + back[at + w + size] - total[w]) * times[w]

        for size, (at, number) in enumerate(self.edges, 1):
            out += np.bincount(number, used(at, size), len(out))
        for share, numbers in zip(used(self.spelled, 1) if len(self.spelled) else (), self.spelled_by):
            np.add.at(out, numbers, share)
        return out


def vocabulary(model_path: str) -> Pieces:
    return worker_state((Pieces, model_path), lambda: Pieces.load(model_path))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _lattices(pieces: Pieces, words: list[bytes]) -> Iterator[tuple[slice, Lattice]]:
    """Lattices of bounded size, and which words each is of."""
    marked, begun, size = [], 0, 0
    for i, word in enumerate(words):
        marked.append(MARK + word.decode("utf-8", "surrogatepass"))
        size += len(marked[-1])
        if size >= _BATCH_CHARS or i + 1 == len(words):
            yield slice(begun, i + 1), pieces.lattice(marked)
            marked, begun, size = [], i + 1, 0


def word_table(docs: DataFrame, training: Column, text_col: str) -> DataFrame:
    """``word`` (bytes) of all documents, ``c``, its count in the training ones, and ``n``, that in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        untrained: Counter[bytes] = Counter()
        for flags, texts in text_chunks(batches, 1 << 20):
            found: list[bytes] = []
            for flag, text in zip(flags.to_pylist(), texts):
                words = words_of(text)
                found += words
                if not flag:
                    untrained.update(words)
            counts.update(found)
            if len(counts) >= _FLUSH:
                yield _counted(counts, untrained)
                counts, untrained = Counter(), Counter()
        if counts:
            yield _counted(counts, untrained)

    flagged = docs.select(F.coalesce(training, F.lit(False)), F.col(text_col))
    counted = map_batches(flagged, run, "word binary, c bigint, n bigint", keeps=True)
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _counted(counts: Counter, untrained: Counter) -> pa.RecordBatch:
    n = np.fromiter(counts.values(), np.int64, len(counts))
    c = n - np.fromiter(map(untrained.get, counts, repeat(0)), np.int64, len(counts))
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(c), pa.array(n)], ["word", "c", "n"])


def fit_pieces(words: DataFrame, documents: int, model_path: str, rounds: int = ROUNDS,
               prior: float = PRIOR) -> tuple[np.ndarray, float]:
    """(natural log weight of each piece, that of the end) of the vocabulary's scores, as a prior of the strength
    ``prior``, and ``words`` with their counts ``c``."""
    spark, pieces = words.sparkSession, vocabulary(model_path)
    logp, end = pieces.initial, math.log(0.01)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(logp)  # one number a piece

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = vocabulary(model_path), 0
            for batch in batches:
                counts = batch.column(1).to_numpy()
                for part, lattice in _lattices(own, batch.column(0).to_pylist()):
                    total = total + lattice.expected_counts(shared.value, counts[part])
            if not np.isscalar(total):
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["piece", "n"])

        expected = map_batches(words.where("c > 0"), expect, "piece int, n double", keeps=True).groupBy("piece").agg(F.sum("n").alias("n"))
        n = np.zeros(len(pieces.pieces))
        for row in expected.collect():  # at most the vocabulary
            n[row.piece] += row.n
        n += (prior * n.sum() + 1) * np.exp(pieces.initial)
        total = n.sum() + documents + _PSEUDO
        logp, end = np.log(n / total), math.log((documents + _PSEUDO) / total)
        shared.unpersist()
    return logp, end


def _scored(words: DataFrame, logp: np.ndarray, model_path: str) -> DataFrame:
    """``words`` with ``lattice``, the log10 probability of each."""
    shared = words.sparkSession.sparkContext.broadcast(logp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model_path)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for part, lattice in _lattices(own, batch.column(0).to_pylist()):
                scores[part] = lattice.log_probabilities(shared.value) / math.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], ["word", "c", "lattice"])

    return map_batches(words.select("word", "c"), run, "word binary, c bigint, lattice double", keeps=True)


def _frequency_class(c: Column) -> Column:
    """Counts by steps of a twentieth: their classes are few at any size."""
    return F.floor(F.log(c.cast("double")) / math.log(1.05))


def _hot_class(words: DataFrame, most: int) -> int:
    """The least frequency class from which on there are at most ``most`` words."""
    classes = words.groupBy(_frequency_class(F.col("n")).alias("k")).count().orderBy(F.desc("k")).collect()
    total, last = 0, (classes[0].k if classes else 0) + 1
    for row in classes:
        total += row["count"]
        if total > most:
            break
        last = row.k
    return last


_PARTS = "word binary, id bigint, tie bigint, times bigint, copies bigint, n_tokens bigint, n_known bigint, base double, lattice double"


def lattice_scores(docs: DataFrame, training: Column, held_out: Column, model_path: str, id_col: str = "doc_id",
                   text_col: str = "text", hot_words: int = HOT_WORDS) -> DataFrame:
    """id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``training`` and ``held_out`` are conditions on the rows; scores are log10 probabilities.
    """
    spark = docs.sparkSession
    words = checkpointed(word_table(docs, training, text_col))
    documents = docs.where(training).count()
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, distinct = total + documents, distinct + (documents > 0)  # with the ends
    logp, end = fit_pieces(words, documents, model_path)
    floor = math.log10(total + distinct + 1)

    is_hot = _frequency_class(F.col("n")) >= _hot_class(words, hot_words)
    short = F.when(F.length("word") <= HOT_BYTES, F.col("word")).otherwise(
        F.concat(F.lit(b" "), F.unhex(F.sha2("word", 256))))  # no word has a blank
    hot = _scored(words.where(is_hot), logp, model_path).select(short.alias("word"), "c", "lattice")
    hot = hot.toArrow()  # at most ``hot_words`` of at most ``HOT_BYTES`` bytes
    counts = hot["c"].to_numpy()
    table = spark.sparkContext.broadcast((hot["word"].to_pylist(), counts > 0, np.log10(counts + 1.0) - floor,
                                          hot["lattice"].to_numpy()))
    ending = (int(documents > 0), math.log10(documents + 1) - floor, end / math.log(10))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, trained, base, lattice = table.value
        number = dict(zip(names, range(len(names)))).get
        for ids, texts in text_chunks(batches, 1 << 20):
            rows = []
            for i, text in zip(ids.to_pylist(), texts):
                found = words_of(text)
                tie = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)
                places = list(map(number, found))
                rare: dict[bytes, int] = {}
                if None in places:
                    rare = Counter(w for w, p in zip(found, places) if p is None)
                    places = [p for p in places if p is not None]
                    for word in [w for w in rare if len(w) > HOT_BYTES]:
                        if (place := number(b" " + hashlib.sha256(word).digest())) is not None:
                            places += [place] * rare.pop(word)
                places = np.array(places, np.int64)
                rows.append((b" %d %d" % (i or 0, tie), i, tie, 1, 1, len(found) + 1, int(trained[places].sum()) + ending[0],
                             float(base[places].sum()) + ending[1], float(lattice[places].sum()) + ending[2]))
                rows += [(word, i, tie, times, None, None, None, None, None) for word, times in rare.items()]
            columns = zip(zip(*rows), (pa.binary(), *[pa.int64()] * 6, pa.float64(), pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns],
                                             [part.split()[0] for part in _PARTS.split(", ")])

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col))
    parts = map_batches(texts, split, _PARTS, keeps=True)  # a row of each document under a key that is no word, and its rare words
    rest = _scored(words.where(~is_hot), logp, model_path).select(
        "word", (F.col("c") > 0).cast("bigint").alias("w_known"), (F.log10(F.col("c") + 1.0) - floor).alias("w_base"),
        F.col("lattice").alias("w_lattice"))
    joined = parts.join(rest, "word", "left")

    def added(own: str, word: str) -> Column:
        return F.sum(F.coalesce(F.col(own), F.col("times") * F.col(word))).alias(own)

    sums = joined.groupBy("id", "tie").agg(
        F.sum("copies").alias("copies"), F.sum("n_tokens").alias("n_tokens"), added("n_known", "w_known"),
        added("base", "w_base"), added("lattice", "w_lattice"))
    # rows of equal id and text were added up: each gets its share
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    whole = lambda name: (F.col(name) / F.col("copies")).cast("bigint").alias(name)
    out = sums.select(F.col("id").alias(id_col), whole("n_tokens"), whole("n_known"),
                      F.lit(total).cast("bigint").alias("train_tokens"),
                      (F.col("base") / F.col("copies")).alias("base_score"), (F.col("lattice") / F.col("copies")).alias("score"))
    return out.select(id_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")
