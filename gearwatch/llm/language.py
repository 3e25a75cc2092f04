"""Operator 5, language identification by cross-parsing.

For every language a bounded sample of labelled text is kept.  A text is cross-parsed against it: from each
place, the longest stretch that occurs anywhere in the sample is one phrase; the next phrase begins
behind it.  A phrase costs the logarithm of the sample's length, which is what pointing into it takes, so that samples of
different length compare (the Ziv-Merhav estimate of cross entropy); the language in which the text costs least wins.

A sample is drawn from ``SAMPLE_DOCS`` documents, ``TEXT_CHARS`` characters of each at most, and holds ``SAMPLE_CHARS``
symbols: these three bounds are for the training sample only.

The stretches are found by a suffix automaton of the sample, laid out as one table
(state, letter) -> state.  Texts are read in stretches of ``STRETCH`` symbols, all those of a batch in step, one table
look-up a symbol and language, as if each began a phrase; then the phrase that is open at the end of a
stretch is carried into the next, which is read again up to the place where both readings stand in one state (they stay
together from there).  So the count is that of the text read in one go.  Whole texts are read.  What a worker holds is the tables (bounded by ``SAMPLE_CHARS`` letters a language) and a batch.

Letters are lower-cased; anything else is a blank, and runs of blanks count once.  The ``ALPHABET`` most frequent letters of
the samples are a symbol each; every other letter of a sample is spelled by four digits of its code point, so scripts
of thousands of letters are told apart by a table of small width.  Letters that no sample holds always end a phrase.

Defined results: a null text, an empty one and one without a letter are ``und`` with score 0; every
input row gives one row, repeated rows included; equal costs go to the language first by name; an
empty table, or one without labels, gives ``und`` for all; other columns are neither read nor returned.
``score`` is 1 - (cost in the winner) / (cost in the runner-up); with one language, the share of
symbols that its phrases save.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import map_batches, text_chunks, worker_state

SAMPLE_DOCS = 96  # labelled documents a language that a sample is drawn from
SAMPLE_CHARS = 60_000  # symbols of sample a language
TEXT_CHARS = 2_500  # characters of a labelled document that can go into a sample
ALPHABET = 96  # letters that are a symbol by themselves, and one for those in no sample
DIGITS = 5  # bits of a code point in each of the four symbols that spell any other letter
STRETCH = 4096
UNKNOWN = "und"
_BATCH_CHARS = 1 << 21
_LETTERS: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank."""
    if not _LETTERS:
        table = np.full(0x110000, ord(" "), np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else ord(low[0])
        _LETTERS.append(table)
    return _LETTERS[0]


def normalised(text: str) -> np.ndarray:
    """Lower-case letters and single blanks, as code points, with a blank at either end."""
    points = letter_table()[np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == ord(" ")
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def suffix_arrows(symbols: list[int]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The automaton of all substrings of ``symbols``: how many states it has (0 is the start), and its arrows as three arrays
    (state, symbol, state that follows); there are at most three arrows for each symbol."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        state = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and c not in following[at]:
            following[at][c] = state
            at = link[at]
        if at != -1:
            other = following[at][c]
            if length[at] + 1 == length[other]:
                link[state] = other
            else:
                copy = len(following)
                following.append(dict(following[other]))
                length.append(length[at] + 1)
                link.append(link[other])
                while at != -1 and following[at].get(c) == other:
                    following[at][c] = copy
                    at = link[at]
                link[other] = link[state] = copy
        last = state
    origin = np.repeat(np.arange(len(following), dtype=np.int32), [len(arrows) for arrows in following])
    symbol = np.fromiter((c for arrows in following for c in arrows), np.int32, len(origin))
    target = np.fromiter((to for arrows in following for to in arrows.values()), np.int32, len(origin))
    return len(following), origin, symbol, target


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """(state, symbol) -> state for all substrings of ``symbols``; -1 where there is none; 0 is the start."""
    states, origin, symbol, target = suffix_arrows(symbols)
    table = np.full((states, alphabet), -1, np.int32)
    table[origin, symbol] = target
    return table


def _in_parts(symbols: np.ndarray, size: int = 64) -> Iterator[int]:
    for at in range(0, len(symbols), size):
        yield from symbols[at : at + size].tolist()


class CrossParser:
    """The languages' automata in one table, and the alphabet they share."""

    def __init__(self, samples: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS):
        self.languages = sorted(samples)
        texts = {k: np.concatenate([normalised(t) for t in v])[:sample_chars] for k, v in samples.items()}
        letters, counts = np.unique(np.concatenate(list(texts.values())), return_counts=True)
        letters = letters[np.argsort(-counts, kind="stable")]
        plain, spelled = letters[: ALPHABET - 1], letters[ALPHABET - 1 :]
        self.symbol = np.zeros(0x110000, np.uint8)  # 0: a letter that always ends a phrase
        self.symbol[plain] = np.arange(1, len(plain) + 1)
        self.spelled = np.zeros(0x110000, bool)
        self.spelled[spelled] = True
        self.digit = len(plain) + 1  # the symbol of the digit 0
        width, automata, self.starts, at = self.digit + (1 << DIGITS if len(spelled) else 0), [], [], 0
        self.costs = np.zeros(len(self.languages))
        for language in self.languages:
            symbols = self.symbols(texts[language], np.array([len(texts[language])]))[0][:sample_chars]
            self.costs[len(self.starts)] = np.log2(max(len(symbols), 2))
            automata.append(suffix_arrows(symbols.tolist()))
            self.starts.append(at)
            at += automata[-1][0]
        self.table = np.full(at * width, -1, np.int32)  # made once and filled in place: a worker never holds it twice
        for start, (states, origin, symbol, target) in zip(self.starts, automata):
            after = self.table[start * width : (start + states) * width].reshape(states, width)
            after[origin, symbol] = target
            after[:, 0] = -1
            # where a phrase ends, the symbol begins the next one; the lowest bit says that one begins
            begins = after < 0
            begins[0] = True
            np.copyto(after, np.maximum(after[0], 0), where=after < 0)
            after += start
            after *= 2
            after += begins
        self.width = width
        self.starts = np.array(self.starts, np.int32)

    def symbols(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of texts of ``sizes`` letters that lie end to end, and how many each has."""
        spelled = self.spelled[points]
        if not spelled.any():
            return self.symbol[points], sizes
        lengths = np.where(spelled, 4, 1)
        behind = np.cumsum(lengths)
        out = np.repeat(self.symbol[points], lengths)
        at, codes = behind[spelled] - 4, points[spelled].astype(np.int64)
        for k in range(4):
            out[at + k] = self.digit + (codes >> DIGITS * (3 - k) & (1 << DIGITS) - 1)
        return out, np.diff(np.concatenate([[0], behind])[np.concatenate([[0], np.cumsum(sizes)])])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(language, text) -> number of phrases, for normalised texts."""
        symbols, sizes = self.symbols(np.concatenate(texts), np.array([len(t) for t in texts], np.int64))
        symbols = symbols.astype(np.int32)
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (np.cumsum(sizes) - sizes)[owner] + within * STRETCH
        length = np.minimum(sizes[owner] - within * STRETCH, STRETCH)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        active = np.searchsorted(-length, -np.arange(length[0]), side="left") if len(length) else []
        state = np.repeat(self.starts[:, None], len(owner), axis=1)
        begun = np.zeros((len(self.starts), len(owner)), np.int32)
        for step, n in enumerate(active):  # stretches longer than ``step`` come first
            found = self.table[state[:, :n] * self.width + symbols[begin[:n] + step]]
            begun[:, :n] += found & 1
            state[:, :n] = found >> 1
        counts = np.zeros((len(self.starts), len(texts)), np.int64)
        for k in range(len(self.starts)):
            counts[k] = np.bincount(owner, begun[k], len(texts))
        for k in range(len(self.starts)):
            self._carry(symbols, order, owner, begin, length, state[k], counts[k], int(self.starts[k]))
        return counts

    def _carry(self, symbols: np.ndarray, order: np.ndarray, owner: np.ndarray, begin: np.ndarray, length: np.ndarray,
               ended: np.ndarray, counts: np.ndarray, start: int) -> None:
        """Set right the ``counts`` of texts of several stretches: a stretch goes on where the one before ``ended``."""
        places = np.empty(len(order), np.int64)
        places[order] = np.arange(len(order))  # the stretches in the order of the texts
        table, width = self.table.data, self.width
        later = np.flatnonzero(owner[places][1:] == owner[places][:-1]) + 1
        carried, before = start, -1
        for n in later.tolist():
            place = places[n]
            if n != before + 1:
                carried = int(ended[places[n - 1]])
            fresh, more = start, 0
            for symbol in _in_parts(symbols[begin[place] : begin[place] + length[place]]):
                if fresh == carried:
                    break
                a, b = table[fresh * width + symbol], table[carried * width + symbol]
                more += (b & 1) - (a & 1)
                fresh, carried = a >> 1, b >> 1
            if fresh == carried:
                carried = int(ended[place])
            counts[owner[place]] += more
            before = n

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        shaped = [normalised(t) for t in texts]
        lettered = np.array([len(s) > 1 for s in shaped], bool)
        if not self.languages or not lettered.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        costs = self.phrases(shaped) * self.costs[:, None]
        best = np.argmin(costs, axis=0)  # the first of equals, by name
        least = np.sort(costs, axis=0)
        against = least[1] if len(least) > 1 else np.array([len(s) for s in shaped]) * self.costs[0]
        score = np.where(lettered, 1 - least[0] / np.maximum(np.maximum(against, least[0]), 1e-9), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)], np.clip(score, 0, 1)


def _smallest(drawn: DataFrame, n: int) -> dict[str, int]:
    """Per label, the ``n``-th smallest distinct number (the largest, if there are fewer).

    The numbers are hashes, evenly spread: only those below a bound that some ``8 n`` of a label's
    stay under are gathered; a label for which that was too few (ids that repeat) gets a wider bound.
    """
    share = {r.label: 8 * n / r["count"] for r in drawn.groupBy("label").count().collect()}
    found: dict[str, int] = {}
    while share:
        bounds = {label: min(int((part - 0.5) * 2**64), 2**63 - 1) for label, part in share.items()}
        below = drawn.where(F.col("drawn") <= F.try_element_at(_as_map(bounds), F.col("label"))).distinct()
        rows = below.groupBy("label").agg(F.sort_array(F.collect_list("drawn")).alias("all"))
        some = {r.label: r.some for r in rows.select("label", F.slice("all", 1, n).alias("some")).collect()}
        done = [label for label, part in share.items() if part >= 1 or len(some.get(label, ())) == n]
        found |= {label: some[label][-1] for label in done}
        share = {label: 8 * part for label, part in share.items() if label not in done}
    return found


def _as_map(values: dict[str, int]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*(F.lit(v).cast("bigint") for v in values.values())))


def labelled_sample(docs: DataFrame, training: Column, id_col: str, text_col: str, label_col: str,
                    sample_docs: int = SAMPLE_DOCS, text_chars: int = TEXT_CHARS) -> dict[str, list[str]]:
    """Per label, the texts (up to ``text_chars`` characters each) of the ``sample_docs`` training rows with the smallest
    hashed ids."""
    labelled = docs.where(training & F.col(label_col).isNotNull()).select(
        F.col(label_col).alias("label"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit(7)).alias("drawn"))
    last = _smallest(labelled.select("label", "drawn"), sample_docs)
    if not last:
        return {}
    rows = labelled.where(F.col("drawn") <= F.try_element_at(_as_map(last), F.col("label"))).select(
        "label", "drawn", F.substring("text", 1, text_chars).alias("text"))
    rows = rows.groupBy("label", "drawn").agg(F.min("text").alias("text")).where("text is not null")
    samples: dict[str, list[str]] = {}
    for row in rows.orderBy("label", "drawn", "text").collect():  # sample_docs rows a language
        samples.setdefault(row.label, []).append(row.text)
    return samples


def _predictor(docs: DataFrame, samples: dict[str, list[str]]):
    """A function for the workers: texts -> (languages, scores); a worker builds the tables once."""
    key = hash(tuple((k, *v) for k, v in sorted(samples.items())))
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def predict(texts: list[str]) -> tuple[list[str], np.ndarray]:
        parser = worker_state((CrossParser, key), lambda: CrossParser(shared.value) if shared.value else None)
        return parser.predict(texts) if parser else ([UNKNOWN] * len(texts), np.zeros(len(texts)))

    return predict


def identify_languages(docs: DataFrame, samples: dict[str, list[str]], id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """id, ``lang_pred`` and ``score`` of every row's whole text."""
    predict = _predictor(docs, samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, _BATCH_CHARS):
            langs, score = predict(texts)
            yield pa.RecordBatch.from_arrays([ids, pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                             ["id", "lang_pred", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, run, f"id {kind}, lang_pred string, score double", keeps=True).withColumnRenamed("id", id_col)


def with_known_language(docs: DataFrame, samples: dict[str, list[str]], text_col: str = "text",
                        wanted: Collection[str] | None = None, least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is predicted as one of ``wanted`` (None: any that can be told) with a
    score of ``least_score`` or more; a row is judged by its own text only.

    Without any sample, those that have a letter.
    """
    if not samples:
        wanted, least_score = None, 0.0
    predict, names = _predictor(docs, samples or {UNKNOWN + "?": [""]}), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(names.index(text_col))
            numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(len(text))), text], ["row", "text"])
            for rows, texts in text_chunks(iter([numbered]), _BATCH_CHARS):
                told = pa.array([lang != UNKNOWN and (wanted is None or lang in wanted) and score >= least_score
                                 for lang, score in zip(*predict(texts))], pa.bool_())
                yield batch.slice(rows[0].as_py(), len(rows)).filter(told)

    return map_batches(docs, run, docs.schema, keeps=True)
