"""Operator 2, Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: from each place, the longest phrase seen before and one
code point more.  The set of phrases is what a compressor learns from the text; texts that share much
of it compress well together.  The phrases' hashes are reduced to the ``SIGNATURE`` smallest
(a bottom-k minimum-hash signature); the likeness of two signatures estimates the Jaccard similarity of
the phrase sets, and is exact for texts with fewer phrases.

Every document is also compared with its edited text (its last third replaced by the front of the next
document in descending order of ids) and with that next document.  The rows are dealt to
contiguous ranges of ids, about equally many in each, and the first row of a range is sent to the
range before it as well; so one shuffle of compressed texts brings neighbours together, and a worker
holds two documents beside its batch.  The parse of the kept two thirds serves both texts: the dictionary entries of one
tail are taken back before the other is read.  Symbols and hashes are made block by block, so what a long text
takes beside itself is one dictionary, which has fewer entries than the text has symbols (an eighth or so in prose).

Defined results: a null text counts as empty (fingerprint "", alike only to another empty one, by 1.0);
rows without an id come after all others; rows that share an id follow one another in an order that
depends on their texts only; a sole row is its own next document; an empty table gives an empty result;
other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import map_batches, text_chunks

SIGNATURE = 128
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_STEP = 1 << 21  # more than any code point: a node's number leaves room for the symbol behind it
_BLOCK = 1 << 18  # symbols that are unpacked or hashed at once


def lz_parse(symbols: list[int], phrases: dict[int, int], node: int, at: int, ends: array) -> int:
    """Read ``symbols`` (the text from place ``at`` on), adding phrases to the trie and their ends to ``ends``.

    ``phrases`` maps (node, symbol) to the node below; ``node`` is where the unfinished phrase stands.
    Returns where it stands at the end, so that a parse can be continued.
    """
    child, end, last = phrases.get, ends.append, len(phrases) * _STEP
    for place, symbol in enumerate(symbols, at + 1):
        below = child(node + symbol)
        if below:
            node = below
        else:
            last += _STEP
            phrases[node + symbol] = last
            end(place)
            node = 0
    return node


class PhraseHasher:
    """Position-independent hashes of a text's phrases from one running sum."""

    def __init__(self):
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
                self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _INVERSE)]), dtype=np.uint64)

    def __call__(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(points) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(points) + 1, np.uint64)
            np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.powers[: len(points)], out=sums[1:])
            h = (sums[ends] - sums[starts]) * self.inverses[starts]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(32)).astype(np.uint32)


def signature(hashes: np.ndarray, k: int = SIGNATURE) -> np.ndarray:
    """The ``k`` smallest distinct hashes, in order."""
    if len(hashes) > 4 * k:
        hashes = hashes[hashes <= np.partition(hashes, 2 * k)[2 * k]]
    return np.unique(hashes)[:k]


def likeness(a: np.ndarray, b: np.ndarray, k: int = SIGNATURE) -> float:
    """Share of the ``k`` smallest hashes of both sets together that are in either set."""
    if not len(a) and not len(b):
        return 1.0
    both, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    return float(np.count_nonzero(counts[:k] == 2) / len(both[:k]))


def fingerprint_text(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


_HASHER = PhraseHasher()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _parse(points: np.ndarray, phrases: dict[int, int], node: int, at: int, ends: array) -> int:
    """``lz_parse`` of ``points`` from place ``at`` on, a block at a time."""
    for begin in range(at, len(points), _BLOCK):
        node = lz_parse(points[begin : begin + _BLOCK].tolist(), phrases, node, begin, ends)
    return node


def _signature(points: np.ndarray, ends: array, start: int = 0) -> np.ndarray:
    """The smallest hashes of the phrases that end at ``ends``, the first of which begins at ``start``."""
    if not ends:
        return np.empty(0, np.uint32)
    ends = np.frombuffer(ends, np.int64)
    least, done = np.empty(0, np.uint32), 0
    while done < len(ends):  # whole phrases, as many as a block holds, but one at least
        upto = max(int(np.searchsorted(ends, start + _BLOCK, side="right")), done + 1)
        within = ends[done:upto] - start
        hashes = _HASHER(points[start : start + within[-1]], np.concatenate([[0], within[:-1]]), within)
        least = signature(np.concatenate([least, hashes]))
        start, done = int(ends[upto - 1]), upto
    return least


def text_signature(text: str) -> np.ndarray:
    points, ends = _points(text), array("q")
    _parse(points, {}, 0, 0, ends)
    return _signature(points, ends)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the front of ``following`` (or all of it)."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def signatures_with_edit(text: str, following: str) -> tuple[np.ndarray, str, np.ndarray]:
    """Signature of a text, its edited text, and that one's signature; the common front is parsed once."""
    edited, cut = edited_text(text, following), len(text) - len(text) // 3
    own, other = _points(text), _points(edited)
    phrases: dict[int, int] = {}
    ends = array("q")
    node = _parse(own[:cut], phrases, 0, 0, ends)
    shared, known, start = _signature(own, ends), len(phrases), ends[-1] if ends else 0
    found = []
    for points in (own, other):
        ends = array("q")
        _parse(points, phrases, node, cut, ends)
        found.append(signature(np.concatenate([shared, _signature(points, ends, start)])))
        for _ in range(len(phrases) - known if points is own else 0):  # the newest entries go first
            phrases.popitem()
    return found[0], edited, found[1]


def lz_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_chars``, ``fingerprint``, ``edited_sha256``, ``edited_fingerprint``, ``near_edited``, ``near_next``."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = source.select("id").approxQuantile("id", [i / wanted for i in range(1, wanted)], 0.0005) if wanted > 1 else []
    bounds = np.array(sorted({int(b) for b in bounds}), np.int64)  # range 0 holds the largest ids

    def range_of(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
        return np.where(known, len(bounds) - np.searchsorted(bounds, ids, side="right"), len(bounds))

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The largest id of each range, as far as this partition knows it."""
        best: dict[int, int | None] = {}
        for batch in batches:
            for i, r in zip(batch.column(0).to_pylist(), _ranges(batch.column(0), range_of).tolist()):
                if r not in best or (i is not None and (best[r] is None or i > best[r])):
                    best[r] = i
        yield pa.RecordBatch.from_arrays([pa.array(best.keys(), pa.int32()), pa.array(best.values(), pa.int64())],
                                         ["range", "id"])

    firsts = map_batches(source.select("id"), first_ids, "range int, id bigint")
    firsts = sorted(firsts.groupBy("range").agg(F.max("id").alias("id")).collect())  # one row for each range
    sent_back = {firsts[i].range: (firsts[i].id, firsts[i - 1].range) for i in range(len(firsts))}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for ids, texts in text_chunks(batches):
            rows = []
            for i, r, text in zip(ids.to_pylist(), _ranges(ids, range_of).tolist(), texts):
                packed = squeeze.compress(text.encode("utf-8", "surrogatepass"))
                rows.append((r, False, i, packed))
                first, before = sent_back[r]
                if i == first:
                    rows.append((before, True, i, packed))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.int64(), pa.binary()))],
                ["range", "next", "id", "packed"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held = None  # the document whose next one is to come
        for batch in batches:
            out = []
            for is_next, i, packed in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                if is_next and held is None:
                    continue
                text = unpack.decompress(packed).decode("utf-8", "surrogatepass")
                if held is not None:
                    out.append((*held, text))
                held = None if is_next else (i, text)
            if out:
                yield _compared(out)

    dealt = map_batches(source, deal, "range int, next boolean, id bigint, packed binary")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("range"))
    dealt = dealt.sortWithinPartitions("next", F.desc_nulls_last("id"), "packed")
    return map_batches(dealt, compare, _SCHEMA).withColumnRenamed("id", id_col)


_SCHEMA = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _ranges(ids: pa.Array, range_of) -> np.ndarray:
    known = np.asarray(ids.is_valid())
    return range_of(np.asarray(ids.fill_null(0)), known)


def _compared(pairs: list[tuple]) -> pa.RecordBatch:
    """Result rows of (id, text, next text), in the order of the documents."""
    rows, upcoming = [], None
    for k, (i, text, following) in enumerate(pairs):
        own, edited, other = signatures_with_edit(text, following)
        if k:
            rows[-1].append(likeness(upcoming, own))
        rows.append([i, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                     fingerprint_text(own), fingerprint_text(other), likeness(own, other)])
        upcoming = own
    rows[-1].append(likeness(upcoming, text_signature(pairs[-1][2])))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)],
                                      [part.split()[0] for part in _SCHEMA.split(", ")])
