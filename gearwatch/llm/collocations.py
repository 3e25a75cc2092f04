"""Operator 11, phrase collocations by top-order marginalisation.

A phrase occurs as often as it is the beginning of a longest window: the ``ORDER`` words from some place on, padded
where its piece ends.  So only those windows are counted, one for each word; Spark's ROLLUP over the columns
(group, w1 .. w5) then adds them up to the counts of all shorter prefixes, down to a group's number of words.

Windows are padded earlier where nothing can be lost: a phrase counts only from ``min_count`` on, and so do then all its
parts.  ``LEVELS`` passes before the windows count words, then pairs of frequent words, then triples of frequent pairs and
so on, by hashes of 38 bits and more; the frequent ones are marked in a bitmap of ``BITMAP_BITS`` bits a pass, the only things
that are broadcast.  Hashes and marks that collide keep windows longer than need be and change no count.

Candidates then meet the counts of their parts by a join on (group, part), dealt over ``SALT`` sub-keys, as some
words begin or end a large share of all phrases.  Scores are exact: products in 38 digits, floored by ``div``.

Defined results: a null or empty text has no words; a null group is ``und``, together with rows that are named so;
repeated rows count each time; ties as said in ``collocations``; an empty table, or one without any candidate, gives an
empty result; other columns are neither read nor returned.  Texts are taken in steps of a few MB, whatever their
length; a worker holds one step's words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearwatch.llm.common import byte_column, checkpointed, map_batches

ORDER = 5
MIN_COUNT = 100
TOP = 2000
BITMAP_BITS = 26
LEVELS = 3  # sizes of phrases that are counted beforehand, to know where windows can be padded
SALT = 16
UNKNOWN = "und"
_STEP = 8 << 20  # bytes of text that are split into words together
_HELD = 1 << 20  # hashes that a worker adds up before it hands them on
_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of a stretch of texts: ``ids`` into ``vocabulary``, ``code`` of their group, ``joined`` where
    the next word lies in the same piece, and ``heads``, how many of them begin a window here."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, codes: np.ndarray, heads: int | None = None):
        kind = _KIND[data]
        inside = kind == 0
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        borders = ends[:-1][ends[:-1] < len(data)]
        borders = borders[borders > 0]
        begins[borders] = inside[borders]
        closes[borders - 1] = inside[borders - 1]
        self.starts = np.flatnonzero(begins)
        lengths = np.flatnonzero(closes) + 1 - self.starts
        owner = np.searchsorted(ends, self.starts, "right")
        piece = np.cumsum(kind == _BREAK, dtype=np.int32)[self.starts] if len(data) else owner
        self.code = codes[owner]
        self.joined = np.zeros(len(owner), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        packed = _LOWER[data[inside]]
        words = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        coded = words.dictionary_encode()
        self.vocabulary, self.ids = coded.dictionary, coded.indices.to_numpy()
        self.heads = len(self.ids) if heads is None else max(len(self.ids) - heads, 0)

    def hashes(self, groups: list[str]) -> np.ndarray:
        """One number for each (group, word), as a table; equal in every task."""
        digest = xxhash.xxh3_64_intdigest
        words = np.fromiter(map(digest, self.vocabulary.to_pylist()), np.uint64, len(self.vocabulary))
        seeds = np.fromiter(map(digest, groups), np.uint64, len(groups))
        with np.errstate(over="ignore"):
            return _mixed(words[None, :] * _P + seeds[:, None])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _Q
    return x ^ (x >> np.uint64(29))


def stretches(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, step: int | None = None) -> Iterator[Words]:
    """Words of texts (``data`` from each of ``offsets`` to the next, with a code each), in steps of ``step`` bytes.

    A text longer than a step is cut behind the last break of the step; without one, at a blank, and the next
    stretch begins ``ORDER - 1`` words earlier: those begin no window in the one before.
    """
    row, rows, step = 0, len(codes), step or _STEP
    while row < rows:
        last = max(int(np.searchsorted(offsets, offsets[row] + step, "right")) - 1, row + 1)
        if last > row + 1 or offsets[last] - offsets[row] <= step:
            yield Words(data[offsets[row] : offsets[last]], offsets[row + 1 : last + 1] - offsets[row], codes[row:last])
        else:
            at, end = int(offsets[row]), int(offsets[last])
            while at < end:
                cut, heads = _cut(data, at, end, step)
                yield (found := Words(data[at:cut], np.array([cut - at]), codes[row:last], heads))
                at = cut if found.heads == len(found.ids) else at + int(found.starts[found.heads])
        row = last


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of (group, text) rows with the groups that their codes stand for."""
    for batch in batches:
        coded = batch.column(0).fill_null(UNKNOWN).dictionary_encode()
        for found in stretches(*byte_column(batch.column(1)), coded.indices.to_numpy()):
            yield found, coded.dictionary.to_pylist()


def _cut(data: np.ndarray, at: int, end: int, step: int) -> tuple[int, int | None]:
    """(where a stretch from ``at`` ends, how many of its last words begin no window)."""
    if end - at <= step:
        return end, None
    kind = _KIND[data[at : at + step]]
    breaks = np.flatnonzero(kind == _BREAK)
    if len(breaks):
        return at + int(breaks[-1]) + 1, None
    blanks = np.flatnonzero(kind)
    if len(blanks) and np.count_nonzero(np.diff(blanks) > 1) > 2 * ORDER:
        return at + int(blanks[-1]), ORDER - 1
    for far in range(at + step, end, step):  # hardly any blanks: one piece more at a time
        kind = np.concatenate([kind, _KIND[data[far : far + step]]])
        breaks, blanks = np.flatnonzero(kind == _BREAK), np.flatnonzero(kind)
        if len(breaks):
            return at + int(breaks[-1]) + 1, None
        if np.count_nonzero(np.diff(blanks) > 1) > 2 * ORDER:
            return at + int(blanks[-1]), ORDER - 1
    return end, None


class Marks:
    """A bitmap of hashes, by their highest ``bits``: of ``ranges`` parts, each compressed."""

    def __init__(self, bits: int, parts: list[tuple[int, bytes]]):
        self.shift = np.uint64(64 - bits)
        self.bytes = np.zeros(1 << (bits - 3), np.uint8)
        unpack = zstandard.ZstdDecompressor()
        for part, bitmap in parts:
            bitmap = np.frombuffer(unpack.decompress(bitmap), np.uint8)
            self.bytes[part * len(bitmap) : (part + 1) * len(bitmap)] = bitmap

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> self.shift
        return (self.bytes[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(key, count) pairs with each key once, in order."""
    keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit keys as steps, with counts (up to 2^16 - 1 each), byte planes compressed."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    counts = np.minimum(counts, 0xFFFF).astype("<u2").view(np.uint8).reshape(-1, 2).T
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([steps, counts]).tobytes())


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(6, -1)
    steps = np.ascontiguousarray(planes[:4].T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32), np.ascontiguousarray(planes[4:].T).view("<u2").ravel().astype(np.int64)


def _frequent(texts: DataFrame, counter: Callable[[], Callable], min_count: int, bits: int) -> list[tuple[int, bytes]]:
    """The parts of the bitmap of the hashes that come ``min_count`` times or more, 2^(bits - 3) bytes in all.

    ``counter`` makes, once a task, the function that gives a stretch's (hashes, counts).  A task adds them up
    and hands them on as one packed list for each range of hashes, cut to 32 bits below the range's; a range meets in
    one task, list by list, of which there are as many as shuffle partitions or more.
    """
    if min_count > 0xFFFF:
        raise ValueError("counts are summed in parts of up to 65,535")
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = min(max((2 * partitions - 1).bit_length(), 6), bits - 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            ranges = (hashes >> np.uint64(64 - top)).astype(np.int64)
            keys = (hashes >> np.uint64(32 - top)).astype(np.uint32)
            begins = np.flatnonzero(np.diff(ranges, prepend=-1))
            ends = [*begins[1:].tolist(), len(ranges)]
            lists = [_packed(keys[a:b], counts[a:b]) for a, b in zip(begins.tolist(), ends)]
            return pa.RecordBatch.from_arrays([pa.array(ranges[begins].astype(np.int32)), pa.array(lists, pa.binary())], ["range", "list"])

        count, held = counter(), []
        for found in _stretches(batches):
            held.append(count(*found))
            if sum(len(h) for h, _ in held) > 2 * _HELD:
                held = [_added(held)]
                if len(held[0][0]) > _HELD:
                    yield emit(*held[0])
                    held = []
        if held:
            yield emit(*_added(held))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bitmap(number: int, held: list) -> pa.RecordBatch:
            keys, counts = _added(held)
            slots = keys[counts >= min_count].astype(np.uint64) >> np.uint64(32 - (bits - top))
            marks = np.zeros(1 << (bits - top), bool)
            marks[slots] = True
            packed = zstandard.ZstdCompressor().compress(np.packbits(marks, bitorder="little").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([packed], pa.binary())], ["range", "marks"])

        number, held = None, []
        for batch in batches:
            for own, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != number and held:
                    yield bitmap(number, held)
                    held = []
                number = own
                held.append(_unpacked(packed.as_py()))
                if sum(len(k) for k, _ in held) > 4 * _HELD:
                    held = [_added(held)]
        if held:
            yield bitmap(number, held)

    lists = map_batches(texts, run, "range int, list binary").repartition("range").sortWithinPartitions("range")
    return [(r.range, bytes(r.marks)) for r in map_batches(lists, mark, "range int, marks binary").collect()]


def _word_counts(found: Words, groups: list[str]) -> tuple[np.ndarray, np.ndarray]:
    size = len(found.vocabulary)
    counts = np.bincount(found.code[: found.heads].astype(np.int64) * size + found.ids[: found.heads], minlength=size * len(groups))
    seen = np.flatnonzero(counts)
    return found.hashes(groups).ravel()[seen], counts[seen].astype(np.int64)


def _grown(found: Words, groups: list[str], marks: list[Marks]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(for each of ``marks``, where a phrase of so many words begins that is frequent with all its parts; the places
    where one of one word more may begin, and its hashes)."""
    table = found.hashes(groups)
    known = marks[0](table)[found.code, found.ids]
    own = np.zeros(len(found.ids), np.uint64)
    at = np.flatnonzero(known)
    own[at] = table[found.code[at], found.ids[at]]
    last, hashes, levels = found.joined, own.copy(), [known]
    for size in range(2, len(marks) + 2):
        at = np.flatnonzero(known[:-1] & known[1:] & last[: len(known) - 1])
        with np.errstate(over="ignore"):
            grown = _mixed(hashes[at] * _P + (own[at + size - 1] ^ _Q))
        if size > len(marks):
            return levels, at, grown
        kept = marks[size - 1](grown)
        known, hashes = np.zeros(len(known), bool), np.zeros(len(known), np.uint64)
        known[at[kept]], hashes[at[kept]] = True, grown[kept]
        levels.append(known)
    raise ValueError("no marks")


def _padded_windows(found: Words, groups: list[str], marks: list[Marks]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(length, group codes and a column of word ids for each place, counts) of the windows that begin here."""
    levels, _, _ = _grown(found, groups, marks)
    n, longest, joined = len(found.ids), np.pad(levels[-1], (0, ORDER)), np.pad(found.joined, (0, ORDER))
    going, length = levels[0].copy(), np.ones(n, np.int64)
    for size in range(2, ORDER + 1):  # the last known part of a longer window is of the highest order marked
        going &= levels[size - 1] if size <= len(levels) else longest[size - len(levels) : size - len(levels) + n]
        going &= joined[size - 2 : size - 2 + n]
        length += going
    length = length[: found.heads]
    for size in range(1, ORDER + 1):
        at = np.flatnonzero(length == size)
        if not len(at):
            continue
        columns = [found.code[at].astype(np.int64), *(found.ids[at + k].astype(np.int64) for k in range(size))]
        place = columns[0]
        for column in columns[1:]:  # pairs of (number of what came before, next word) get new numbers
            _, place = np.unique(place * len(found.vocabulary) + column, return_inverse=True)
        _, one, counts = np.unique(place, return_index=True, return_counts=True)
        yield size, [column[one] for column in columns], counts


def window_counts(texts: DataFrame, min_count: int = MIN_COUNT, bits: int = BITMAP_BITS, levels: int = LEVELS) -> DataFrame:
    """``group``, ``w1`` .. ``w5`` (null: padding), ``n``: the padded windows of (``group``, ``text``) rows, one from each
    word on, and how often they occur."""
    context, known = texts.sparkSession.sparkContext, []
    names = [f"w{k + 1}" for k in range(ORDER)]

    def counter_of(shared: list) -> Callable[[], Callable]:
        def counter() -> Callable:
            if not shared:
                return _word_counts
            marks = [Marks(bits, x.value) for x in shared]

            def count(found: Words, groups: list[str]) -> tuple[np.ndarray, np.ndarray]:
                _, at, hashes = _grown(found, groups, marks)
                return np.unique(hashes[at < found.heads], return_counts=True)

            return count

        return counter

    for _ in range(levels):
        known = [*known, context.broadcast(_frequent(texts, counter_of(known), min_count, bits))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [Marks(bits, x.value) for x in known]
        for found, groups in _stretches(batches):
            for size, (code, *ids), counts in _padded_windows(found, groups, marks):
                columns = [found.vocabulary.take(pa.array(column)).cast(pa.string()) for column in ids]
                columns += [pa.nulls(len(counts), pa.string())] * (ORDER - size)
                yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()).take(pa.array(code)), *columns, pa.array(counts)],
                                                 ["group", *names, "n"])

    counted = map_batches(texts, run, "group string, " + ", ".join(f"{w} string" for w in names) + ", n bigint")
    return counted.groupBy("group", *names).agg(F.sum("n").alias("n"))


def phrase_counts(texts: DataFrame, min_count: int = MIN_COUNT, bits: int = BITMAP_BITS, levels: int = LEVELS) -> DataFrame:
    """``group``, ``words`` (array), ``f``: all phrases of 1 to ``ORDER`` words that occur ``min_count`` times or more,
    and with no words a group's number of words."""
    names = [f"w{k + 1}" for k in range(ORDER)]
    summed = window_counts(texts, min_count, bits, levels).rollup("group", *names).agg(
        F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    words = F.array(*names)
    size = F.lit(ORDER) - F.bit_count("left_out")  # of the prefix that a row of ROLLUP stands for; -1: all groups
    whole = (size == 0) | ((F.col("f") >= min_count) & F.element_at(words, F.greatest(size, F.lit(1))).isNotNull())
    return summed.where((size >= 0) & whole).select("group", F.slice(words, 1, size).alias("words"), "f")


def _salted(df: DataFrame, salt: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))


def collocations(docs: DataFrame, group_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 percent: int = 100, top: int = TOP, bits: int = BITMAP_BITS, levels: int = LEVELS,
                 salt: int = SALT) -> DataFrame:
    """Each group's ``top`` collocations: ``group_col``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut (the first of equals), ``n`` all
    words of the group; the score is floor(1000 a n / (l r)).  A phrase inside a longer candidate that occurs at
    least ``percent`` in 100 times as often is left out.  By score, then ``a``, then phrase.
    """
    texts = docs.select(F.coalesce(group_col, F.lit(UNKNOWN)).alias("group"), F.coalesce(text_col, F.lit("")).alias("text"))
    counts = checkpointed(phrase_counts(texts, min_count, bits, levels))
    phrases = counts.where(F.size("words") > 0).select("group", F.array_join("words", " ").alias("phrase"), "words", "f")
    totals = counts.where(F.size("words") == 0).select("group", F.col("f").alias("n"))
    candidates = phrases.where(F.size("words") > 1)

    def part(name: str, count: str) -> DataFrame:
        return _salted(phrases.select("group", F.col("phrase").alias(name), F.col("f").alias(count)), salt)

    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)"))).select(
        "group", "phrase", F.col("f").alias("a"), "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(words, k + 1, size(words))"), " ").alias("tail"),
        F.pmod(F.xxhash64("phrase"), F.lit(salt)).cast("int").alias("salt"))
    cuts = cuts.join(part("head", "l"), ["group", "head", "salt"]).join(part("tail", "r"), ["group", "tail", "salt"])
    cuts = cuts.join(_salted(totals, salt), ["group", "salt"])
    scored = cuts.withColumn("score", _score("a", "n", "l", "r")).groupBy("group", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select("group", "phrase", "cut.*")

    spans = "flatten(transform(sequence(2, size(words) - 1), w -> transform(sequence(1, size(words) - w + 1), " \
            "i -> array_join(slice(words, i, w), ' '))))"
    inside = candidates.where(F.size("words") > 2).select("group", F.col("f"), F.explode(F.array_distinct(F.expr(spans))).alias("phrase"))
    inside = inside.groupBy("group", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["group", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent))
    order = Window.partitionBy("group").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("group").alias(group_col), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                         "n", "score")


def _score(a: str, n: str, left: str, right: str) -> Column:
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"(cast(1000 as decimal(38,0)) * {wide(a)} * {wide(n)}) div ({wide(left)} * {wide(right)})")
