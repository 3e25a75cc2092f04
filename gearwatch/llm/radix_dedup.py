"""Operator 7, repeated passages by a depth-limited radix sort of suffixes.

Every byte position starts a suffix that is ordered only through its first ``WIDTH`` bytes; groups that
are equal that deep are exactly the repeated windows.  The most significant digit of a window is its
*anchor*: of the ``GRAM``-byte strings inside it, the one with the smallest hash (the leftmost of
equals).  Equal windows have equal anchors at equal places, so windows with different anchors are
never compared.  Neighbouring windows mostly share an anchor, and are sorted as one *run* of windows:

1. first pass, by anchor and by the run's whole content: a run that occurred before is repeated as
   a whole; a run whose anchor no other content has is done, as a group of one;
2. further passes, only for the runs left over (where copies begin, end or differ): their bytes are
   fetched, and the windows under an anchor are ordered eight bytes a pass, from the most significant on.  What is alone in
   its group after a pass drops out; groups that are left after ``WIDTH`` bytes are the repeats, by their bytes.

Only runs move in the first pass (one for about 32 bytes of text, five numbers wide), and in the others the
bytes of the few that are left; an anchor with more than ``HOT_ANCHOR`` of those is dealt again by whole
windows.  Streams are sorted, so that a worker keeps one anchor's different windows, never a group's rows.
Runs that repeat within a batch are settled before anything is shuffled, and so are windows that repeat ``PERIOD`` bytes
or less before (blanks, ruled lines): a text of one letter is one span, not a run a letter.  Touching spans are
merged where they are found, and once more in order of their places, before they meet their document.

Defined results: a null text counts as empty; rows that share id and text are one document (each
row gets its result); rows that share an id only count as one after another, by their texts' hashes; a row
without an id comes after all others; texts shorter than ``WIDTH`` bytes stay whole; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import byte_column, checkpointed, map_batches

WIDTH = 100
GRAM = 32
HOT_ANCHOR = 1000
PERIOD = 64
_BLOCK = 8 << 20  # bytes of text whose runs are collected together
_FETCH = 20_000  # fetched runs or windows that are handed on together
_STEP = 1 << 18  # windows whose anchors are found together
_LAST = (1 << 63) - 1  # stands for a missing id: after all others


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash for each string of ``gram`` bytes, from hashes of halves."""
    known, size, power = data.astype(np.uint64) + np.uint64(1), 1, np.uint64(0x9E3779B97F4A7C15)
    out, done = None, 0
    while True:
        if gram & size:
            if out is None:
                out, done = known, size
            else:
                n = len(out) - size
                out, done = out[:n] * power + known[done : done + n], done + size
        if done == gram:
            break
        known = known[:-size] * power + known[size:]
        power, size = power * power, size * 2
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values, size = np.minimum(values[:-size], values[size:]), size * 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def periodic_windows(data: np.ndarray, ends: np.ndarray, width: int, most: int = PERIOD) -> np.ndarray:
    """(first, behind the last) of the stretches of windows that also occur at most ``most`` bytes before, in the same text."""
    begins, found = np.concatenate([[0], ends[:-1]]), []
    step = min(16, max(width // 4, 1))  # a stretch of ``width`` equal bytes holds several places of this step in a row
    need = width // step - 1
    for p in range(1, min(most, len(data) - width) + 1):
        near = data[: len(data) - p : step] == data[p::step]
        if need > 1:
            near = _sliding_least(near, need) if len(near) >= need else np.zeros(0, bool)
        for at in np.flatnonzero(near & ~np.concatenate([[False], near[:-1]])):  # where such places begin
            low = max(int(at) * step - step + 1, 0)
            if found and found[-1][2] == p and low < found[-1][1]:
                continue
            first, last = int(at) * step, int(at) * step  # equal from ``first`` to ``last``
            while first > low and data[first - 1] == data[first - 1 + p]:
                first -= 1
            last = first + _equal_ahead(data, first, p)
            own = np.searchsorted(ends, first + p, "right")
            while own < len(ends) and begins[own] < last + p:  # text by text: a window and the one before it lie in one
                a, b = max(first, int(begins[own])) + p, min(last + p, int(ends[own])) - width + 1
                if b > a:
                    found.append((a, b, p))
                own += 1
    if not found:
        return np.zeros((0, 2), np.int64)
    spans = np.array(sorted((a, b - a) for a, b, _ in found), np.int64)
    return np.array(merged(spans), np.int64)


def _equal_ahead(data: np.ndarray, first: int, p: int) -> int:
    """How many bytes from ``first`` on equal those ``p`` further."""
    size, step = 0, 1 << 10
    while first + p + size < len(data):
        ahead = data[first + p + size : first + p + size + step]
        other = np.flatnonzero(data[first + size : first + size + len(ahead)] != ahead)
        if len(other):
            return size + int(other[0])
        size, step = size + len(ahead), min(step * 2, 1 << 22)
    return size


def window_runs(data: np.ndarray, ends: np.ndarray, width: int, gram: int,
                settled: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, number of windows, anchor's place in the first window) of all runs.

    ``data`` is texts end to end, ``ends`` where each ends; windows that leave their text do not count, nor do
    ``settled`` ones.
    """
    settled = np.zeros((0, 2), np.int64) if settled is None else settled
    if not 0 < gram <= width < gram + 255:
        raise ValueError("a run's windows are counted in one byte: gram <= width < gram + 255")
    parts = []
    with np.errstate(over="ignore"):
        for at in range(0, max(len(data) - width + 1, 0), _STEP):
            piece = data[at : at + _STEP + width - 1]
            hashes = _gram_hashes(piece, gram)
            places = np.arange(len(hashes), dtype=np.uint64)
            ranked = (hashes & np.uint64(0xFFFFFF_FFFF_000000)) | places
            anchor = (_sliding_least(ranked, width - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
            inside = np.ones(len(anchor), bool)
            for end in ends[np.searchsorted(ends, at, "right") : np.searchsorted(ends, at + len(anchor) + width, "left")]:
                inside[max(int(end) - width + 1 - at, 0) : max(int(end) - at, 0)] = False
            for a, b in settled[np.searchsorted(settled[:, 1], at, "right") : np.searchsorted(settled[:, 0], at + len(anchor))]:
                inside[max(int(a) - at, 0) : max(int(b) - at, 0)] = False
            windows = np.flatnonzero(inside)
            if not len(windows):
                continue
            anchor = anchor[windows]
            fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)])
            first = np.flatnonzero(fresh)
            count = np.diff(np.append(first, len(windows)))
            parts.append((hashes[anchor[first]].view(np.int64), at + windows[first], count, anchor[first] - windows[first]))
    return tuple(np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts) if parts else [()] * 4))


def _blocks(batches: Iterator[pa.RecordBatch], limit: int = _BLOCK) -> Iterator[tuple]:
    """(doc, tie, bytes, ends) of whole texts, about ``limit`` bytes at a time, in order of (doc, tie)."""
    for batch in batches:
        doc, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, offsets = byte_column(batch.column(2))
        order = np.lexsort((tie, doc))
        sizes = np.diff(offsets)[order]
        groups = np.cumsum(sizes) // limit
        for group in np.split(order, np.flatnonzero(np.diff(groups)) + 1) if len(order) else []:
            if len(group) > 1 and (np.diff(group) == 1).all():
                yield doc[group], tie[group], data[offsets[group[0]] : offsets[group[-1] + 1]], np.cumsum(np.diff(offsets)[group])
            else:
                texts = [data[offsets[i] : offsets[i + 1]] for i in group.tolist()]
                yield doc[group], tie[group], np.concatenate(texts), np.cumsum([len(t) for t in texts])


def _runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """All runs of windows: ``anchor``, ``content``, ``doc``, ``tie``, ``run`` and whether a batch settled it (``dup``).

    ``run`` packs the first window, the number of windows and the anchor's place into one number.  What is settled is merged to
    spans: their start is in ``content``, their length in ``run``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        names = ["anchor", "content", "doc", "tie", "run", "dup"]
        for doc, tie, data, ends in _blocks(batches):
            begins = np.concatenate([[0], ends[:-1]])
            settled = periodic_windows(data, ends, width)
            anchor, first, count, place = window_runs(data, ends, width, gram, settled)
            view = memoryview(data)
            content = np.fromiter((digest(view[a:b], p) for a, b, p in zip(
                first.tolist(), (first + count + width - 1).tolist(), place.tolist())), np.uint64, len(first))
            owner = np.searchsorted(ends, first, "right")
            with np.errstate(over="ignore"):
                both = anchor.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + content
            order = np.argsort(both, kind="stable")  # equal ones stay in order of document and place
            dup = np.zeros(len(first), bool)
            dup[order[1:]] = ((both[order[1:]] == both[order[:-1]]) & (anchor[order[1:]] == anchor[order[:-1]])
                              & (content[order[1:]] == content[order[:-1]]))
            spans = np.concatenate([np.stack([first[dup], count[dup] + width - 1], axis=1),
                                    np.stack([settled[:, 0], settled[:, 1] - settled[:, 0] + width - 1], axis=1)])
            if len(spans):
                spans = np.array(_merged_within(spans, ends), np.int64).reshape(-1, 2)
                own = np.searchsorted(ends, spans[:, 0], "right")
                start = spans[:, 0] - begins[own]
                with np.errstate(over="ignore"):
                    spread = doc[own] * np.int64(0x9E3779B1) + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spread), pa.array(start), pa.array(doc[own]), pa.array(tie[own]), pa.array(spans[:, 1] - spans[:, 0]),
                     pa.array(np.ones(len(own), bool))], names)
            left = ~dup
            own = owner[left]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[left]), pa.array(content[left].view(np.int64)), pa.array(doc[own]), pa.array(tie[own]),
                 pa.array((first[left] - begins[own]) << 16 | count[left] << 8 | place[left]), pa.array(np.zeros(len(own), bool))], names)

    return map_batches(docs, run, "anchor bigint, content bigint, doc bigint, tie bigint, run bigint, dup boolean")


def _merged_within(spans: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of maximal runs of (start, length) pairs, none of them over the end of a text."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    start, end, own = spans[:, 0], np.maximum.accumulate(spans.sum(axis=1)), np.searchsorted(ends, spans[:, 0], "right")
    opens = np.concatenate([[True], (start[1:] > end[:-1]) | (own[1:] != own[:-1])])
    closes = np.append(np.flatnonzero(opens)[1:] - 1, len(spans) - 1)
    return list(zip(start[opens].tolist(), end[closes].tolist()))


def _first_pass(runs: DataFrame, width: int) -> DataFrame:
    """Stretches that repeat as a whole (``dup``; ``start``, ``length``), and the first run of each content whose anchor has
    other contents too."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "doc", "tie", "run", "start", "length", "dup"]

        def emit(rows: np.ndarray, dup: np.ndarray, spans: bool = False) -> pa.RecordBatch:
            start, length = (rows[1], rows[4]) if spans else (rows[4] >> 16, (rows[4] >> 8 & 0xFF) + (width - 1))
            return pa.RecordBatch.from_arrays([*(pa.array(rows[i]) for i in (0, 2, 3, 4)), pa.array(start), pa.array(length),
                                               pa.array(dup)], names)

        last = None  # the row before: (anchor, content)
        lone = None  # the first content of the open anchor, as long as it has no other
        several = False
        for batch in batches:
            settled = batch.column(5).to_numpy(zero_copy_only=False)
            rows = np.stack([batch.column(i).to_numpy() for i in range(5)])
            if settled.any():
                yield emit(rows[:, settled], np.ones(int(settled.sum()), bool), spans=True)
                rows = rows[:, ~settled]
            if not rows.shape[1]:
                continue
            anchor, content = rows[0], rows[1]
            new_anchor = np.concatenate([[last is None or last[0] != anchor[0]], anchor[1:] != anchor[:-1]])
            new = new_anchor | np.concatenate([[last is None or last[1] != content[0]], content[1:] != content[:-1]])
            out = [rows[:, ~new]]
            dup = [np.ones(out[0].shape[1], bool)]
            heads, opens = rows[:, new], new_anchor[new]
            group = np.cumsum(opens)  # 0: goes on from the batch before
            sizes = np.bincount(group, minlength=int(group[-1]) + 1 if len(group) else 1)
            if sizes[0] and lone is not None:
                out.append(lone)
                lone, several = None, True
            many = sizes > 1
            many[0] = many[0] or several or sizes[0] > 0
            kept = many[group]
            if len(sizes) > 1:  # the open anchor is another one now
                several = bool(sizes[-1] > 1)
                lone = None if several else heads[:, -1:]
            out.append(heads[:, kept])
            dup.append(np.zeros(sum(x.shape[1] for x in out[1:]), bool))
            last = (anchor[-1], content[-1])
            yield emit(np.concatenate(out, axis=1), np.concatenate(dup))

    sorted_runs = runs.repartition("anchor").sortWithinPartitions("anchor", "content", "doc", "tie", "run")
    return map_batches(sorted_runs, sift, "anchor bigint, doc bigint, tie bigint, run bigint, start bigint, length bigint, dup boolean")


def _packed(docs: DataFrame) -> DataFrame:
    """The documents' bytes compressed, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for doc, tie, data, ends in _blocks(batches):
            starts = np.concatenate([[0], ends[:-1]]).tolist()
            packed = [squeeze.compress(data[a:b]) for a, b in zip(starts, ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tie), pa.array(packed, pa.binary())],
                                             ["doc", "tie", "packed"])

    return map_batches(docs, run, "doc bigint, tie bigint, packed binary")


def radix_repeats(data: np.ndarray, at: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Which of the strings of ``width`` bytes ``at`` places of ``data`` equal one before them in their ``group``.

    Most significant digits first, eight bytes a pass; a string that is alone in its group drops out.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    digits = np.zeros(len(data) + 1, np.uint64)  # the eight bytes from each place on
    for k in range(8):
        digits = digits << np.uint64(8) | padded[k : k + len(digits)]
    alive, group = np.arange(len(at)), group.astype(np.int64)
    for depth in [*range(0, width - 7, 8), max(width - 8, 0)]:
        digit = digits[at[alive] + depth]
        if width < 8:
            digit = digit >> np.uint64(8 * (8 - width))
        order = np.lexsort((digit, group))  # equal ones stay in their order
        digit, group = digit[order], group[order]
        new = np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])[: len(order)]).astype(np.int64)
        several = np.bincount(new, minlength=1)[new] > 1
        alive, group = alive[order][several], new[several]
    repeated = np.zeros(len(at), bool)
    if len(alive):
        repeated[alive[1:][group[1:] == group[:-1]]] = True
    return repeated


def _second_pass(docs: DataFrame, left: DataFrame, width: int, hot_anchor: int) -> DataFrame:
    """(``doc``, ``tie``, ``start``, ``length``) of the repeated stretches inside the runs ``left`` over."""
    spark = docs.sparkSession
    hot = left.groupBy("anchor").count().where(F.col("count") > hot_anchor).select("anchor", F.lit(True).alias("hot"))
    left = left.withColumn("hot", F.lit(False)) if hot.isEmpty() else \
        left.join(checkpointed(hot.repartition(spark.sparkContext.defaultParallelism)), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = left.groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "run", "hot")).alias("runs"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, digest = zstandard.ZstdDecompressor(), xxhash.xxh3_64_intdigest
        def contents(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(v, pa.binary() if i == 4 else pa.int64()) for i, v in enumerate(zip(*rows))],
                ["key", "doc", "tie", "start", "content"])

        rows: list[tuple] = []  # handed on by the ``_FETCH``, however many a batch of documents makes
        for batch in batches:
            for doc, tie, packed, runs in zip(*(batch.column(i) for i in range(4))):
                doc, tie, data = doc.as_py(), tie.as_py(), unpack.decompress(packed.as_py())
                anchors, places, hots = (runs.values.field(name).to_pylist() for name in ("anchor", "run", "hot"))
                for anchor, place, hot_run in zip(anchors, places, hots):
                    first, count = place >> 16, place >> 8 & 0xFF
                    if hot_run:
                        for w in range(first, first + count):
                            window = data[w : w + width]
                            rows.append(((digest(window) ^ 1 << 63) - (1 << 63), doc, tie, w, window))
                    else:
                        rows.append((anchor, doc, tie, first, data[first : first + count + width - 1]))
                    if len(rows) >= _FETCH:
                        yield contents(rows)
                        rows = []
        if rows:
            yield contents(rows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, known = None, b""  # the different windows so far of the key that may go on, end to end
        for batch in batches:
            keys, doc, tie, start = (batch.column(i).to_numpy() for i in range(4))
            data, offsets = byte_column(batch.column(4).cast(pa.binary()))
            sizes = np.diff(offsets) - width + 1  # windows of each row
            carried = len(known) // width if len(keys) and keys[0] == open_key else 0
            row = np.repeat(np.arange(len(keys)), sizes)
            within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            if carried:
                data = np.concatenate([np.frombuffer(known, np.uint8)[: carried * width], data])
            at = np.concatenate([np.arange(carried) * width, offsets[row] + within + carried * width])
            group = np.concatenate([np.zeros(carried, np.int64), np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)[row]])
            repeated = radix_repeats(data, at, group, width)
            if len(keys):
                fresh = np.flatnonzero((group == group[-1]) & ~repeated)
                known, open_key = b"".join(data[a : a + width].tobytes() for a in at[fresh].tolist()), keys[-1]
            hit = np.flatnonzero(repeated[carried:])
            if len(hit):
                opens = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])])
                closes = np.append(np.flatnonzero(opens)[1:] - 1, len(hit) - 1)
                a, b = hit[opens], hit[closes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[row[a]]), pa.array(tie[row[a]]), pa.array(start[row[a]] + within[a]), pa.array(b - a + width)],
                    ["doc", "tie", "start", "length"])

    contents = map_batches(
        _packed(docs).join(wanted, ["doc", "tie"]).select("doc", "tie", "packed", "runs"), fetch,
        "key bigint, doc bigint, tie bigint, start bigint, content binary")
    contents = contents.repartition("key").sortWithinPartitions("key", "doc", "tie", "start")
    return map_batches(contents, compare, "doc bigint, tie bigint, start bigint, length bigint")


def _identity(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, bool]:
    """What orders rows and tells apart those that share an id, and whether any do."""
    doc, text = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)), F.coalesce(text_col, F.lit(""))
    shared = not docs.groupBy(doc.alias("doc")).count().where(F.col("count") > 1).isEmpty()
    return doc, F.xxhash64(text) if shared else F.lit(0).cast("bigint"), shared


def identified(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(``doc``, ``tie``, ``text``) of all rows, and the same with each document once."""
    doc, tie, shared = _identity(docs, id_col, text_col)
    rows = docs.select(doc.alias("doc"), tie.alias("tie"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows, rows.dropDuplicates(["doc", "tie"]) if shared else rows


def repeated_spans(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, hot_anchor: int = HOT_ANCHOR) -> DataFrame:
    """(``doc``, ``tie``, ``spans``) of ``identified`` documents: the maximal stretches (start, end) whose bytes are
    covered by strings that start earlier as well, packed as 64-bit numbers."""
    sifted = checkpointed(_first_pass(_runs(rows, width, gram), width))
    whole = sifted.where("dup").select("doc", "tie", "start", "length")
    inner = _second_pass(rows, sifted.where("not dup").select("anchor", "doc", "tie", "run"), width, hot_anchor)
    places = whole.unionByName(inner).repartition("doc", "tie").sortWithinPartitions("doc", "tie", "start")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key: tuple, spans: list[np.ndarray]) -> pa.RecordBatch:
            packed = np.concatenate(spans).astype("<i8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                                               pa.array([packed], pa.binary())], ["doc", "tie", "spans"])

        key, held = None, []  # the open document, and its merged (start, end) pairs
        for batch in batches:
            doc, tie, start, length = (batch.column(i).to_numpy() for i in range(4))
            cuts = np.flatnonzero((doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)]):
                if a == b:
                    continue
                if (doc[a], tie[a]) != key:
                    if held:
                        yield row(key, held)
                    key, held = (doc[a], tie[a]), []
                last = held.pop() if held else np.zeros((0, 2), np.int64)
                pairs = np.concatenate([np.stack([last[:, 0], last[:, 1] - last[:, 0]], axis=1)[-1:],
                                        np.stack([start[a:b], length[a:b]], axis=1)])
                held += [x for x in (last[:-1], np.array(merged(pairs), np.int64)) if len(x)]
        if held:
            yield row(key, held)

    return map_batches(places, merge, "doc bigint, tie bigint, spans binary")


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the maximal runs of bytes that (start, length) pairs cover."""
    if not len(spans):
        return []
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    start, end = spans[:, 0], np.maximum.accumulate(spans.sum(axis=1))
    opens = np.concatenate([[True], start[1:] > end[:-1]])
    closes = np.append(np.flatnonzero(opens)[1:] - 1, len(spans) - 1)
    return list(zip(start[opens].tolist(), end[closes].tolist()))


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    starts, ends = [0, *(b for _, b in spans)], [*(a for a, _ in spans), len(data)]
    return b"".join(data[a:b] for a, b in zip(starts, ends))


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    gram: int = GRAM, hot_anchor: int = HOT_ANCHOR) -> DataFrame:
    """id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row; no other columns."""
    rows, once = identified(docs, id_col, text_col)
    spans = repeated_spans(once, width, gram, hot_anchor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc, packed, found in zip(*(batch.column(i) for i in range(3))):
                data, runs = unpack.decompress(packed.as_py()), _spans(found)
                digest = hashlib.sha256(_kept(data, runs)).hexdigest()
                out.append((doc.as_py(), len(data), sum(b - a for a, b in runs), len(runs), digest))
            if out:
                kinds = [*[pa.int64()] * 4, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)],
                                                 ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _packed(rows).join(spans, ["doc", "tie"], "left").select("doc", "packed", "spans")
    found = map_batches(joined, run, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return found.withColumn("doc", F.when(F.col("doc") != _LAST, F.col("doc"))).withColumnRenamed("doc", id_col)


def _spans(found: pa.Scalar) -> list[tuple[int, int]]:
    return list(map(tuple, np.frombuffer(found.as_py() or b"", "<i8").reshape(-1, 2).tolist()))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
                    width: int = WIDTH, gram: int = GRAM, hot_anchor: int = HOT_ANCHOR) -> DataFrame:
    """``docs`` with all their columns, the repeated passages cut out of the text.

    Bytes of characters that a cut went through go too.  Rows of which nothing is left go.  ``length_col``,
    if named, is set to the number of characters left.
    """
    doc, tie, _ = _identity(docs, id_col, text_col)
    _, once = identified(docs, id_col, text_col)
    mark = uuid.uuid4().hex  # for columns beside the rows' own, whatever their names
    spans = repeated_spans(once, width, gram, hot_anchor).withColumnsRenamed(
        {"doc": f"doc_{mark}", "tie": f"tie_{mark}", "spans": f"spans_{mark}"})
    keyed = docs.withColumns({f"doc_{mark}": doc, f"tie_{mark}": tie}).join(spans, [f"doc_{mark}", f"tie_{mark}"], "left")
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, left = batch.column(names.index(text_col)), []
            for text, found in zip(texts, batch.column(len(names))):
                runs = _spans(found)
                left.append(_kept(text.as_py().encode(), runs).decode("utf-8", "ignore") if runs else text.as_py())
            kept = pa.array(left, texts.type)
            columns = batch.columns[: len(names)]
            columns[names.index(text_col)] = kept
            if length_col is not None:
                at = names.index(length_col)
                changed = pc.invert(pc.equal(kept, texts).fill_null(True))
                columns[at] = pc.if_else(changed, pc.utf8_length(kept).cast(columns[at].type), columns[at])
            gone = pc.and_(pc.equal(pc.binary_length(kept), 0), pc.greater(pc.binary_length(texts), 0))
            yield pa.RecordBatch.from_arrays(columns, names).filter(pc.invert(gone.fill_null(False)))

    return map_batches(keyed.select(*(f"`{n}`" for n in names), f"spans_{mark}"), run, schema)
