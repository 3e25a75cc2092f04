"""Operator 10, packing token ids into windows by Karmarkar-Karp multiway differencing.

A document is its ids followed by one end id.  Whole windows are cut off its front; each is a full
sequence.  What is left is cut into grains of at most ``GRAIN`` ids, and the grains of a block of
about ``BLOCK`` ids are dealt to ``k`` windows by multiway differencing: every grain starts as a
partial partition of its own; again and again the two partial partitions with the largest
imbalance are merged, the fullest windows of the one with the emptiest of the other.  ``k``
starts at the least count that could hold the block and rises whenever the fullest window
exceeds the capacity.  The windows come out nearly equal, so padding stays well under a hundredth.

Blocks are made inside the input's partitions: one pass, no shuffle, and a worker holds one block.
A run's last block may be small; its padding is at most about one window for each partition.
Sequence ids are (partition, number in the partition), the same in every attempt of a task.

Words are looked up, each different one of a stretch of texts once: the vocabulary's normaliser and splitter work
on stretches between blanks, so the ids of such a stretch do not depend on its neighbours.  A bounded number of words
is kept; the others go to the library, many at a time.

Defined results: a null text counts as empty and gives one piece, the end id; every input row is packed,
repeated rows included; a null id stays null; an empty table gives an empty result; other columns
are neither read nor returned.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import byte_column, map_batches, worker_state

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 2048
GRAIN = 512  # a document's rest is cut into pieces of at most this many ids
BLOCK = 1 << 19  # ids whose grains are dealt together
SPAN = 1 << 21  # bytes of text whose words are looked up together
KEPT_WORDS = 500_000  # encoded words that a worker keeps
_KEPT_BYTES = 128
_BLANK, _LETTER, _DIGIT, _PUNCTUATION, _ODD = range(5)


class WordEncoder:
    """Ids of whole texts through a table of words.

    Texts are taken as UTF-8 bytes and cut, many at a time, where the vocabulary's splitter cuts too: at blanks,
    around digits, and between letters and punctuation.  Letters are lower-cased there, each by itself, as the
    normaliser does, so that words that differ in case only are one.  A stretch between blanks that holds anything
    else (apostrophes, marks, other scripts, special strings) stays whole and as it is.
    Words that are not in the table go to the library, many at a time, joined by a mark that none of
    them holds and that is one id.  For words of the letters a to z its normaliser and splitter have nothing left
    to do, so they go to its merges alone.
    """

    MARK, LETTERS_MARK = "\x01", "!"

    def __init__(self, tokenizer_path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.merges = Tokenizer.from_file(tokenizer_path), Tokenizer.from_file(tokenizer_path)
        for tokenizer in (self.tokenizer, self.merges):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        self.merges.normalizer, self.merges.pre_tokenizer = None, pre_tokenizers.CharDelimiterSplit(" ")
        self.kept: dict[bytes, bytes] = {}
        self.limit = kept
        self._read_alphabet()

    def _library(self, texts: list[str], tokenizer: Tokenizer) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _read_alphabet(self) -> None:
        """Kinds and lower case of bytes, and of the letters of two bytes, as the tokenizer itself treats them."""
        special = {token.content[0] for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.kind, self.lower = np.full(256, _ODD, np.uint8), np.arange(256, dtype=np.uint8)
        for code in range(128):
            char = chr(code)
            if char in " \t\n\v\f\r":
                self.kind[code] = _BLANK
            elif char.isprintable() and char != "'" and char not in special:
                self.kind[code] = _LETTER if char.isalpha() else _DIGIT if char.isdigit() else _PUNCTUATION
        self.lower[ord("A") : ord("Z") + 1] += 32
        self.kind[128:] = _LETTER  # unless the first byte of the character says otherwise
        self.plain, self.pairs = np.zeros(2048, bool), np.zeros((2048, 2), np.uint8)
        for code in range(128, 2048):
            low = self.tokenizer.normalizer.normalize_str(chr(code))
            between = self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{low}a")
            if chr(code).isalpha() and len(low) == 1 and len(low.encode()) == 2 and len(between) == 1:
                self.plain[code], self.pairs[code] = chr(code) not in special, list(low.encode())

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Starts of the words of texts that lie one behind the other, and the words."""
        kind, low = self.kind[data], self.lower[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            code = (data[lead] & 31).astype(np.int64) << 6 | data[lead + 1] & 63
            plain = self.plain[code] & (data[lead] < 0xE0)
            kind[lead[~plain]] = _ODD
            lead, code = lead[plain], code[plain]
            low[lead], low[lead + 1] = self.pairs[code].T
        blank = kind == _BLANK
        new, bare = kind == _DIGIT, blank.copy()
        new[1:] |= kind[1:] != kind[:-1]
        bare[1:] |= blank[:-1]
        text = offsets[:-1][offsets[:-1] < len(data)]
        new[text] = bare[text] = True
        starts = np.flatnonzero(new)
        if len(odd := np.flatnonzero(kind == _ODD)):
            outer = bare[starts]  # where a stretch or the blanks behind it begin
            stretches = starts[outer]
            whole = np.zeros(len(stretches), bool)
            whole[np.searchsorted(stretches, odd, "right") - 1] = True
            starts = starts[outer | ~whole[np.cumsum(outer) - 1]]
            np.copyto(low, data, where=np.repeat(whole, np.diff(stretches, append=len(data))))
        word = ~blank[starts]
        ends = np.concatenate([[0], np.cumsum(np.diff(starts, append=len(data))[word])]).astype(np.int32)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(low[~blank])]
        return starts[word], pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)

    def _joined(self, words: list[bytes], mark: str, tokenizer: Tokenizer) -> dict[bytes, bytes]:
        """Ids of ``words`` from few calls of the library."""
        found, (mark_ids,) = {}, self._library([mark], tokenizer)
        if len(mark_ids) != 4:
            raise ValueError("the joining mark must be one id of this vocabulary")
        for at in range(0, len(words), 512):
            group = words[at : at + 512]
            ids = self._library([f" {mark} ".encode().join(group).decode()], tokenizer)[0]
            places = (np.flatnonzero(np.frombuffer(ids, "<u4") == np.frombuffer(mark_ids, "<u4")) * 4).tolist()
            starts, ends = [0, *(p + 4 for p in places)], [*places, len(ids)]
            found.update(zip(group, map(ids.__getitem__, map(slice, starts, ends)), strict=True))
        return found

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of ``words``, which are not in the table; the table keeps what it has room for."""
        mark = self.MARK.encode()
        short, odd, letters, others = [], [], [], []
        for word in words:
            (odd if mark in word or len(word) > _KEPT_BYTES else short).append(word)
        for word in short:
            (letters if word.isalpha() and word.islower() else others).append(word)  # of bytes: a to z
        found = self._joined(letters, self.LETTERS_MARK, self.merges) | self._joined(others, self.MARK, self.tokenizer)
        found.update(zip(odd, self._library([word.decode() for word in odd], self.tokenizer)))
        if len(self.kept) + len(short) <= self.limit:
            self.kept.update((word, found[word]) for word in short)
        return found

    def _span(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, words = self._cut(data, offsets)
        words = words.dictionary_encode()
        places, words = np.asarray(words.indices), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = list(map(self.kept.get, words))
        if missing := [word for word, value in zip(words, values) if value is None]:
            learned = self._learn(missing)
            values = [learned[word] if value is None else value for word, value in zip(words, values)]
        sizes = np.fromiter(map(len, values), np.int64, len(values)) >> 2
        table, counts = np.frombuffer(b"".join(values), "<u4"), sizes[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = (np.cumsum(sizes) - sizes)[places] - ends[:-1]
        ids = table[np.repeat(first, counts) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(starts, offsets)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_bytes(*byte_column(pa.array(texts, pa.string())))

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of the texts that lie between ``offsets`` in ``data``; one long text is cut at blanks."""
        if len(offsets) == 2 and len(data) > SPAN:
            blanks = np.flatnonzero(self.kind[data] == _BLANK)
            cuts = np.unique(blanks[np.searchsorted(blanks[:-1], np.arange(SPAN, len(data), SPAN))]) if len(blanks) else []
            return [np.concatenate([self._span(part, np.array([0, len(part)]))[0] for part in np.split(data, cuts)])]
        ids, ends = self._span(data, offsets)
        return np.split(ids, ends[1:-1])


def multiway_difference(sizes: list[int], k: int) -> list[list[int]]:
    """``k`` windows (lists of indexes into ``sizes``) by Karmarkar-Karp differencing.

    A partial partition is kept as the sums of its non-empty windows, largest first, and a
    node for each; merging two windows makes a node above theirs.
    """
    parts = {i: (np.array([size]), np.array([i])) for i, size in enumerate(sizes)}
    heap = [(-size if k > 1 else 0, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    children: list[tuple[int, int]] = []
    number = len(sizes)
    while len(heap) > 1:
        a_sums, a_nodes = parts.pop(heapq.heappop(heap)[1])
        b_sums, b_nodes = parts.pop(heapq.heappop(heap)[1])
        a, b = min(len(a_sums), k - len(b_sums)), min(len(b_sums), k - len(a_sums))  # alone in their windows
        sums = np.concatenate([a_sums[:a], b_sums[:b], a_sums[a:] + b_sums[b:][::-1]])
        left, right = a_nodes[a:], b_nodes[b:][::-1]
        above = np.arange(len(sizes) + len(children), len(sizes) + len(children) + len(left))
        children.extend(zip(left.tolist(), right.tolist()))
        nodes = np.concatenate([a_nodes[:a], b_nodes[:b], above])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        parts[number] = sums, nodes
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == k else 0)), number))
        number += 1
    windows = []
    for node in (parts.popitem()[1][1].tolist() if parts else []):
        members, stack = [], [node]
        while stack:
            node = stack.pop()
            if node < len(sizes):
                members.append(node)
            else:
                stack.extend(children[node - len(sizes)])
        windows.append(sorted(members))
    return windows


def fill_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: the count rises from the least possible until all fit.

    It rises in growing steps (grains of equal sizes may need a good many windows more), and the last
    step is halved back to the smallest count that still fits.
    """

    def fitted(k: int) -> list[list[int]] | None:
        windows = multiway_difference(sizes, k)
        return windows if all(sum(sizes[i] for i in window) <= capacity for window in windows) else None

    count = max(1, -(-sum(sizes) // capacity))
    short, step = count - 1, 1
    while (windows := fitted(count)) is None:
        short, count, step = count, count + step, 2 * step
    while count - short > 1:
        middle = (short + count) // 2
        if (fewer := fitted(middle)) is not None:
            windows, count = fewer, middle
        else:
            short = middle
    return windows


def byte_chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of texts in runs of at most ``limit`` bytes or one longer text, nulls as empty texts."""
    for batch in batches:
        data, offsets = byte_column(batch.column(1))
        start, rows = 0, batch.num_rows
        while start < rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            yield (batch.column(0).slice(start, stop - start), data[offsets[start] : offsets[stop]],
                   offsets[start : stop + 1] - offsets[start])
            start = stop


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row for each piece: id, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``,
    ``ids_crc32`` and, ``with_ids``, the piece's ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state((WordEncoder, tokenizer_path), lambda: WordEncoder(tokenizer_path))
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        sequences = iter(range(first, first + (1 << 32)))
        end = np.array([end_id], "<u4")

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            keys, start, ids, total, sequence, offset = zip(*pieces)
            columns = [pa.array(keys, key_type), pa.array(start, pa.int64()),
                       pa.array(list(map(len, ids)), pa.int64()),
                       pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                       pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            if with_ids:
                columns.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, names)

        def deal(grains: list[tuple]) -> list[tuple]:
            out = []
            for window in fill_windows([len(g[2]) for g in grains], capacity):
                sequence, offset = next(sequences), 0
                for key, start, ids, total in (grains[i] for i in window):
                    out.append((key, start, ids, total, sequence, offset))
                    offset += len(ids)
            return out

        key_type, grains, waiting = None, [], 0
        for keys, data, offsets in byte_chunks(batches, SPAN):
            key_type, whole = keys.type, []
            for key, ids in zip(keys.to_pylist(), encoder.encode_bytes(data, offsets)):
                ids = np.concatenate([ids, end])
                cut = len(ids) // capacity * capacity
                whole += [(key, i, ids[i : i + capacity], len(ids), next(sequences), 0) for i in range(0, cut, capacity)]
                grains += [(key, i, ids[i : i + GRAIN], len(ids)) for i in range(cut, len(ids), GRAIN)]
                waiting += len(ids) - cut
                if waiting >= BLOCK:
                    whole += deal(grains)
                    grains, waiting = [], 0
            if whole:
                yield rows(whole)
        if grains:
            yield rows(deal(grains))

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{name} bigint" for name in names[1:7]) + ", ids array<bigint>" * with_ids
    return map_batches(source, run, schema, keeps=True).withColumnRenamed("id", id_col)
