"""Operator 1, token counts with a whole-token shortcut.

The vocabulary is a byte-fallback BPE whose pieces hold the word mark only at their front
(``WordCounter`` proves it for the file it is given), so no merge crosses the start of a run
of blanks: a text splits there into *pre-tokens* whose counts add up.  Offline, every piece that begins
with one mark is encoded alone; those that come back as one token are counted by a look-up
without merging.  Only the other pre-tokens are merged, by the library itself, and the
counts of a bounded number of them are kept.

One pass over the documents without a shuffle; a worker holds the vocabulary, the bounded
table and one batch.

Defined results: a null text counts as empty (0 bytes, 0 tokens); every input row gives one row,
repeated rows included; a null id stays null; an empty table gives an empty result;
other columns are neither read nor returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import map_batches, text_chunks, worker_state

MARK = "▁"  # how the vocabulary writes a blank
KEPT_WORDS = 400_000  # counts of merged pre-tokens that a worker keeps
_KEPT_CHARS = 64  # longer pre-tokens are merged anew each time
_RUNS = re.compile(" +[^ ]*")


class WordCounter(dict):
    """Pre-token (without its first blank) -> number of tokens; merges and remembers what it lacks."""

    def __init__(self, model_path: str, kept: int = KEPT_WORDS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in piece.lstrip(MARK) for piece in pieces) or MARK not in pieces:
            raise ValueError("a piece of this vocabulary spans a word start; pre-tokens would not be independent")
        words = [piece[1:] for piece in pieces if piece.startswith(MARK) and len(piece) > 1]
        whole = [w for w, ids in zip(words, self.model.encode(words, num_threads=1)) if len(ids) == 1]
        super().__init__(dict.fromkeys(whole, 1))
        self[""] = 1  # a blank with nothing behind it: the mark alone
        self.limit = len(self) + kept

    def __missing__(self, word: str) -> int:
        n = len(self.model.EncodeAsIds(word))
        if len(self) < self.limit and len(word) <= _KEPT_CHARS:
            self[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")  # the library does not tell the two apart
        if "  " in text or text[0] == " ":
            return sum(self[run[1:]] for run in _RUNS.findall(" " + text))
        return sum(map(self.__getitem__, text.split(" ")))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """id, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state((WordCounter, model_path), lambda: WordCounter(model_path))
        for ids, texts in text_chunks(batches):
            n_tokens = pa.array([counter.count(text) for text in texts], pa.int64())
            n_bytes = pc.cast(pc.binary_length(pa.array(texts, pa.large_string())), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                                             ["id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    counted = map_batches(source, run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", keeps=True)
    return counted.withColumnRenamed("id", id_col)
