"""Operator 9, byte-level BPE: ids of whole texts by a local rank file, and the bytes they decode to.

``tiktoken`` encodes by the ranks of a local file (nothing is fetched).  Its pattern never joins a
non-blank to a white-space character behind it, and a run of white space looks ahead only to what
ends it; so a cut in front of such a run gives two texts whose matches are those of the whole.
Long texts are cut there into pieces of bounded size, which bounds the library's working memory;
a stretch without white space stays whole, as its matches may span it.  Decoding joins raw
bytes: a token may end inside a UTF-8 character.

One pass over the documents without a shuffle.

Defined results: a null text counts as empty (no ids, digests of zero bytes); every input row gives one
row; strings that look like special tokens are ordinary text; an empty table gives an empty
result; other columns are neither read nor returned.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import map_batches, text_chunks, worker_state

PIECE_CHARS = 1 << 16  # a longer text is cut at the first safe place behind this many characters
_SAFE = re.compile(r"(?<=\S)\s")


class ByteBpe:
    def __init__(self, rank_path: str, pattern: str):
        import tiktoken

        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = {rank: token for token, rank in ranks.items()}

    def pieces(self, text: str, size: int = PIECE_CHARS) -> Iterator[str]:
        start = 0
        while len(text) - start > size:
            cut = _SAFE.search(text, start + size)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for piece in self.pieces(text):
            ids += self.encoding.encode_ordinary(piece)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """id, ``ids`` (array of int) and ``decoded`` (binary) of every row's whole text."""
    return _encoded(docs, rank_path, pattern, id_col, text_col, "ids array<int>, decoded binary",
                    lambda ids, raw: (ids, raw))


def encode_digests(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """id, ``n_tokens`` and the SHA-256 of the ids and of the decoded bytes, without moving either."""
    return _encoded(docs, rank_path, pattern, id_col, text_col,
                    "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                    lambda ids, raw: (len(ids), hashlib.sha256(id_bytes(ids)).hexdigest(),
                                      hashlib.sha256(raw).hexdigest()))


def _encoded(docs, rank_path, pattern, id_col, text_col, columns, row) -> DataFrame:
    names = [part.split()[0] for part in columns.split(", ")]
    types = {"ids": pa.list_(pa.int32()), "decoded": pa.binary(), "n_tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_state((ByteBpe, rank_path, pattern), lambda: ByteBpe(rank_path, pattern))
        for keys, texts in text_chunks(batches):
            rows = [row(ids := bpe.encode(text), bpe.decode(ids)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(values, types.get(name, pa.string())) for name, values in zip(names, zip(*rows)))],
                ["id", *names])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, run, f"id {kind}, {columns}", keeps=True).withColumnRenamed("id", id_col)
