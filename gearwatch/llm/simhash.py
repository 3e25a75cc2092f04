"""Operator 4, SimHash near-duplicates by a self-join of binary tries.

A document's fingerprint has a bit for each position that is set in over half of its shingles' XXH64
hashes.  Equal fingerprints are one node.  To find all pairs within the bit budget, the 64 bits are cut
into ``budget + 2`` blocks: two fingerprints that differ in ``budget`` bits agree wholly in at least two
of them, so every linked pair shares a key (two blocks and their bits).  Under a key, the other bits
form a binary trie.  Pairs of trie nodes are walked down together; the bits in which their
paths differ add up, and a pair over budget is dropped with all below it, as is a pair whose leaves are
in one component already.  So a key gives a spanning forest, never all pairs.  A key with more
than ``HOT_KEY`` fingerprints is dealt again, by blocks of the bits that it leaves open, and so are its sub-keys
while they hold more than a worker joins at a time.

The forests are merged into components by star contractions (``components``).  A node is ordered by its
smallest id, so a component's root has its name with it and members never meet to find it.  What a worker
holds is the fingerprints of one key at a time, and rows of equal fingerprints meet only as counts and
minima; the final join spreads each fingerprint over ``SALT`` sub-keys.

Defined results: a null text, an empty one and one of white space only have fingerprint zero and link like any
other; repeated rows each get a row; a row without an id links, but never names a component
(a component without any id has a null one); an empty table gives an empty result; other columns
are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import checkpointed, map_batches, part_count, text_chunks
from gearwatch.llm.components import components

SHINGLE = 4
BUDGET = 4
HOT_KEY = 100_000  # fingerprints under one key from which it is dealt again
SALT = 8
PART_NODES = 100_000
_SEED = 42
_GROUP_ROWS = 1 << 16  # small keys are joined together, about so many rows at a time
_LEAF_PAIRS = 64  # a pair of nodes with at most so many pairs of leaves is compared directly
_FRONTIER = 1 << 17  # node pairs taken at a time


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles (repeats count), as an unsigned 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks part
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ends, ones = ends[len(words) - n :], np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounds what a long text unpacks
        part = slice(at, at + (1 << 16))
        hashes = np.array([digest(line[a:b], _SEED) for a, b in zip(starts[:n][part].tolist(), ends[part].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(``id``, ``fp``) of every row; ``fp`` holds the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches):
            found = np.array([fingerprint(text, shingle) for text in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found)], ["id", "fp"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(source, run, f"id {source.schema['id'].dataType.simpleString()}, fp bigint")


def _blocks(width: int, count: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of ``count`` blocks of about equal size."""
    edges = [width * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _deal(rows: DataFrame, bits: str, width: int, budget: int, name: str, above: str | None = None) -> DataFrame:
    """Each row under the keys of its blocks: ``key``, ``rest`` (the other bits, side by side) and its ``name``."""
    blocks = _blocks(width, budget + 2)
    dealt = []
    for number, pair in enumerate(combinations(range(len(blocks)), 2)):
        def joined(chosen):
            value, at = F.lit(0).cast("bigint"), 0
            for first, size in (blocks[i] for i in chosen):
                part = F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << size) - 1))
                value, at = value.bitwiseOR(F.shiftleft(part, at)), at + size
            return value
        inside = joined(pair)
        key = F.xxhash64(F.lit(number), inside, F.col(above)) if above else inside.bitwiseOR(F.lit(number << 48))
        dealt.append(F.struct(key.alias("key"), joined([i for i in range(len(blocks)) if i not in pair]).alias("rest")))
    return rows.withColumn("d", F.explode(F.array(*dealt))).select("d.key", "d.rest", name)


class _Forest:
    """Union-find over numbered leaves; ``label`` is each leaf's smallest member, brought up to date in bulk."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def link(self, a: np.ndarray, b: np.ndarray) -> bool:
        la, lb = self.label[a], self.label[b]
        apart = la != lb
        if not apart.any():
            return False
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        _, first = np.unique(np.stack([np.minimum(la, lb), np.maximum(la, lb)], 1), axis=0, return_index=True)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for i in first.tolist():
            x, y = find(int(la[i])), find(int(lb[i]))
            if x != y:
                root[max(x, y)] = min(x, y)
                self.edges.append((int(a[i]), int(b[i])))
        old = np.array(list(root))
        up = np.arange(len(self.label))
        up[old] = [find(x) for x in old.tolist()]
        self.label = up[self.label]
        return True


def trie_join(keys: np.ndarray, rest: np.ndarray, width: int, budget: int) -> list[tuple[int, int]]:
    """Edges (row, row) of a spanning forest of the pairs with one key and at most ``budget`` differing bits.

    Rows are ordered by key and ``rest``, so that a trie node is a run of rows.
    """
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.append(starts[1:], len(keys))
    several = ends - starts > 1
    starts, ends = starts[several], ends[several]
    forest = _Forest(len(keys))
    ones: dict[int, np.ndarray] = {}
    zero = np.zeros(len(starts), np.int64)
    stack = [(0, (starts, ends, starts, ends, zero))]
    same = None  # same[i]: how often, up to row i, a row has the label of the row before
    while stack:
        depth, (a, b, c, d, differing) = stack.pop()
        if len(a) > _FRONTIER:
            stack.append((depth, tuple(x[_FRONTIER:] for x in (a, b, c, d, differing))))
            a, b, c, d, differing = (x[:_FRONTIER] for x in (a, b, c, d, differing))
        if forest.edges:
            if same is None:
                same = np.concatenate([[0], np.cumsum(forest.label[1:] == forest.label[:-1])])
            joined = ((same[b - 1] - same[a] == b - 1 - a) & (same[d - 1] - same[c] == d - 1 - c)
                      & (forest.label[a] == forest.label[c]))
            a, b, c, d, differing = (x[~joined] for x in (a, b, c, d, differing))
        few = ((b - a) * (d - c) <= _LEAF_PAIRS) | (depth == width)
        if few.any():
            n = ((b - a) * (d - c))[few]
            for at in range(0, len(n), 1 << 14):  # bounds what the comparison unpacks
                part = slice(at, at + (1 << 14))
                size = n[part]
                pair = np.repeat(np.arange(len(size)), size)
                within = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
                across = (d - c)[few][part][pair]
                x, y = a[few][part][pair] + within // across, c[few][part][pair] + within % across
                close = (x < y) & (np.bitwise_count(rest[x] ^ rest[y]) <= budget)
                if forest.link(x[close], y[close]):
                    same = None
            a, b, c, d, differing = (v[~few] for v in (a, b, c, d, differing))
        if not len(a):
            continue
        if depth not in ones:
            bit = (rest >> np.int64(width - 1 - depth)) & 1
            ones[depth] = np.concatenate([[0], np.cumsum(bit)])
        count = ones[depth]
        m, k = b - (count[b] - count[a]), d - (count[d] - count[c])  # where the ones begin
        own = a == c
        down = [(a, m, c, k, differing), (m, b, k, d, differing), (a, m, k, d, differing + 1),
                tuple(x[~own] for x in (m, b, c, k, differing + 1))]
        down = [np.concatenate(x) for x in zip(*down)]
        a, b, c, d, differing = down
        keep = (b > a) & (d > c) & (differing <= budget)
        near = np.argsort(-differing[keep], kind="stable")  # the closest pairs are taken first
        stack.append((depth + 1, tuple(x[keep][near][::-1] for x in down)))
    return forest.edges


def _forests(dealt: DataFrame, width: int, budget: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(rows: pa.RecordBatch) -> pa.RecordBatch:
            found = trie_join(rows.column(0).to_numpy(), rows.column(1).to_numpy(), width, budget)
            found = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([rows.column(2).take(pa.array(found[:, i])) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= _GROUP_ROWS:
                rows = pa.concat_batches(held)
                keys = rows.column(0).to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield edges(rows.slice(0, cut))
                held = [rows.slice(cut)]
        if held:
            yield edges(pa.concat_batches(held))

    node = dealt.schema[2].dataType.simpleString()
    return map_batches(dealt.repartition("key").sortWithinPartitions("key", "rest"), run, f"a {node}, b {node}")


def _joined(dealt: DataFrame, width: int, budget: int, hot_key: int, name: str) -> DataFrame:
    """Edges of the rows under their keys, which leave at most ``width`` bits open."""
    sizes = dealt.groupBy("key").count().where(F.col("count") > hot_key).select("key", F.lit(True).alias("hot"))
    if width < budget + 2 or sizes.isEmpty():  # mostly: then there is nothing to write
        return _forests(dealt, width, budget)
    marked = dealt.join(checkpointed(sizes), "key", "left")
    again = _deal(marked.where("hot").withColumnRenamed("key", "over").withColumnRenamed("rest", "bits"),
                  "bits", width, budget, name, above="over")
    return _forests(marked.where("hot is null").select("key", "rest", name), width, budget).unionByName(
        _joined(again, _left_open(width, budget), budget, max(hot_key, _GROUP_ROWS), name))


def _left_open(width: int, budget: int) -> int:
    """Bits that the narrowest two blocks of ``width`` bits leave."""
    return width - width // (budget + 2) * 2


def links(nodes: DataFrame, budget: int = BUDGET, hot_key: int = HOT_KEY, name: str = "fp") -> DataFrame:
    """Edges (``a``, ``b``) that connect just the fingerprints ``nodes.fp`` (distinct) within ``budget`` bits.

    Their ends are values of the column ``name``.
    """
    return _joined(_deal(nodes, "fp", 64, budget, name), _left_open(64, budget), budget, hot_key, name)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       budget: int = BUDGET, hot_key: int = HOT_KEY) -> DataFrame:
    """id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id that links reach."""
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    named_by = F.struct(F.col("least").isNull().alias("nameless"), "least", "fp").alias("node")  # nameless ones come last
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least")).select("fp", named_by)
    nodes = checkpointed(nodes.coalesce(part_count(docs.sparkSession, rows.count(), PART_NODES)))
    groups = components(links(nodes, budget, hot_key, "node")).select("node.fp", "component")
    named = nodes.join(groups, "fp", "left").select("fp", F.coalesce("component", "node")["least"].alias("component_id"))
    salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    out = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int")).join(salted, ["fp", "salt"])
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")
