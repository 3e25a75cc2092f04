"""Operator 4 against hashes by Spark and all pairs by brute force."""

import random

import numpy as np
import pytest
import xxhash

from gearwatch.llm import components as components_module
from gearwatch.llm import queries, simhash
from gearwatch.llm.components import components
from gearwatch.llm.simhash import fingerprint, links, simhash_components, trie_join
from tests.llm.helpers import SF, empty_documents, odd_documents, random_texts, texts_by_id


def brute_fingerprint(text):
    import re

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def group_of(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    group = group_of(len(fps), near)
    least = {}
    for (i, _), g in zip(rows, group):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(rows, fps, group)), key=str)


def check(df, docs):
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str) == \
        brute_components(texts_by_id(docs))


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 999)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 99)}"
        out.append(" ".join(words))
    return out


def test_hash_is_sparks(spark):
    row = spark.sql("select xxhash64('ab cd ef gh') h").first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"ab cd ef gh", 42)


def test_fingerprint():
    for text in random_texts(100, seed=5) + ["", "A b", "\x1c x\x0by\x0c", "Ä a", "a b c d e " * 15_000]:
        assert fingerprint(text) == brute_fingerprint(text)


def test_op4_whole_table(spark):
    check(queries.op4_simhash(spark, SF), spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize("hot_key", [100_000, 3])
def test_near_copies_and_odd_rows(spark, hot_key):
    docs = odd_documents(spark, near_copies(120, 1) + near_copies(3, 2))
    check(simhash_components(docs, hot_key=hot_key), docs)


def test_hot_keys_are_dealt_until_they_are_small(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_GROUP_ROWS", 25)
    docs = odd_documents(spark, near_copies(60, 3))
    check(simhash_components(docs, hot_key=10), docs)


def test_empty(spark):
    assert simhash_components(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_trie_join_is_a_forest_of_all_pairs(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(simhash, "_LEAF_PAIRS", int(rng.choice([1, 4, 64])))
    monkeypatch.setattr(simhash, "_FRONTIER", int(rng.choice([3, 50, 100_000])))
    rest = rng.integers(0, 1 << 42, 5)[rng.integers(0, 5, 300)]
    for _ in range(8):
        rest = rest ^ np.where(rng.random(300) < 0.6, 1 << rng.integers(0, 42, 300), 0)
    keys, rest = np.unique(np.stack([rng.integers(0, 3, 300), rest], 1), axis=0).T.copy()

    def near(i, j):
        return keys[i] == keys[j] and int(rest[i] ^ rest[j]).bit_count() <= 4

    edges = trie_join(keys, rest, 42, 4)
    assert all(near(i, j) for i, j in edges) and len(edges) < len(keys)
    pairs = [(i, j) for i in range(len(keys)) for j in range(i) if near(i, j)]
    assert group_of(len(keys), edges) == group_of(len(keys), pairs)


def test_links_cover_every_block(spark):
    """Pairs that differ in up to four bits, in any place, are found; five are not."""
    rng = random.Random(4)
    pairs = []
    for n in (1, 2, 3, 4, 5):
        for _ in range(60):
            a, b = rng.getrandbits(64), 0
            for bit in rng.sample(range(64), n):
                b |= 1 << bit
            pairs.append((a - 2**63, (a ^ b) - 2**63, n))
    nodes = spark.createDataFrame([(x,) for a, b, _ in pairs for x in (a, b)], "fp bigint").distinct()
    for hot in (100_000, 0):
        found = {frozenset(r) for r in links(nodes, 4, hot).collect()}
        assert found == {frozenset((a, b)) for a, b, n in pairs if n <= 4}


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (7, 7)]
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == {**dict.fromkeys(range(201), 0), 400: 400, 450: 400, 500: 400}


def test_components_around_hubs(spark, monkeypatch):
    """Hubs beyond the bound, a component without a hub, and nodes that are structs."""
    monkeypatch.setattr(components_module, "HUB_LINKS", 20)
    hub = [(7, i) for i in range(1000, 1400)] + [(9, i) for i in range(2000, 2300)] + [(1399, 2000)] + [(1, 3)]
    rows = components(spark.createDataFrame(hub, "a bigint, b bigint")).collect()
    want = {x: 7 for edge in hub for x in edge} | {1: 1, 3: 1}
    assert {r.node: r.component for r in rows} == want and len(rows) == len(want)
    pairs = spark.createDataFrame(hub, "x bigint, y bigint").selectExpr("struct(null as k, x as v) a", "struct(null as k, y as v) b")
    assert {r.node.v: r.component.v for r in components(pairs).collect()} == want


def test_a_component_of_a_million_nodes(spark):
    """One hub with 10^6 links, given in both directions and twice over."""
    links_of_hub = spark.range(1, 1_000_001).selectExpr("id a", "0L b")
    edges = links_of_hub.union(links_of_hub.selectExpr("b a", "a b"))
    row = components(edges).selectExpr("count(*) n", "count(distinct node) d", "max(component) c").first()
    assert (row.n, row.d, row.c) == (1_000_001, 1_000_001, 0)


def test_rounds_are_written_in_few_parts(spark, monkeypatch):
    """A few edges are not written as a file for each of many shuffle partitions, round after round."""
    parts, whole = [], components_module.checkpointed

    def counted(df):
        out = whole(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(components_module, "checkpointed", counted)
    settings = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = [(i, i + 1) for i in range(40)]
        rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
        few, parts[:] = max(parts[1:]), []
        monkeypatch.setattr(components_module, "PART_EDGES", 2)  # many edges are dealt to as many parts as they need
        more = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.node, r.component) for r in rows} == {(r.node, r.component) for r in more} == {(i, 0) for i in range(41)}
    assert few <= spark.sparkContext.defaultParallelism < 61
    assert max(parts[1:]) >= 20


def test_no_files_for_hot_keys_that_are_none(spark, monkeypatch):
    def never(df):
        raise AssertionError("an empty list of hot keys was written")

    monkeypatch.setattr(simhash, "checkpointed", never)
    nodes = spark.createDataFrame([(0b0,), (0b111,), (1 << 62,)], "fp bigint")
    assert {tuple(sorted((r.a, r.b))) for r in links(nodes).collect()} >= {(0, 0b111)}
