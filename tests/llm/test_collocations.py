"""Operator 11 against phrases counted one by one."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from gearwatch.llm import collocations as module
from gearwatch.llm import queries
from gearwatch.llm.collocations import collocations, phrase_counts
from tests.llm.helpers import SF, empty_documents, odd_documents
from tests.oracle_check import compare

LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows):
    phrases, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    phrases[lang][tuple(words[i:i + size])] += 1
    return phrases, total


def brute(rows, min_count, percent=100, top=2000):
    phrases, total = counted(rows)
    out = []
    for lang, counts in phrases.items():
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        left_out = {q for p, c in candidates.items() for size in range(2, len(p)) for i in range(len(p) - size + 1)
                    if 100 * c >= percent * counts[q := p[i:i + size]]}
        scored = []
        for p, a in candidates.items():
            if p not in left_out:
                score, k = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def check(spark, rows, min_count, **options):
    found = collocations(spark.createDataFrame(rows, "lang string, text string"), min_count=min_count, **options)
    assert sorted(map(tuple, found.collect())) == brute(rows, min_count, options.get("percent", 100), options.get("top", 2000))


def prose(n, seed):
    rng = random.Random(seed)
    parts = ["the cat", "sat on the mat", "new york", "of the", "in the new", "x", "y", "Ünder", "of", "a a a a a a a"]
    return [(rng.choice(["en", "en", "fr", None, "und"]),
             " ".join(rng.choice(parts) + rng.choice(["", "", ",", ". ", "\n", "\t"]) for _ in range(rng.randrange(40))))
            for _ in range(n)]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, queries.op11_collocations(spark, SF).collect())) == brute(rows, 100)


def test_oracle(spark):
    result = compare(spark, "/root/testdata/sf0.01", ["op11_collocations"])["op11_collocations"]
    assert result[0] == "OK" and result[1] > 50, result


@pytest.mark.parametrize("seed", range(3))
def test_random_prose(spark, seed):
    check(spark, prose(120, seed), min_count=3 + 4 * seed)


def test_colliding_marks_change_nothing(spark):
    """A bitmap of 2^9 bits for some thousand phrases: windows stay longer, counts the same."""
    check(spark, prose(80, 9), min_count=4, bits=9, salt=3)


@pytest.mark.parametrize("levels", [1, 2, 3, 5])
def test_any_number_of_passes_gives_the_same(spark, levels):
    check(spark, prose(80, 4), min_count=4, levels=levels)


def test_percent_and_top(spark):
    check(spark, prose(150, 5), min_count=3, percent=60, top=7)


def test_small_steps_inside_long_texts(spark, monkeypatch):
    """Texts of many steps, with and without breaks and blanks: no window is lost or counted twice."""
    rng = random.Random(1)
    words = ["aa", "b", "ccc", "dd"]
    for text in (" ".join(rng.choices(words, k=3000)), "   ".join(rng.choices(words, k=500)) + " " * 900 + "aa b",
                 "z" * 5000 + " aa b aa b", "".join(rng.choice(["aa", " ", ". ", "b "]) for _ in range(4000)), " " * 3000):
        batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array([text, "aa b"])], ["group", "text"])
        monkeypatch.setattr(module, "_STEP", 256)
        total, pairs = Counter(), Counter()
        for found, _ in module._stretches(iter([batch])):
            names = found.vocabulary.to_pylist()
            for i in range(found.heads):
                total[names[found.ids[i]]] += 1
                if found.joined[i]:
                    pairs[names[found.ids[i]], names[found.ids[i + 1]]] += 1
            assert found.heads == len(found.ids) or not found.joined[found.heads:-1].size or len(found.ids) - found.heads == 4
        phrases, _ = counted([("en", text), ("en", "aa b")])
        assert {(k,): v for k, v in total.items()} == {p: c for p, c in phrases["en"].items() if len(p) == 1}
        assert dict(pairs) == {p: c for p, c in phrases["en"].items() if len(p) == 2}


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([(4 * 10**12, 9 * 10**13, 5 * 10**12, 7 * 10**12)], "a long, n long, l long, r long")
    assert frame.select(module._score("a", "n", "l", "r")).first()[0] == 1000 * 4 * 10**12 * 9 * 10**13 // (35 * 10**24)


def test_counts_of_all_sizes(spark):
    rows = prose(60, 2)
    phrases, total = counted(rows)
    frame = spark.createDataFrame(rows, "lang string, text string").selectExpr("coalesce(lang, 'und') AS `group`", "text")
    found = {(r["group"], tuple(r.words)): r.f for r in phrase_counts(frame, 5).collect()}
    expected = {(g, p): c for g in phrases for p, c in phrases[g].items() if c >= 5}
    assert found == expected | {(g, ()): c for g, c in total.items() if c}


def test_odd_texts_repeated_rows_and_clashing_columns(spark):
    docs = odd_documents(spark).unionByName(odd_documents(spark))
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    found = collocations(docs.selectExpr("*", "1 AS phrase", "2 AS w1", "3 AS salt", "4 AS `group`"), min_count=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 2)


def test_empty(spark):
    assert collocations(empty_documents(spark)).collect() == []
