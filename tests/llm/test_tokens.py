"""Operators 1, 9 and 10 against the libraries, called on whole texts."""

import base64
import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gearwatch.llm import queries
from gearwatch.llm.byte_bpe import ByteBpe, encode_digests, encode_documents
from gearwatch.llm.packing import WordEncoder, byte_chunks, fill_windows, multiway_difference, pack_documents
from gearwatch.llm.token_count import WordCounter, token_counts
from tests.llm.helpers import SF, empty_documents, odd_documents, random_texts, texts_by_id

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


# letters whose lower case is longer or shorter than they are, beside what a word may end in
CHANGED = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and len(c.lower()) != 1] + list("İŞĞ")
TEXT = st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tab'sé1.,<|>"), st.sampled_from(CHANGED),
                                  st.characters(exclude_categories=["Cs"])),
               max_size=60)


@settings(max_examples=400, deadline=None)
@given(text=TEXT)
def test_lookups_equal_libraries(text, pieces, word_tokenizer, tiktoken_encoding):
    counter, encoder, bpe = _tools()
    assert counter.count(text) == len(pieces.encode(text))
    assert encoder.encode([text])[0].tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids
    ids = [i for piece in bpe.pieces(text, 3) for i in bpe.encoding.encode_ordinary(piece)]
    assert ids == tiktoken_encoding.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


_TOOLS = []


def _tools():
    if not _TOOLS:
        _TOOLS.extend([WordCounter(MODEL), WordEncoder(WORDS), ByteBpe(RANKS, public_tokenizers.PATTERN)])
    return _TOOLS


def test_words_whose_lower_case_is_longer(word_tokenizer):
    texts = ["EVİ. DENİZİ, bitti", "İ.", "İ İ! İİ? aİ, İa.", "BİR:İKİ; ÜÇ%", "İ" * 40 + ".", "(İ) \"İ\" İ~"]
    expected = [word_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in _tools()[1].encode(texts)] == expected


def test_a_word_is_learnt_once_whatever_its_case_and_punctuation(word_tokenizer):
    encoder, text = WordEncoder(WORDS), "Case CASE case, Case. (case) case1 CASE: École ÉCOLE, école"
    assert encoder.encode([text])[0].tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.kept) <= len({"case", "école", ",", ".", "(", ")", "1", ":"})


_ENCODERS = {}


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(TEXT, max_size=6), kept=st.sampled_from([0, 5, 1000]))
def test_texts_side_by_side_do_not_mix(texts, kept, word_tokenizer):
    if kept not in _ENCODERS:
        _ENCODERS[kept] = WordEncoder(WORDS, kept)
    expected = [word_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in _ENCODERS[kept].encode([*texts, ""])] == [*expected, []]


def test_letters_of_two_bytes(word_tokenizer):
    texts = [f"{c} a{c}b,{c}. {c}{c}'s A{c}\u0301 1{c}2<{c}\t{c}!{c.swapcase()}" for c in map(chr, range(2048))]
    expected = [word_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in _tools()[1].encode(texts)] == expected


def test_long_texts_are_cut_at_blanks(word_tokenizer, monkeypatch):
    monkeypatch.setattr("gearwatch.llm.packing.SPAN", 50)
    texts = [*random_texts(50, size=60), "x" * 200, "x" * 200 + " ", " " + "é'" * 100, " " * 120, "a " * 100]
    expected = [word_tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [_tools()[1].encode([t])[0].tolist() for t in texts] == expected
    batch = pa.record_batch([pa.array(range(len(texts) + 1)), pa.array([*texts, None])], names=["id", "text"])
    chunks = list(byte_chunks(iter([batch.slice(3)]), 50))
    assert [i for keys, _, _ in chunks for i in keys.to_pylist()] == list(range(3, len(texts) + 1))
    assert all(len(data) <= 50 or len(offsets) == 2 for _, data, offsets in chunks)
    found = [ids.tolist() for _, data, offsets in chunks for ids in _tools()[1].encode_bytes(data, offsets)]
    assert found == [*expected[3:], []]


def test_shortcut_holds_only_words_of_one_token(pieces):
    counter = WordCounter(MODEL, kept=0)
    assert len(counter) > 10_000
    assert all(len(pieces.encode(w)) == 1 for w in counter if w)


def test_token_counts(spark, pieces):
    docs = odd_documents(spark, random_texts(30))
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, MODEL, limit=20).collect())
    want = Counter((i, len(t.encode()), n := len(pieces.encode(t)), n > 20) for i, t in texts_by_id(docs))
    assert got == want
    assert token_counts(empty_documents(spark), MODEL).count() == 0


def test_op1_whole_table(spark, pieces):
    want = {i: len(pieces.encode(t)) for i, t in texts_by_id(spark.read.parquet(f"{SF}/documents.parquet"))}
    assert {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, SF).collect()} == want


def test_byte_bpe(spark, tiktoken_encoding):
    docs = odd_documents(spark, [*random_texts(30), "word 12 !? " * 20_000, " " * 70_000 + "x"])

    def row(i, t):
        ids = tiktoken_encoding.encode_ordinary(t)
        return (i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                hashlib.sha256(t.encode()).hexdigest())

    got = Counter(tuple(r) for r in encode_digests(docs, RANKS, public_tokenizers.PATTERN).collect())
    assert got == Counter(row(i, t) for i, t in texts_by_id(docs))
    for r in encode_documents(docs.limit(20), RANKS, public_tokenizers.PATTERN).collect():
        assert tiktoken_encoding.decode_bytes(r.ids) == bytes(r.decoded)
    assert encode_digests(empty_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_op9_whole_table(spark, tiktoken_encoding):
    texts = dict(texts_by_id(spark.read.parquet(f"{SF}/documents.parquet")))
    for r in queries.op9_byte_bpe(spark, SF).collect():
        assert r.n_tokens == len(tiktoken_encoding.encode_ordinary(texts[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_packing(rows, texts, word_tokenizer):
    """Every id of every text in exactly one piece; sequences gapless and within capacity."""
    ids = [(i, [*word_tokenizer.encode(t, add_special_tokens=False).ids, 1]) for i, t in texts]
    by_doc, by_sequence, expected = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, x in ids:
        expected[i].append(x)
    assert set(by_doc) == set(expected)
    for i, found in by_doc.items():
        assert sum(p[1] for p in found) == sum(map(len, expected[i]))
        if len(expected[i]) == 1:  # an id that is unique
            x, at = expected[i][0], 0
            for start, length, crc, total in sorted(found):
                assert (start, total) == (at, len(x)) and length > 0
                assert crc == zlib.crc32(struct.pack(f"<{length}I", *x[start:start + length]))
                at += length
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence), sum(map(lambda x: len(x[1]), ids))


def test_packing(spark, word_tokenizer):
    docs = odd_documents(spark, [*random_texts(200, size=400), "word " * 9000]).coalesce(2)
    check_packing(pack_documents(docs, WORDS).collect(), texts_by_id(docs), word_tokenizer)
    for r in pack_documents(docs, WORDS).collect():
        assert len(r.ids) == r.length
    assert pack_documents(empty_documents(spark), WORDS).count() == 0


def test_op10_whole_table(spark, word_tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sequences, ids = check_packing(queries.op10_packing(spark, SF).collect(), texts_by_id(docs), word_tokenizer)
    assert sequences <= ids / 2048 * 1.02 + 2


@settings(max_examples=100, deadline=None)
@given(sizes=st.lists(st.integers(1, 50), min_size=1, max_size=40), k=st.integers(1, 12))
def test_differencing_deals_every_item_once(sizes, k):
    windows = multiway_difference(sizes, k)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert len(windows) == min(k, len(sizes))
    sums = [sum(sizes[i] for i in w) for w in windows] + [0] * (k - len(windows))
    assert max(sums) - min(sums) <= max(sizes)
    assert all(sum(sizes[i] for i in w) <= 50 for w in fill_windows(sizes, 50))


def test_differencing_balances():
    assert sorted(map(sorted, multiway_difference([8, 7, 6, 5, 4], 2))) in ([[0, 3], [1, 2, 4]], [[0, 2], [1, 3, 4]])
    assert fill_windows([], 10) == []
    assert len(fill_windows([410] * 1000, 2048)) == 250  # five would be two too many
