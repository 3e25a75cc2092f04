"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearwatch.llm.byte_bpe import encode_digests
from gearwatch.llm.collocations import collocations
from gearwatch.llm.common import read_table
from gearwatch.llm.language import identify_languages, labelled_sample
from gearwatch.llm.lattice_lm import lattice_scores
from gearwatch.llm.lz_fingerprint import lz_fingerprints
from gearwatch.llm.maxscore import top_k
from gearwatch.llm.merkle import merkle_manifest
from gearwatch.llm.merkle_sql import statement as merkle_statement
from gearwatch.llm.packing import pack_documents
from gearwatch.llm.radix_dedup import removal_digests
from gearwatch.llm.revisit import capture_log, header_lines, resolve_revisits
from gearwatch.llm.simhash import simhash_components
from gearwatch.llm.token_count import token_counts
from gearwatch.llm.toxicity import toxicity_model, toxicity_scores


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs, shingle=4, budget=4)


def language_samples(docs: DataFrame) -> dict[str, list[str]]:
    """Sample texts of the documents whose id does not hash to the held-out fold."""
    return labelled_sample(docs, fold(4) != 2, "doc_id", "text", "lang")


def fold(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify_languages(docs, language_samples(docs))
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = resolve_revisits(capture_log(pages))
    return found.withColumn("headers", header_lines(F.col("headers")))


def op7_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"), width=100)


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lattice_scores(docs, fold(7) != 2, fold(7) == 2, public_tokenizers.path("piece_bpe_32k.model"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("lang", "text")
    return collocations(docs, min_count=100, percent=100, top=2000)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity_model(docs, labels, fold(4) != 2)
    found = toxicity_scores(docs, model, threshold=0.3)
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    return merkle_manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_lz_fingerprint,
                            op3_maxscore, op4_simhash, op5_language, op6_revisits,
                            op7_radix_dedup, op8_lattice_lm, op9_byte_bpe, op10_packing, op11_collocations,
                            op12_toxicity, op13_merkle)
}

ORACLE_SQL: dict[str, str] = {
    "op3_maxscore": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op6_revisits": r"""
WITH parts AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages
), cut AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda p: p <> ''
           AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS params
  FROM parts
), named AS (
  SELECT page_id, url, html, md5(html) AS payload, '"' || substr(md5(html), 1, 16) || '"' AS tag,
         strftime(DATE '2024-01-01' + CAST(page_id % 36500000 // 50 AS INTEGER), '%Y-%m-%d') AS day,
         host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical_url
  FROM cut
), stored AS (
  SELECT 2 * page_id AS base_id, page_id AS base_page, canonical_url, 10 * (page_id % 100000000000000000) AS captured, payload, day,
         CASE WHEN page_id % 7 <> 0 THEN tag END AS tag, strlen(html) AS size
  FROM named
), asked AS (
  SELECT 2 * page_id + 1 AS record_id, page_id, url, canonical_url, 10 * (page_id % 100000000000000000) + 5 + page_id % 1000 * 7919 % 1000 * 10 AS captured,
         CASE WHEN page_id % 5 IN (0, 2) THEN tag WHEN page_id % 5 = 3 THEN '"other"' END AS tag,
         CASE WHEN page_id % 5 = 2 THEN 'W/' ELSE '' END AS weak,
         CASE WHEN page_id % 5 IN (0, 1) THEN day END AS day
  FROM named
), found AS (
  SELECT a.record_id, a.page_id, a.url, a.canonical_url, a.captured, a.tag AS own_tag, a.weak, a.day AS own_day,
         s.base_id, s.base_page, s.payload, s.day, s.tag, s.size,
         CASE WHEN s.base_id IS NULL THEN 'no_base'
              WHEN a.tag IS NOT NULL AND s.tag IS NOT NULL THEN CASE WHEN a.tag = s.tag THEN 'merged' ELSE 'etag_differs' END
              WHEN a.day IS NOT NULL AND s.day IS NOT NULL THEN CASE WHEN a.day = s.day THEN 'merged' ELSE 'date_differs' END
              ELSE 'no_validator' END AS outcome
  FROM asked a ASOF LEFT JOIN stored s ON a.canonical_url = s.canonical_url AND a.captured > s.captured
)
SELECT record_id, url, canonical_url, captured, base_id, outcome,
       CASE WHEN outcome = 'merged' THEN
         'age: ' || (page_id % 60) || chr(10) || 'cache-control: max-age=600' || chr(10) || 'content-length: ' || size
         || chr(10) || 'content-type: text/html'
         || CASE WHEN own_tag IS NOT NULL THEN chr(10) || 'etag: ' || weak || own_tag
                 WHEN tag IS NOT NULL THEN chr(10) || 'etag: ' || tag ELSE '' END
         || chr(10) || 'last-modified: ' || coalesce(own_day, day) || chr(10) || 'x-page: ' || base_page END AS headers,
       CASE WHEN outcome = 'merged' THEN payload END AS payload
FROM found
""",
    "op7_radix_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), blocks AS (  -- 256 windows each: cutting a window out of a short string is cheap
  SELECT doc_id, b, substr(h, 2 * b + 1, 2 * 355) AS part
  FROM (SELECT doc_id, h, unnest(range(0, n - 99, 256)) AS b FROM d WHERE n >= 100)
), windows AS (
  SELECT doc_id, b + i AS s, md5(substr(part, 2 * i + 1, 200)) AS win
  FROM (SELECT doc_id, b, part, unnest(range(0, least(256, length(part) // 2 - 99))) AS i FROM blocks)
), ranked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS seen FROM windows
), again AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM ranked WHERE seen > 1
), runs AS (
  SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before + 100 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY s) AS run
  FROM again
), spans AS (
  SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM spans
), cut AS (
  SELECT g.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS front, max(b) AS last,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN cut.doc_id IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang
), phrases AS (
  SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f
  FROM worded, range(1, 6) s(size), unnest(range(1, len(words) - size + 2)) u(i)
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, size, f AS a, k, array_to_string(string_split(phrase, ' ')[: k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS tail
  FROM phrases, unnest(range(1, size)) u(k)
), scored AS (
  SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, n, k,
         CAST((1000 * a::HUGEINT * n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.phrase = c.head JOIN phrases t ON t.lang = c.lang AND t.phrase = c.tail
    JOIN totals ON totals.lang = c.lang
), least_cut AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + w - 1], ' ') AS phrase, max(f) AS longer
  FROM phrases, unnest(range(2, size)) v(w), unnest(range(1, size - w + 2)) u(i)
  GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM least_cut LEFT JOIN inside USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
""",
    "op13_merkle": merkle_statement(),
}
