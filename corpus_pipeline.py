"""The corpus pipeline: documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept and is written as
Parquet before the next one reads it.  All but the last return the columns of ``documents``.

1. ``language``: documents that are not predicted as one of ``WANTED`` go: other languages, and texts in which none
   can be told (null, empty or without a letter).
2. ``near_dedup``: of each SimHash component, the document with the smallest id stays.
3. ``passage_dedup``: passages of 100 bytes and more that occurred before are cut out; a document that
   is nothing but such passages goes.  ``n_chars`` counts what is left.
4. ``packing``: the pieces of all that is left in windows of 2048 ids.

Rows without an id stay through all stages (they never are a component's smallest, nor are they given up for
one); rows that repeat both id and text count once from the second stage on.  Columns that
``documents`` has besides are carried along, whatever their names.  Empty tables give empty results.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gearwatch.llm.common import read_table, shared_folder
from gearwatch.llm.language import with_known_language
from gearwatch.llm.packing import pack_documents
from gearwatch.llm.queries import language_samples
from gearwatch.llm.radix_dedup import without_repeats
from gearwatch.llm.simhash import simhash_components


WANTED = ("de", "en", "es", "fr")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_known_language(docs, language_samples(docs), wanted=WANTED)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stay = simhash_components(docs, shingle=4, budget=4).where("doc_id = component_id").select("doc_id").distinct()
    named = _once(docs.join(stay, "doc_id", "left_semi"), "doc_id")
    return named.unionByName(_once(docs.where("doc_id is null")))


def _once(docs: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of ``keys`` and text."""
    number = f"number_{uuid.uuid4().hex}"
    text = F.sha2(F.col("text").cast("binary"), 256)
    same = Window.partitionBy(*keys, text).orderBy(F.lit(0))
    return docs.withColumn(number, F.row_number().over(same)).where(F.col(number) == 1).drop(number)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [("language", language), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("packing", packing)]

ORACLE_SQL = None  # SQL has no tokenizers, trained models or XXH64; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(out := f"{folder}/{number}-{name}")
        docs = spark.read.parquet(out)
    return docs
