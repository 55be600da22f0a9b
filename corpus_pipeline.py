"""From raw documents to packed training sequences, in five stages.

Each stage reads all rows that the one before kept. All but the last return the columns of ``documents``.
The stages cannot be said in SQL as a whole (a learned model, similarity components, a packing plan), so
each is tested against a brute-force version instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import language, mixing, ngram_join, packing, secret_scan
from tidecast.llm.staging import short_batches, stage

#: The Python workers of all stages live beside one heap, so batches and the tokenizer's memory are smaller than in single queries.
BATCH_ROWS, REMEMBERED = 500, 400_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those that no language explains at least half of."""
    short_batches(spark, BATCH_ROWS)
    return language.keep_languages(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word n-grams at a Jaccard similarity of 0.8."""
    short_batches(spark, BATCH_ROWS)
    return ngram_join.keep_one(docs, n=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; no document goes."""
    short_batches(spark, BATCH_ROWS)
    clean = secret_scan.redact(docs, secret_scan.fit(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents up to 150 % of all words by the weights 5, 2, 1; a document may come twice."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048."""
    short_batches(spark, BATCH_ROWS)
    pieces = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED)
    return packing.pack(pieces)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
