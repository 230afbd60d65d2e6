"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all rows of ``docs``.

All but the last return the columns of ``docs``. Columns besides doc_id, text and lang aren't looked at. An empty table
passes through every stage as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, exact_dedup, langid, minhash, packing
from quarry.llm._shared import bounded_batches, table
from quarry.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language: rejected ones, null and empty texts, texts without a letter. Repeated rows fare alike."""
    bounded_batches(spark)
    return langid.keep_identified(docs, langid.train(docs.where(~langid.held_out())))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal texts; of a repeated doc_id only rows whose own text is a copy go, rows without doc_id stay."""
    bounded_batches(spark)
    return exact_dedup.unique(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (80 % of five-word shingles or more); rows without words or doc_id stay."""
    bounded_batches(spark)
    return minhash.deduplicate(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; rows without text or doc_id stay."""
    bounded_batches(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the token sequences of the documents out to batches; a null or empty text is a sequence of no tokens."""
    bounded_batches(spark)
    return packing.pack(packing.token_lengths(docs, tokenizer(spark)), F.col("n_tokens"))
