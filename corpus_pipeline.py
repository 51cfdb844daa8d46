"""Preparing a corpus for training: language, repeated lines, near duplicates, repeated passages, packing.

Each stage works on all rows that its predecessor kept and returns the columns of ``documents``; the last one returns the
packed pieces. Stages are written as Parquet and read again, so a lost executor costs a stage's own work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflux.llm import langid, linededup, neardup, packing, substrings
from strataflux.llm.common import materialise
from strataflux.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Share that the main language of a kept document must have.
LEAST_SHARE = 0.5
#: SQL has no counterpart of language models and tokenizers; the tests hold each stage against brute force.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """Texts that changed have another count of characters; those without a word left go."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language has half of the words, go."""
    model = langid.fit(docs, F.col("lang").isNotNull())
    return langid.identify(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Aligned repeated lines go from the later document; a document that has no words left goes too."""
    return _sized(linededup.apply(docs, linededup.repeated_lines(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id."""
    return neardup.one_of_each(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds go, each with the white space after it."""
    out = substrings.apply(docs, substrings.repeats(docs), substrings.without, "text string")
    return _sized(out.withColumn("text", F.col("result.text")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
