"""A training corpus from raw documents: five stages, each one operator.

Every stage works on all that the one before kept, written as Parquet and read
again; all but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import decontaminate, language_id, line_dedup, sentencepiece_scan, simhash
from dayledger.llm.common import boxed, stage, table, unboxed


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the network; null texts and texts without a
    letter go. Where no document names its language, none is known and all go."""
    net = language_id.fit(docs)
    found = language_id.predict(boxed(docs), net)
    return unboxed(found.where(F.col("lang_pred") != language_id.UNDETERMINED), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat earlier ones but for a word."""
    return line_dedup.line_dedup(docs, min_words=10)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, without the benchmark's passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``n_tokens`` of every document, and whether its ids
    decode to its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = sentencepiece_scan.round_trips(docs.select("doc_id", "text"), model)
    return found.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), "round_trip")


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

#: A neural network decides the first stage; no SQL says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
