"""Corpus pipeline: five stages, each a table of documents in and out, the last one token digests out.

All stages take NULLs in any column, empty and very long texts, repeated rows, empty tables, and extra columns of any
name, which they keep (the last one returns its own columns only).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm.bpe_transducer import Ranks, digests, round_trip
from turnmill.llm.common import shared_path, table
from turnmill.llm.decontaminate import without_leaks
from turnmill.llm.language_id import keep_identified
from turnmill.llm.quality_rules import keep_good
from turnmill.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out the lines that fail; documents that fail or lose too much go, those without words among them."""
    kept = keep_good(docs)
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go; ties between languages stay."""
    return keep_identified(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the least id, any one where none has an id."""
    return one_of_each(docs, shingle=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, each judged by its own text whatever its id."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of what is left, a row per row; a NULL text is empty."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(round_trip(docs, Ranks(path, public_tokenizers.PATTERN)))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", bpe_round_trip),
]

#: SQL can't express most stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
