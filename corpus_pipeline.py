"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.llm import lines, packing, pii, quality, simhash
from acreage.llm.common import read, stored
from acreage.session import ship


def _as_documents(made: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it now is."""
    return made.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule table keeps, however long they are: packing cuts any length."""
    return quality.only_kept(docs, rules=[r for r in quality.RULES if r.name != "many_words"])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sources share."""
    return _as_documents(lines.without_boilerplate(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return simhash.without_near_copies(docs).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    ship(spark)
    return _as_documents(pii.redacted(docs), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a sequence of 2048 tokens for every piece of every document."""
    ship(spark)
    path = public_tokenizers.path
    return packing.pack_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii", personal_data),
    ("packing", best_fit_packing),
]

#: Fingerprints and packing cannot be put in SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
