"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradestar.llm.common import read_table
from tradestar.llm.decontam import remove_contaminated
from tradestar.llm.mixing import replicate
from tradestar.llm.queries import token_records
from tradestar.llm.simhash import deduplicate
from tradestar.llm.weak_quality import keep_good
from tradestar.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated (or left out) to meet the target weights of their sources, shuffled."""
    return replicate(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Records of the binary token files, read back."""
    return token_records(spark, docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
    ("token ids", tokens),
]

#: Expectation-maximisation, iterated components and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{k}")
    return docs
