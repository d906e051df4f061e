"""A training corpus from raw documents: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import line_dedup, packing, quality, simhash, substring_dedup
from tessella.llm.common import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the trees reject go."""
    return quality.keep_documents(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows go, but for the first occurrence."""
    return _documents(line_dedup.dedup_lines(docs.select(*COLUMNS)))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of those linked by a similarity of 0.8 or more of their five-word shingles."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=5, similarity=0.8)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand in an earlier document go."""
    return _documents(substring_dedup.shorten_documents(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces in bins of bounded size, without conflicting neighbours."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", remove_lines),
    ("simhash_dedup", remove_near_copies),
    ("substring_dedup", remove_passages),
    ("best_fit_packing", pack),
]

#: The fitted trees and the components of near copies are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
