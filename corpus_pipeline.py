"""A corpus pipeline over ``documents``: quality rules, exact deduplication,
near-duplicate removal, mixing to target weights, packing.

Each stage takes what its predecessor kept, as Parquet, and returns the
columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punktwerk.llm import exact_dedup, mixing, near_join, packing, quality_rules
from punktwerk.llm.common import documents, prepare, staged
from punktwerk.llm.queries import tokenizer


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that fail the base rule or a fence go."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the largest doc_id stays."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near copies stays."""
    prepare(spark)
    return near_join.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: sources by weight; a document taken twice is two rows."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: pieces of at most 2,048 ids and their places."""
    prepare(spark)
    # a small memo: the executors' workers have run the other stages before
    return packing.packing_digest(docs, tokenizer("byte_bpe_50k.json"), 1, memo_units=150_000)


STAGES = [("quality_rules", rules), ("exact_dedup", exact), ("near_join", near), ("mixing", mixed), ("packing", packed)]

#: Fences, links and tokens can't be written in SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline_{name}")
    return docs
