"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before it
kept and returns a DataFrame, which is written to the shared folder and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import common, decontaminate, neardup, packing, quality, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    rules = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    kept = quality.with_statistics(docs).where(~quality.base_failed() & quality.verdict(rules))
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five words, similarity 0.8 or more; the smallest doc_id stays."""
    return neardup.clean(docs, k=5)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in their texts masked."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a sequence of a power of two tokens."""
    return packing.pack(docs, with_ids=False).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("benchmark leaks", benchmark_leaks),
    ("secret scans", secret_scans),
    ("packing", packed),
]
#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
