"""The corpus pipeline: filter, deduplicate, decontaminate, mask and pack documents.

Each stage reads what its predecessor kept (written as Parquet in the shared folder
and read again); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesflow.llm import ngram_join, packing, pii, quality, suffixes
from salesflow.llm.common import table, written
from salesflow.llm.queries import vocabulary_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (score under 0.7)."""
    forest = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, forest, keep_only=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each component of the n-gram Jaccard join."""
    return ngram_join.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window."""
    return suffixes.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind; every document stays."""
    return pii.mask(docs, pii.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary_path())


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("private_data", private_data), ("packing", packed)]

#: no SQL: trees, suffix arrays, message passing and a merge vocabulary are not expressible; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
