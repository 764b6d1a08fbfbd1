"""A corpus pipeline: quality rules, quality classifier, exact and near deduplication, packing.

STAGES maps names to functions (spark, docs, sf_dir) -> DataFrame. Every stage but the last returns the
columns of documents for the rows that it keeps, extra columns too, and gives none for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roundhouse.llm import exact_dedup, near_dedup, packing, quality_model, quality_rules
from roundhouse.llm.common import labelled, stored, table
from roundhouse.llm.queries import tokenizer_path
from roundhouse.storage import forget_since, mark


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and whose posterior is at least a half. Null and empty texts go; copies are judged alike."""
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Rows without a doc_id or label are judged but not learned from; without labels all stay."""
    return quality_model.keep_good(docs, labelled(spark, sf_dir, "quality"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text, that of the largest doc_id; of repeated rows one; a row without a doc_id only where all rows of its text have none."""
    return exact_dedup.keep_one(docs, largest=True)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each class of near copies. Texts without words are near to none; rows without a doc_id stay."""
    return near_dedup.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document; a null text has its end id alone. Repeated rows are packed each."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("exact_dedup", exact_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: The rules' expectation maximisation, the classifier's fit and near duplicates are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again. What a stage has stored, its input too, is deleted when its rows are there. An empty table gives no rows."""
    docs, start = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget_since(start, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
