"""From raw documents to packed training sequences: four stages, each over all that its predecessor kept.

Defined cases for every stage: nulls in any column, very long texts, equal rows and extra columns, whatever their names, pass through
unchanged (but for packing, which returns pieces); an empty table gives an empty one with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import classifier, near_dedup, packing, quality_rules
from tidewatch.llm.common import materialise, table


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no quality rule rejects; null and empty texts have no words and go."""
    return quality_rules.keep_good(docs)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored at the threshold or above; all rows where labels of both classes are missing. Rows without an id are scored too."""
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the least doc_id, rows without an id last, ties by a written row number."""
    return near_dedup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences; a null text is the end id alone, rows without an id keep a null id."""
    return packing.packed(docs)


STAGES = [("quality rules", apply_rules), ("quality classifier", classify), ("MinHash near-dedup", deduplicate), ("best-fit packing", pack)]

#: The classifier and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{k}")
    return docs
