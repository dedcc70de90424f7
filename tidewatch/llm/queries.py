"""Queries of the corpus operators and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, classifier, conversations, divergence, fingerprints, html_text, jaccard_join, license_scan, near_dedup, oracles, packing, quality_rules, sharding, warc_fixity
from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.marked(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_fixity.audited(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which rule is the first to reject depends on the sampled order, so it stays out of the compared columns.
    return quality_rules.verdicts(table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


_OPS = (
    op1_quality_classifier,
    op2_license_scan,
    op3_simhash_fingerprints,
    op4_byte_bpe,
    op5_warc_fixity,
    op6_sharding,
    op7_best_fit_packing,
    op8_minhash_near_dedup,
    op9_html_extraction,
    op10_quality_rules,
    op11_conversation_repair,
    op12_source_divergence,
    op13_ngram_jaccard,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _OPS}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": oracles.op2(license_scan.NOTICES),
    "op5_warc_fixity": oracles.OP5,
    "op8_minhash_near_dedup": oracles.OP8,
    "op10_quality_rules": oracles.OP10,
    "op12_source_divergence": oracles.op12(divergence.LEAST_DOCS, divergence.MOST_RANK),
    "op13_ngram_jaccard": oracles.OP13,
}
