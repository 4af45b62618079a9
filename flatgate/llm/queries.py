"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flatgate.llm.common import table
from flatgate.llm.conversation_trie import prefix_trie
from flatgate.llm.exact_dedup import exact_duplicates
from flatgate.llm.filter_audit import filter_audit
from flatgate.llm.hmm import word_scores
from flatgate.llm.merkle import document_fingerprints
from flatgate.llm.packing import best_fit_packing
from flatgate.llm.quality_classifier import quality
from flatgate.llm.quality_rules import quality_rules
from flatgate.llm.segmentations import sampled_segmentations
from flatgate.llm.simhash import near_duplicates
from flatgate.llm.token_counts import token_counts
from flatgate.llm.toxicity import toxicity
from flatgate.llm.url_filters import url_verdicts

# The rule list of the URL query, (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_scores(table(spark, sf_dir, "documents"), modulus=7, held_out=2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), capacity=2048)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("host", "host_failure_rate")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op9_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("n_pieces", "ids_crc32", "log_prob", "log_inclusion", "round_trip")
    return sampled_segmentations(table(spark, sf_dir, "documents"), k=3, fields=fields)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_hmm_scores": op2_hmm_scores,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_segmentations": op9_segmentations,
    "op10_url_filters": op10_url_filters,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_filter_audit": op13_filter_audit,
}
