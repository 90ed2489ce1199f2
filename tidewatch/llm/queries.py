"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import (embedding_dedup, license_scan, line_dedup, lm_score, merkle, mixing, packing, quality,
                           ranked_search, secret_scan, simhash, toxicity, warc)
from tidewatch.llm.oracle import ORACLE  # noqa: F401
from tidewatch.llm.shared import read_docs


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(read_docs(spark, sf_dir, "embeddings"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets: each source's size to the power 0.5."""
    docs = read_docs(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "source", "mix_block", "mix_slot", "mix_offset")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(read_docs(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    return line_dedup.drop_boilerplate(docs, chars_col="n_chars", counts=True)


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_docs(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_docs(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "documents")
    model = quality.train_quality(docs, read_docs(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_docs(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, read_docs(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_docs(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    index = ranked_search.build_index(read_docs(spark, sf_dir, "documents"))
    return ranked_search.search(index, read_docs(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and witnesses of all documents per language, and their check after tampering."""
    return merkle.verify(merkle.manifest(read_docs(spark, sf_dir, "documents")))


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: base patterns and high-entropy windows, as digests per document."""
    return secret_scan.digest(secret_scan.scan_secrets(read_docs(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_mix_sources, op3_lm_scoring, op4_line_dedup, op5_license_scans,
    op6_best_fit_packing, op7_quality_rules, op8_warc, op9_toxicity, op10_simhash_near_dedup,
    op11_ranked_search, op12_merkle_manifest, op13_secret_scans)}
