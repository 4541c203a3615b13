"""The thin queries over the operators: production parameters, whole tables, digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, hard_negatives, language, license_scan, lm_score, packing, quality_rules, resampling, rule_ensemble, sharding, simhash, url_filter
from .common import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.line_first_rules(read_table(spark, sf_dir, "documents"), cleaned=False)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), outputs=False)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), outputs=False, **byte_files())


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language.train(docs, ~language.held_out())
    return language.identify(docs, model, spans=False).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "n_spans")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec") % 50 == 0)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the page is bad if the label of the same number marks low quality."""
    outcomes = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), outcomes).withColumn("bound", F.round("bound", 6))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.stupid_backoff(read_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "n_backed_off", "n_unseen", F.round("mean_log_score", 6).alias("mean_log_score"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = rule_ensemble.train(docs, read_table(spark, sf_dir, "labels"))
    return rule_ensemble.classify(docs, model, outputs=False).select("doc_id", rule_ensemble.held_out().alias("held_out"), "score", "predicted")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"), spans=False).withColumn("score", F.round("score", 6))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are dealt on where the id is divisible by seven, so that near rows of other labels exist."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec") % 100 == 0)


def byte_files() -> dict[str, str]:
    return {"json_path": public_tokenizers.path("byte_bpe_50k.json"), "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_bpe, op3_packing, op4_hilbert_shards, op5_language, op6_simhash, op7_ann, op8_url_filter, op9_lm_score, op10_quality_classifier, op11_license_scan, op12_importance_resample, op13_hard_negatives,
    )
}
