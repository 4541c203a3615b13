"""A corpus pipeline of four stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir); the first three return documents as they came, the last one the packed
pieces. Nulls: a text without letters goes at the first stage; rows without an id stay until packing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import language, packing, rule_ensemble, simhash
from tallyframe.llm.common import read_table
from tallyframe.llm.digests import byte_files
from tallyframe.sources.shared import delete, delete_at_exit, shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those in which no language holds half of the letters; without any label, only the first."""
    return language.keep_identified(docs)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that the rule ensemble, trained on the labelled ones among docs, predicts to be bad."""
    return rule_ensemble.keep_good(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, outputs=False, **byte_files())


STAGES = [
    ("language", identify_language),
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: The stages are not SQL: tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents. What a stage returns is written to the shared folder and read again, and deleted once the next is written."""
    docs, path = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        before = path
        docs, path = rewritten(spark, stage(spark, docs, sf_dir), name)
        if before:
            delete(spark.sparkContext, before)
    return STAGES[-1][1](spark, docs, sf_dir)


def rewritten(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df, written to the shared folder and read again, and where; deleted when Python ends at the latest."""
    path = f"{shared_folder(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark.sparkContext, path)
    df.write.parquet(path)
    return spark.read.parquet(path), path
