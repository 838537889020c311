"""A training-data pipeline: five stages, each on all that the one before kept.

Toxic documents go, one document of each group of near copies stays, secrets are replaced,
sources are interleaved by target weight (the rows are written in that order), and the documents
are packed into sequences that follow the written order. All stages but the last return the
columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import common, jaccard_join, mixing, packing, secret_scan, toxicity
from logloom.session import ship_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ship_package(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    ship_package(spark)
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    ship_package(spark)
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix."""
    return mixing.mix(docs).orderBy("position").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per token piece, with its sequence and offset; sequences in the order of the mix."""
    ship_package(spark)
    return packing.pack_documents(common.in_written_order(docs, "_place"), order="_place")


#: Words of a shingle and least similarity in percent for near copies.
NEAR_WORDS, NEAR_PERCENT = 5, 80

STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models and plans have no SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
