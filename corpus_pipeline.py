"""From raw documents to packed training sequences, in five stages over whole tables.

Every stage reads what the one before kept, as Parquet; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logloom.llm import importance, mixing, packing, quality_rules, simhash
from logloom.llm.common import Staged, read_table
from logloom.session import ship_package, use_utc


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return importance.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, with_ids=False).drop("ids")


STAGES = [
    ("quality rules", quality_rule_stage),
    ("quality classifier", quality_classifier_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("mixing sources", mixing_stage),
    ("packing", packing_stage),
]

#: Fingerprints, tokens and the classifier's model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = read_table(use_utc(spark), sf_dir, "documents"), Staged(spark, "pipeline")
    for _, stage in STAGES:
        docs = written.write(stage(spark, docs, sf_dir))
    return docs
