"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. language ID: texts in which no language is found go (code-switched ones stay; without any label, all
   texts with a letter do); 2. SimHash near-dedup: one document of each group stays; 3. benchmark decontamination: documents that hold a benchmark phrase go; 4. secret scans: secrets are replaced by a
   mark; 5. mixing: words taken of each document for the target mix.

Every stage reads all that the one before kept. Stages 1 to 4 return the columns of
``documents`` (others that the table has come along); stage 5 returns doc_id, source, size,
source_size, target and taken. Null texts go in stage 1; of repeated rows and near copies stage 2 keeps
one, the one with the smallest id; texts of any length pass whole; empty tables stay empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontaminate, language, mixing, secrets, simhash
from tidepool.llm.common import documents, staged


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.determined(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken_words(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

# The random field of stage 1 is beyond SQL; the stages are tested against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
