"""A training corpus from `documents`: five stages, each written as Parquet and read by the next.

1. `quality_rules`: documents that the rule ensemble rejects go. Labels of `labels` are learned from all labelled rows
   that are among the stage's documents and outside the held-out fold.
2. `shingle_join`: of each component of near duplicates (Jaccard 0.8 on word 5-grams) one document stays.
3. `decontamination`: documents of which a twentieth or more lies in benchmark windows go.
4. `secret_scan`: secrets in the texts are masked; documents stay.
5. `entropy_mix`: documents are repeated or left out so that sources meet their target weights.

All stages return the columns of `documents`. Whether a document is kept by stage 1 or 2 depends on a
fitted model and on components, which SQL does not express, so ORACLE_SQL is None; tests compare the
stages with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm.decontamination import without_contaminated
from tidegate.llm.mixing import mixed_copies
from tidegate.llm.quality_rules import accepted
from tidegate.llm.secret_scan import redacted
from tidegate.llm.shingle_join import one_of_each
from tidegate.session import ship_package, store, workspace

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_copies(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("shingle_join", duplicate_stage),
    ("decontamination", benchmark_stage),
    ("secret_scan", secret_stage),
    ("entropy_mix", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with workspace(spark):
            docs = store(stage(spark, docs, sf_dir), name, outer=True)
    return docs
