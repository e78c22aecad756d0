"""From raw documents to packed training sequences: rules, classifier, near copies, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import queries as q
from stockflow.session import materialize, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return q.keep_by_rules(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return q.keep_by_classifier(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return q.keep_one_of_each(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return q.packed(docs)


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier),
          ("near_dedup", near_dedup), ("best_fit_packing", best_fit_packing)]

#: Tokenizers, a trained classifier and a genetic algorithm are beyond SQL; tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each returns is written as Parquet and read again. The
    tables that a stage works with go when it is done, those between stages at the end."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as last:
        for name, stage in STAGES:
            with scratch(spark) as keep:
                docs = keep(materialize(stage(spark, docs, sf_dir), name))
        return last(docs)
