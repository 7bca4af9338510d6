"""Corpus pipeline: from raw documents to a training mix.

Each stage works on what its predecessor kept, written as Parquet and read
again, and returns the columns of ``documents``; the last returns the draws of
the mix. See the operators in ``riverbed.llm`` for what each stage decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverbed.llm.common import ship_package, stage_table
from riverbed.llm.decontaminate import drop_leaks
from riverbed.llm.exact_dedup import drop_exact_duplicates
from riverbed.llm.mixing import draw
from riverbed.llm.near_join import drop_near_duplicates
from riverbed.llm.quality import drop_low_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier accepts."""
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The temperature mix of what is left: one row per draw. The budget is
    the least that draws every document at least once."""
    return draw(docs).drop("rid")


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("mix", mix)]

#: Classifier training is not SQL; stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
