"""A cleaning run over ``documents`` as stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrel.llm.bpe import bpe
from timbrel.llm.chosen_path import drop_near
from timbrel.llm.exact_dedup import drop_exact
from timbrel.llm.line_frequency import drop_low_quality
from timbrel.llm.mixing import take_mix
from timbrel.llm.queries import tokenizer_path
from timbrel.llm.rows import written
from timbrel.session import ship_package

#: Rounding by draws and the join by paths are not SQL; the stages are tested against plain loops.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return drop_low_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    return drop_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship_package(spark)
    return take_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether decoding gives the text back."""
    ship_package(spark)
    coded = bpe(docs, tokenizer_path())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram join", near), ("mixing", mixing), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
