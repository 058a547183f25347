"""The corpus pipeline: five stages over ``documents``, each written as Parquet before the next.

Defined results: every stage keeps all columns of its input but the last, which returns one
row per document with the words that the mix takes of it. Null and empty texts hold no
benchmark passage or secret, are near-duplicates of nothing, and are as toxic as the share of
toxic labels; repeated rows stay once; empty tables pass through every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.llm.op3_decontaminate import with_hits
from tablesmith.llm.op4_neardup import one_of_each
from tablesmith.llm.op6_toxicity import THRESHOLD, ToxicityScorer, text_key
from tablesmith.llm.op8_secrets import without_secrets
from tablesmith.llm.op9_mixture import mixture
from tablesmith.llm.shared import saved, table
from tablesmith.session import garbage_collected

SIMILARITY = 80     # fixed value: near-duplicates, in hundredths


def stage(build: Callable) -> Callable:
    """A stage that begins with what the one before it left on the driver collected."""
    @wraps(build)
    def collected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        garbage_collected(spark)
        return build(spark, docs, sf_dir)
    return collected


@stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models don't call toxic."""
    scorer = ToxicityScorer(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(text_key(F.col("text")).alias("text_key"), F.struct("*").alias("row"))
    return scorer.scored(rows).where(F.col("score") < THRESHOLD).select("row.*")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, SIMILARITY)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return with_hits(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without secrets."""
    return without_secrets(docs)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: doc_id, source, size, source_size, target and the words taken of each document."""
    return mixture(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]

# Model scores and near-duplicate components can't be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, build in STAGES:
        docs = saved(build(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
