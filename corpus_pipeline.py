"""The training-data pipeline: documents through five stages, each on all the one before kept.

Every stage is written as Parquet to the shared folder and read again, so a
lost executor repeats no earlier stage. What a stage wrote for its own use is
removed when the next one begins: by then its output is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from aislecast.llm import chosen_path, curriculum, divergence_rules, nbest, suffix_dedup
from aislecast.llm.common import table
from aislecast.session import listing, release, stage

# Tables that the stage before wrote for its own use, by application.
_INNER: dict[str, list[tuple[str, str | None]]] = {}

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def tidy(step: Step) -> Step:
    """The step, after the removal of what the one before it left; its own docs have been read again."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = _INNER.setdefault(spark.sparkContext.applicationId, [])
        release(spark, inner)
        with listing(inner):
            return step(spark, docs, sf_dir)

    return run


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and look like a language."""
    return divergence_rules.filter_documents(docs)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return chosen_path.drop_near_duplicates(docs)


@tidy
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 bytes that a document of smaller id has too."""
    return suffix_dedup.drop_passages(docs)


@tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return curriculum.mix_documents(docs)


@tidy
def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentations of every text; the best one with its ids."""
    return nbest.encode_nbest(docs)


STAGES: list[tuple[str, Step]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("segment", segment),
]

# SQL can express neither the suffix order nor the segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
