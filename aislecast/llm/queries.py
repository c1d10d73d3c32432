"""The registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislecast.llm import (
    alignment,
    chosen_path,
    curriculum,
    divergence_rules,
    hard_negatives,
    interpolation,
    metric_join,
    multi_index,
    nbest,
    pu_quality,
    suffix_dedup,
    toxicity,
    training_order,
)
from aislecast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum.plan_mix(table(spark, sf_dir, "documents"))
    return plan.orderBy("position", "sid", "start", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "position"
    )


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = chosen_path.ChosenPath(shingle=3, percent=85)
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), params)


@query
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.lm_scores(table(spark, sf_dir, "documents"), interpolation.Interpolation(order=3))


@query
def op10_segment_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encode_nbest(table(spark, sf_dir, "documents"), ids_of=0)


@query
def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_order(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_tokenizer_alignment(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = metric_join.MetricJoin(shingle=4, percent=85)
    return metric_join.similarity_join(table(spark, sf_dir, "documents"), params)
