"""Review text -> one sentiment score per product."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislecast.functions.dates import present
from aislecast.functions.numeric import round_even
from aislecast.functions.text import is_blank, lexicon_score

Scorer = Callable[[Column], Column]


def score_reviews(reviews: DataFrame, scorer: Scorer = lexicon_score) -> DataFrame:
    """A score per review. The scorer is any Column -> Column function, a
    pandas UDF around a model included. Blank reviews have no score."""
    text = F.col("review_text")
    return reviews.withColumn("score", F.when(~is_blank(text), scorer(text)))


def sentiment_by_sku(reviews: DataFrame, scorer: Scorer = lexicon_score) -> DataFrame:
    """Mean score per product; neutral when all its reviews are blank."""
    return (
        score_reviews(present(reviews, "sku"), scorer)
        .groupBy("sku")
        .agg(F.coalesce(round_even(F.avg("score"), 4), F.lit(0.0)).alias("sentiment_score"))
    )


def input_fingerprint(reviews: DataFrame) -> str:
    """A key for stored scores that changes with the reviews.

    Two order-independent sums over row hashes and the row count.
    """
    row = F.xxhash64("sku", "review_text")
    wide = "decimal(38,0)"
    got = reviews.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(row.cast(wide)).alias("s"),
        F.sum(F.hash("sku", "review_text").cast(wide)).alias("h"),
    ).first()
    return f"{got['n']}_{got['s']}_{got['h']}".replace("-", "m")


def stored_sentiment(
    reviews: DataFrame, folder: str, scorer: Scorer = lexicon_score, name: str = "lexicon",
    refresh: bool = False,
) -> DataFrame:
    """Read the scores stored for exactly these reviews, else compute them."""
    spark = reviews.sparkSession
    path = f"{folder.rstrip('/')}/{name}/{input_fingerprint(reviews)}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = done.getFileSystem(spark._jsc.hadoopConfiguration())
    if refresh or not fs.exists(done):
        sentiment_by_sku(reviews, scorer).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
