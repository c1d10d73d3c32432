"""Retail views over the order tables: the inputs of the registered queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislecast.contracts import TRUTH
from aislecast.functions.ids import sensor_id
from aislecast.functions.numeric import round_even


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the selling region as store and the brand as product.

    The dimension sides are left to the optimizer, which broadcasts them when
    their size allows and shuffles otherwise.
    """
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("store_id"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("sku"))
    steps = [
        (suppliers, F.col("l_suppkey") == F.col("s_suppkey")),
        (nations, F.col("s_nationkey") == F.col("n_nationkey")),
        (regions, F.col("n_regionkey") == F.col("r_regionkey")),
        (parts, F.col("l_partkey") == F.col("p_partkey")),
    ]
    return reduce(lambda left, step: left.join(step[0], step[1]), steps, lines)


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey") % 200
    unit = round_even(F.col("l_extendedprice") / F.col("l_quantity"), 2)
    return sale_lines(spark, sf_dir).select(
        "store_id",
        "sku",
        F.col("l_shipdate").alias("ts"),
        F.when(order != 0, F.col("l_quantity").cast("int")).alias("qty_sold"),
        F.when(order != 1, unit.cast("decimal(18,2)")).alias("price"),
        F.when(F.col("l_linestatus") == "O", "online").otherwise("in-store").alias("channel"),
    )


def iot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 41
    return sale_lines(spark, sf_dir).select(
        "store_id",
        "sku",
        F.col("l_shipdate").alias("ts"),
        level.cast("int").alias("shelf_qty"),
        sensor_id(F.col("store_id"), F.col("sku")).alias("sensor_id"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews; source n is read as a review of brand n."""
    return table(spark, sf_dir, "documents").select(
        F.regexp_replace("source", "^src", "Brand#").alias("sku"), F.col("text").alias("review_text")
    )


# Words frequent in the test documents, as the default lists hardly occur there.
TEST_POSITIVE = ("the", "and", "la", "der", "el")
TEST_NEGATIVE = ("of", "is", "le", "die", "en")


def truth(spark: SparkSession) -> DataFrame:
    """Known anomaly windows, in the shape of the ground-truth file."""
    day = dt.date
    return spark.createDataFrame(
        [
            ("AFRICA", "Brand#1", day(1996, 3, 1), day(1996, 6, 30), "stockout_risk"),
            ("ASIA", "Brand#7", day(1998, 1, 1), day(1998, 12, 31), "demand_spike"),
            ("EUROPE", "Brand#13", day(2000, 5, 5), day(2000, 5, 6), "sensor_mismatch"),
        ],
        TRUTH,
    )
