"""Positions in a global order without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislecast.session import shuffle_partitions, stage


def global_position(
    df: DataFrame,
    outer: Sequence[str] = ("store_id",),
    inner: Sequence[str] = ("sku",),
    order: Sequence[str] = ("date",),
    out: str = "position",
) -> DataFrame:
    """0-based position of every row in the order (outer, inner, order).

    A window without partitions would move every row into one task. Here the
    position is a sum of three bounded parts: the rows of earlier outer keys,
    the rows of earlier inner keys of the same outer key, and the row number
    inside the group. The one unpartitioned window runs over one row per outer
    key. Depends on nothing but the values, so a retried task agrees.
    """
    outer, inner, order = list(outer), list(inner), list(order)
    before = (Window.unboundedPreceding, -1)
    groups = df.groupBy(*outer, *inner).agg(F.count(F.lit(1)).alias("_rows"))
    outer_start = (
        groups.groupBy(*outer)
        .agg(F.sum("_rows").alias("_rows"))
        .select(
            *outer,
            F.coalesce(
                F.sum("_rows").over(Window.orderBy(*outer).rowsBetween(*before)), F.lit(0)
            ).alias("_outer_start"),
        )
    )
    start = (
        groups.withColumn(
            "_inner_start",
            F.coalesce(
                F.sum("_rows").over(
                    Window.partitionBy(*outer).orderBy(*inner).rowsBetween(*before)
                ),
                F.lit(0),
            ),
        )
        .join(outer_start, outer)
        .select(*outer, *inner, (F.col("_outer_start") + F.col("_inner_start")).alias("_start"))
    )
    in_group = F.row_number().over(Window.partitionBy(*outer, *inner).orderBy(*order))
    return (
        df.join(start, [*outer, *inner])
        .withColumn(out, F.col("_start") + in_group - 1)
        .drop("_start")
    )


def dense_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based rank of each distinct value.

    Values are range-partitioned and numbered inside their part; the window
    without partitions runs over one row per part.
    """
    spark = df.sparkSession
    ranged = stage(
        df.select(col)
        .distinct()
        .repartitionByRange(shuffle_partitions(spark), col)
        .withColumn("_part", F.spark_partition_id()),
        "index",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(col))
    return (
        ranged.withColumn("_inside", inside)
        .join(starts, "_part")
        .select(col, (F.col("_start") + F.col("_inside") - 1).cast("int").alias(out))
    )
