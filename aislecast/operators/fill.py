"""Price filling by product: last known price, else the next one, else a default.

Raw rows of one product may be a large part of the input, so no window ever
runs over them. Prices are first reduced to one row per (product, time). These
are cut into ranges of about equal size by product and time, wherever products
or hours begin; then it is a scan in segments: the last known price of every
range, carried over a product's ranges, and the times inside a range. So a
product with all its times in one hour is as many tasks as any other rows.

The order inside a product is: time, then rows with a price before rows
without, then the price. A fill therefore depends on (sku, ts) alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.functions.dates import present
from aislecast.session import shuffle_partitions, stage

DEFAULT_PRICE = 10.0
COPY_BATCH = 1_000_000


def _known(value: str, by: str, pick) -> Column:
    return pick(value, F.when(F.col(value).isNotNull(), F.col(by)))


def missing_price_fills(
    sales: DataFrame, chunk: str | None = None, default: float = DEFAULT_PRICE
) -> DataFrame:
    """(sku, ts, fill_price) for each time at which a product misses a price."""
    reduced = sales.groupBy("sku", "ts").agg(
        F.min("price").alias("_low"),
        F.max("price").alias("_high"),
        F.max(F.col("price").isNull()).alias("_missing"),
    )
    return fills_of_times(reduced, chunk, default)


def _ranges(reduced: DataFrame, chunk: str | None) -> DataFrame:
    """One row per product and time, with the range it lies in: of rows, or of a named length of time."""
    lowest = [F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.max("_missing").alias("_missing")]
    if chunk is not None:
        # Both uses of the times look alike to the optimizer, keys being present
        # in either, so it computes them once.
        begin = F.date_trunc(chunk, "ts").cast("timestamp_ntz")
        named = present(reduced.withColumn("_chunk", begin), "sku", "ts", "_chunk")
        return named.groupBy("sku", "_chunk", "ts").agg(*lowest)
    times = present(reduced, "sku", "ts").groupBy("sku", "ts").agg(*lowest)
    parts = shuffle_partitions(reduced.sparkSession)
    ranged = times.repartitionByRange(parts, "sku", "ts").withColumn("_chunk", F.spark_partition_id())
    # Written, as it is used twice and ranges must be the same both times.
    return stage(ranged, "price-times")


def fills_of_times(reduced: DataFrame, chunk: str | None = None, default: float = DEFAULT_PRICE) -> DataFrame:
    """The same from rows that hold the lowest and highest price of a product and time."""
    price_type = reduced.schema["_low"].dataType
    times = _ranges(reduced, chunk)
    chunks = times.groupBy("sku", "_chunk").agg(
        _known("_low", "ts", F.min_by).alias("_first"),
        _known("_high", "ts", F.max_by).alias("_last"),
        F.max("_missing").alias("_any_missing"),
    )
    by_chunk = Window.partitionBy("sku").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        chunks.withColumn("_before", F.last("_last", True).over(by_chunk.orderBy("_chunk")))
        .withColumn("_after", F.last("_first", True).over(by_chunk.orderBy(F.desc("_chunk"))))
        .filter("_any_missing")
        .select("sku", "_chunk", "_before", "_after")
    )
    by_time = Window.partitionBy("sku", "_chunk").rowsBetween(Window.unboundedPreceding, 0)
    fill = F.coalesce(
        F.last("_high", True).over(by_time.orderBy("ts")),
        "_before",
        F.last("_low", True).over(by_time.orderBy(F.desc("ts"))),
        "_after",
        F.lit(default).cast(price_type),
    )
    return (
        times.join(chunks, ["sku", "_chunk"])
        .withColumn("fill_price", fill)
        .filter("_missing")
        .select("sku", "ts", "fill_price")
    )


def fill_prices(
    sales: DataFrame, chunk: str | None = None, default: float = DEFAULT_PRICE, salts: int = 32
) -> DataFrame:
    """Sales rows with every price present.

    Rows that have a price pass through untouched. Rows that lack one are
    first collapsed to distinct rows with a count, then spread over salts, so
    neither many copies of a row nor one hot product time lands in one task.
    """
    columns = sales.columns
    price_type = sales.schema["price"].dataType
    fills = missing_price_fills(sales, chunk, default).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    rest = [c for c in columns if c != "price"]
    filled = (
        sales.filter(F.col("price").isNull())
        .groupBy(*rest)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_salt", F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"))
        .join(fills, ["sku", "ts", "_salt"], "left")
        .withColumn("price", F.coalesce("fill_price", F.lit(default).cast(price_type)))
    )
    # Give the copies back in batches, so many copies are written by many tasks.
    last_batch = F.floor((F.col("_copies") - 1) / COPY_BATCH)
    left_over = F.col("_copies") - F.col("_batch") * COPY_BATCH
    in_batch = F.least(left_over, F.lit(COPY_BATCH))
    filled = (
        filled.withColumn("_batch", F.explode(F.sequence(F.lit(0).cast("long"), last_batch)))
        .repartition(*rest, "_batch")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), in_batch)))
        .select(*columns)
    )
    return sales.filter(F.col("price").isNotNull()).unionByName(filled)
