"""Raw sales and shelf readings -> the dense store x product x day table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.functions.dates import present, with_event_date
from aislecast.functions.ids import sensor_id
from aislecast.functions.numeric import round_even
from aislecast.operators.fill import DEFAULT_PRICE, fills_of_times
from aislecast.session import shuffle_partitions, stage, stage_by

SERIES = ["store_id", "sku"]
KEYS = ["store_id", "sku", "date"]
DEFAULT_SHELF = 20.0


def drop_unsold(sales: DataFrame) -> DataFrame:
    """A sale without a quantity cannot be inferred: the row goes."""
    return present(sales, "qty_sold")


def with_line_revenue(sales: DataFrame) -> DataFrame:
    return sales.withColumn("revenue_line", F.col("qty_sold") * F.col("price"))


def by_day(rows: DataFrame) -> DataFrame:
    """Add the day; rows without store, product or day belong to no group."""
    return with_event_date(present(rows, *SERIES, "ts")).filter(F.col("date").isNotNull())


def daily_sales(sales: DataFrame) -> DataFrame:
    """Units, revenue and mean price per store, product and day.

    Expects prices to be present. Sums combine before the shuffle, so a hot
    product day costs one row per task.
    """
    return (
        with_line_revenue(by_day(sales))
        .groupBy(*KEYS)
        .agg(
            F.sum("qty_sold").cast("long").alias("qty_sold"),
            F.sum("revenue_line").cast("double").alias("revenue"),
            (F.sum("price").cast("double") / F.count("price")).alias("avg_price"),
        )
    )


def daily_sales_filled(
    sales: DataFrame, chunk: str | None = None, default: float = DEFAULT_PRICE
) -> DataFrame:
    """Drop unsold rows, fill prices and roll up to days in one go.

    A fill depends on product and time alone. So the raw rows are read once and
    reduced to (store, product, time), with priced and unpriced sums side by
    side; fills and days come from that table. No raw row is ordered. Decimal
    prices stay decimal up to the last sum, so sums are exact.
    """
    missing = F.col("price").isNull()
    times = stage(
        with_line_revenue(by_day(drop_unsold(sales)))
        .groupBy(*KEYS, "ts")
        .agg(
            F.sum(F.when(~missing, F.col("qty_sold"))).alias("_qty"),
            F.sum("revenue_line").alias("_revenue"),
            F.sum("price").alias("_prices"),
            F.count("price").alias("_lines"),
            F.min("price").alias("_low"),
            F.max("price").alias("_high"),
            F.sum(F.when(missing, F.col("qty_sold"))).alias("_bare_qty"),
            F.count_if(missing).alias("_bare_lines"),
        ),
        "sales-times",
    )
    priced = times.filter("_lines > 0").select(*KEYS, "_qty", "_revenue", "_prices", "_lines")
    fills = fills_of_times(times.withColumn("_missing", F.col("_bare_lines") > 0), chunk, default)
    unpriced = (
        times.filter("_bare_lines > 0")
        .join(fills, ["sku", "ts"])
        .select(
            *KEYS,
            F.col("_bare_qty").alias("_qty"),
            (F.col("_bare_qty") * F.col("fill_price")).alias("_revenue"),
            (F.col("_bare_lines") * F.col("fill_price")).alias("_prices"),
            F.col("_bare_lines").alias("_lines"),
        )
    )
    return (
        priced.unionByName(unpriced)
        .groupBy(*KEYS)
        .agg(
            F.sum("_qty").cast("long").alias("qty_sold"),
            F.sum("_revenue").cast("double").alias("revenue"),
            (F.sum("_prices").cast("double") / F.sum("_lines")).alias("avg_price"),
        )
    )


def daily_shelf(readings: DataFrame) -> DataFrame:
    """Mean shelf reading per store, product and day."""
    return (
        by_day(readings)
        .groupBy(*KEYS)
        .agg(round_even(F.avg("shelf_qty"), 2).alias("avg_shelf_qty"))
    )


def join_daily(daily: DataFrame, shelf: DataFrame) -> DataFrame:
    """Sales days and shelf days side by side; either may be missing."""
    return daily.join(shelf, KEYS, "full_outer")


def fill_missing_measures(joined: DataFrame, shelf_default: float = DEFAULT_SHELF) -> DataFrame:
    return (
        joined.withColumn("qty_sold", F.coalesce("qty_sold", F.lit(0)).cast("long"))
        .withColumn("revenue", round_even(F.coalesce("revenue", F.lit(0.0)), 2))
        .withColumn(
            "avg_shelf_qty", round_even(F.coalesce("avg_shelf_qty", F.lit(shelf_default)), 2)
        )
    )


def with_default_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("graph_co_stock_flag", F.lit(False)).withColumn(
        "graph_substitute_available", F.lit(False)
    )


def with_date_text(df: DataFrame) -> DataFrame:
    """Days as text, for sinks that store them so."""
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def series_of(daily: DataFrame, pairs: str = "all") -> DataFrame:
    """The series of the dense table: every store with every product.

    ``pairs="observed"`` keeps only pairs that sold at least once. Products are
    dealt into lanes and meet a copy of the stores in each, so neither list is
    in one row or one task.
    """
    if pairs == "observed":
        return daily.select(*SERIES).distinct()
    lanes = shuffle_partitions(daily.sparkSession)
    stores = daily.select("store_id").distinct().withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    products = daily.select("sku").distinct().withColumn("_lane", F.pmod(F.xxhash64("sku"), F.lit(lanes)).cast("int"))
    # The explicit count keeps adaptive execution from putting all lanes into one task.
    return products.repartition(lanes, "_lane").join(stores, "_lane").select(*SERIES)


def opening_prices(
    daily: DataFrame,
    series: DataFrame,
    default: float = DEFAULT_PRICE,
    partition_by_store: bool = False,
) -> DataFrame:
    """The price that holds in a series before its own first price.

    Prices fill forward through a product's stores in store order, so a series
    starts with the last price of the nearest earlier store that has one, else
    with its own first price, else with the first price of the next store that
    has one. ``partition_by_store`` stops the fill at the store.
    """
    has_price = F.col("avg_price").isNotNull()
    ends = daily.groupBy(*SERIES).agg(
        F.min_by("avg_price", F.when(has_price, F.col("date"))).alias("_first"),
        F.max_by("avg_price", F.when(has_price, F.col("date"))).alias("_last"),
    )
    joined = series.join(ends, SERIES, "left")
    if partition_by_store:
        opening = F.coalesce("_first", F.lit(default))
    else:
        stores = Window.partitionBy("sku").rowsBetween(Window.unboundedPreceding, -1)
        opening = F.coalesce(
            F.last("_last", True).over(stores.orderBy("store_id")),
            "_first",
            F.last("_first", True).over(stores.orderBy(F.desc("store_id"))),
            F.lit(default),
        )
    return joined.select(*SERIES, opening.alias("opening_price"))


def carried_rows(
    daily: DataFrame,
    shelf: DataFrame | None = None,
    sentiment: DataFrame | None = None,
    price_default: float = DEFAULT_PRICE,
    partition_by_store: bool = False,
    pairs: str = "all",
    among: DataFrame | None = None,
    series: DataFrame | None = None,
    days: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Sparse rows of the dense table, each with the day before which the next one begins.

    One opening row per series (first day, opening price, sentiment) is put
    together with the sales and shelf days; prices are carried on these rows.
    ``series`` limits the work to some series; ``among`` are then all series of
    their products, as opening prices come from other stores, and ``days`` the
    first and last day of the whole table.
    """
    spark = daily.sparkSession
    first_day, last_day = days or (
        daily.agg(F.min("date").alias("d")).scalar(),
        daily.agg(F.max("date").alias("d")).scalar(),
    )

    among = series_of(daily, pairs) if among is None else among
    opening = opening_prices(daily, among, price_default, partition_by_store)
    if series is not None:
        opening = opening.join(series, SERIES, "left_semi")
        daily = daily.join(series, SERIES, "left_semi")
        shelf = None if shelf is None else shelf.join(series, SERIES, "left_semi")
    if sentiment is None:
        opening = opening.withColumn("sentiment_score", F.lit(0.0))
    else:
        opening = with_sentiment(opening, sentiment)
    opening = opening.select(
        *SERIES, first_day.alias("date"), "opening_price", "sentiment_score",
    )

    rows = daily.select(*KEYS, "qty_sold", "revenue", "avg_price").unionByName(
        opening, allowMissingColumns=True
    )
    if shelf is None:
        rows = rows.withColumn("avg_shelf_qty", F.lit(None).cast("double"))
    else:
        in_range = shelf.filter(F.col("date").between(first_day, last_day))
        rows = rows.unionByName(
            in_range.select(*KEYS, "avg_shelf_qty"), allowMissingColumns=True
        )

    values = ["qty_sold", "revenue", "avg_price", "avg_shelf_qty", "opening_price", "sentiment_score"]
    # The explicit count keeps adaptive execution from folding the sparse rows
    # into a few tasks that would then emit the whole dense table.
    sparse = (
        rows.repartition(shuffle_partitions(spark), *SERIES)
        .groupBy(*KEYS)
        .agg(*[F.max(c).alias(c) for c in values])
    )
    by_day = Window.partitionBy(*SERIES).orderBy("date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.first("opening_price", True).over(so_far)
    price = F.coalesce(F.last("avg_price", True).over(so_far), opened)
    return (
        sparse.withColumn("_until", F.coalesce(F.lead("date").over(by_day), F.date_add(last_day, 1)))
        .withColumn("_price", price)
        .withColumn("_opened", opened)
        .withColumn("_sentiment", F.first("sentiment_score", True).over(so_far))
        # A shelf series without any opening row belongs to no store and
        # product that sells.
        .filter(F.col("_opened").isNotNull())
    )


def stretch(carried: DataFrame, first: Column, last: Column, shelf_default: float = DEFAULT_SHELF) -> DataFrame:
    """A dense row for every day of each carried row from first to last."""
    days = carried.withColumn("_day", F.explode(F.sequence(first, last)))
    own = F.col("_day") == F.col("date")
    dense = days.select(
        *SERIES,
        F.col("_day").alias("date"),
        F.when(own, F.col("qty_sold")).alias("qty_sold"),
        F.when(own, F.col("revenue")).alias("revenue"),
        round_even(F.col("_price"), 2).alias("avg_price"),
        F.when(own, F.col("avg_shelf_qty")).alias("avg_shelf_qty"),
        F.col("_sentiment").alias("sentiment_score"),
    )
    return with_default_flags(fill_missing_measures(dense, shelf_default))


def densify(
    daily: DataFrame,
    shelf: DataFrame | None = None,
    sentiment: DataFrame | None = None,
    price_default: float = DEFAULT_PRICE,
    shelf_default: float = DEFAULT_SHELF,
    partition_by_store: bool = False,
    pairs: str = "all",
) -> DataFrame:
    """Every day of every series, with the fill rules applied.

    The dense table is never joined or shuffled: the sparse rows are shuffled
    once by series, and each then stretches to the day before its successor.
    """
    carried = carried_rows(daily, shelf, sentiment, price_default, partition_by_store, pairs)
    return stretch(carried, F.col("date"), F.date_sub("_until", 1), shelf_default)


def with_sentiment(df: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Look the product's score up; products without reviews are neutral."""
    scores = sentiment.select("sku", F.col("sentiment_score").alias("_score"))
    return (
        df.join(scores, "sku", "left")
        .withColumn("sentiment_score", F.coalesce("_score", F.lit(0.0)))
        .drop("_score")
    )


def curate(
    sales: DataFrame,
    readings: DataFrame | None = None,
    sentiment: DataFrame | None = None,
    dedupe: bool = False,
    **rules,
) -> DataFrame:
    """The whole transform. ``rules`` are those of :func:`densify`.

    The daily roll-up feeds several small look-ups, so it is written once as a
    stage table instead of scanning the raw rows for each of them.
    """
    if dedupe:
        sales = sales.dropDuplicates()
    daily = stage(daily_sales_filled(sales), "daily-sales")
    shelf = None if readings is None else daily_shelf(readings)
    return densify(daily, shelf, sentiment, **rules)


def stage_curated(curated: DataFrame, name: str = "curated") -> DataFrame:
    """Store the dense table, or one made from it, bucketed by series."""
    return stage_by(curated, name, SERIES, KEYS)


def replay_sales(sales: DataFrame) -> DataFrame:
    """Sales rows as point-of-sale events, with the replay's defaults."""
    return sales.select(
        "store_id",
        "sku",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.coalesce("qty_sold", F.lit(0)).cast("int").alias("qty_sold"),
        F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("price"),
        F.coalesce("channel", F.lit("in-store")).alias("channel"),
    )


def replay_shelf(sales: DataFrame, capacity: int = 25) -> DataFrame:
    """Sales rows as the shelf events they would have caused."""
    left = F.lit(capacity) - F.coalesce("qty_sold", F.lit(0))
    return sales.select(
        "store_id",
        "sku",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.greatest(F.lit(0), left).cast("int").alias("shelf_qty"),
        sensor_id(F.col("store_id"), F.col("sku")).alias("sensor_id"),
    )
