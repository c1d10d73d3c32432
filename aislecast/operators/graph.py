"""Product graph as tables: nodes, edges and point-in-time features.

Edges are rows of (src, dst). One hop is a join; nothing needs more hops.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aislecast.functions.ids import name_by_suffix
from aislecast.functions.numeric import round_even, unit_interval
from aislecast.operators.curate import SERIES
from aislecast.operators.ordering import dense_index
from aislecast.session import stage

# Names assigned by id suffix, and the supplier dimension.
CATEGORIES = ("Beverages", "Snacks", "Dairy", "Bakery", "Household")
REGIONS = ("North", "South", "East", "West", "Central")
SUPPLIERS = (
    ("SUP_GLOBAL_01", "Global Retail Distributors", 3),
    ("SUP_LOCAL_02", "FreshSource Logistics", 1),
    ("SUP_PRIME_03", "Prime Goods Wholesale", 2),
)
PRICE_TOLERANCE = 0.35


def product_category(sku: Column, delimiter: str = "_") -> Column:
    return name_by_suffix(sku, CATEGORIES, "General", delimiter)


def sku_stats(curated: DataFrame) -> DataFrame:
    return curated.groupBy("sku").agg(
        F.sum("qty_sold").alias("total_qty"),
        F.sum("revenue").alias("total_rev"),
        F.avg("avg_shelf_qty").alias("avg_shelf"),
        F.avg("sentiment_score").alias("avg_sentiment"),
    )


def products(curated: DataFrame, delimiter: str = "_") -> DataFrame:
    """Product nodes: category, mean selling price and price band."""
    price = F.when(F.col("total_qty") > 0, F.try_divide("total_rev", "total_qty")).otherwise(15.0)
    band = (
        F.when(F.col("avg_price") < 10, "Budget")
        .when(F.col("avg_price") < 25, "Mid-Tier")
        .otherwise("Premium")
    )
    return (
        sku_stats(curated)
        .withColumn("avg_price", round_even(price, 2))
        .select(
            "sku",
            product_category(F.col("sku"), delimiter).alias("category"),
            band.alias("price_band"),
            "avg_price",
        )
    )


def stores(curated: DataFrame, delimiter: str = "_") -> DataFrame:
    """Store nodes; the format alternates in store order."""
    even = F.col("_index") % 2 == 0
    return dense_index(curated, "store_id", "_index").select(
        "store_id",
        name_by_suffix(F.col("store_id"), REGIONS, "Central", delimiter).alias("region"),
        F.when(even, "Supercenter").otherwise("Express").alias("format"),
    )


def suppliers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SUPPLIERS, "supplier_id string, supplier_name string, lead_time_days int"
    )


def supplied_by(product_nodes: DataFrame, supplier_nodes: DataFrame) -> DataFrame:
    """Products go to suppliers in turn, both in id order."""
    ranked = dense_index(supplier_nodes, "supplier_id", "_turn")
    turns = supplier_nodes.agg(F.countDistinct("supplier_id").alias("n")).scalar()
    return (
        dense_index(product_nodes, "sku", "_index")
        .withColumn("_turn", (F.col("_index") % turns).cast("int"))
        .join(ranked, "_turn")
        .select("sku", "supplier_id")
    )


def sold_at(curated: DataFrame) -> DataFrame:
    return curated.groupBy(*SERIES).agg(
        F.avg("qty_sold").alias("avg_daily_qty"),
        F.sum("revenue").alias("total_revenue"),
        F.lit(True).alias("active"),
    )


def substitutes(
    product_nodes: DataFrame, tolerance: float = PRICE_TOLERANCE, crowd: int = 1000
) -> DataFrame:
    """Pairs of one category whose prices lie within the tolerance.

    The tolerance is relative to the product with the smaller id. Prices are
    cut into bands one upper tolerance wide on a log scale, so partners can
    only lie in the same band or in a few next to it, and the join compares
    those instead of every pair of the category. The products of a band are
    dealt in id order into parts of ``crowd``: each product has one part, and
    is looked for by the parts of the bands in reach that begin before it. So a
    category that holds all products, at one price even, is many tasks, and no
    pair is met from its other end. Nodes are few next to their pairs, so they
    are always shuffled: with a broadcast, a task would be a file of nodes.
    """
    width = math.log1p(tolerance)
    lowest = math.floor(math.log1p(-tolerance) / width) if tolerance < 1 else None
    if lowest is None:
        raise ValueError("the tolerance must be below 1")
    price = F.col("avg_price")
    band = F.when(price > 0, F.floor(F.log(F.when(price > 0, price)) / width))
    known = F.col("sku").isNotNull() & F.col("category").isNotNull()
    nodes = product_nodes.filter((price >= 0) & known).select(
        "sku", "category", price, F.coalesce(band, F.lit(-(10**6))).alias("_band")
    )
    cell = ["category", "_band"]
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("sku")) - 1
    first = nodes.select(
        F.col("sku").alias("src"), *cell, price.alias("_p1"), F.floor(place / crowd).cast("int").alias("_part")
    )
    parts = first.groupBy(*cell, "_part").agg(F.min("src").alias("_least"))
    second = nodes.select(
        F.col("sku").alias("dst"),
        F.col("category"),
        price.alias("_p2"),
        F.explode(F.sequence(F.col("_band") - 2, F.col("_band") + (1 - lowest))).alias("_band"),
    ).join(parts, cell).filter(F.col("_least") < F.col("dst")).drop("_least")
    gap = F.abs(F.col("_p1") - F.col("_p2"))
    return (
        second.join(first.hint("merge"), [*cell, "_part"])
        .filter((F.col("src") < F.col("dst")) & (gap <= F.lit(tolerance) * F.col("_p1")))
        .select(
            "src", "dst", "category",
            (F.lit(1.0) - F.try_divide(gap, F.col("_p1"))).alias("similarity_score"),
        )
    )


def neighbours(edges: DataFrame) -> DataFrame:
    """Edges in both directions, each once, from one pass over the edges."""
    there = F.struct(F.col("src"), F.col("dst"))
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select(F.inline(F.array(there, back))).distinct()


def graph_summary(
    product_nodes: DataFrame, store_nodes: DataFrame, supplier_nodes: DataFrame,
    sold: DataFrame, subs: DataFrame, supply: DataFrame,
) -> DataFrame:
    """Node and edge counts; undirected edges count once per direction."""

    def n(df: DataFrame, times: int = 1) -> Column:
        return df.agg((F.count(F.lit(1)) * times).alias("n")).scalar()

    return product_nodes.sparkSession.range(1).select(
        n(product_nodes).alias("products"),
        n(store_nodes).alias("stores"),
        n(supplier_nodes).alias("suppliers"),
        n(sold).alias("sold_at"),
        n(subs, 2).alias("substitutes"),
        n(supply).alias("supplied_by"),
    )


def active_days(curated: DataFrame, cutoff=None) -> DataFrame:
    """Days with sales per series, next to the days on record per store."""
    history = curated if cutoff is None else curated.filter(F.col("date") <= F.lit(cutoff))
    sold = history.filter("qty_sold > 0").groupBy(*SERIES)
    days = history.groupBy("store_id").agg(F.countDistinct("date").alias("store_days"))
    return sold.agg(F.countDistinct("date").alias("active_days")).join(days, "store_id")


def _frequency(active: DataFrame, peers: DataFrame) -> DataFrame:
    """Mean peer frequency; a product without peers stands for itself."""
    mean = F.coalesce(F.col("_peer_mean"), F.col("active_days").cast("double"))
    return active.join(peers, SERIES, "left").select(
        *SERIES, unit_interval(mean / F.col("store_days")).alias("graph_co_stock_freq")
    )


def co_stock_frequency(curated: DataFrame, neighbour_edges: DataFrame, cutoff=None) -> DataFrame:
    """How often a product's neighbours sell in the same store.

    A neighbour that never sold there counts as zero days, so it is enough to
    add up those that did and divide by the number of neighbours.
    """
    active = stage(active_days(curated, cutoff), "active-days")
    degree = neighbour_edges.groupBy("src").agg(F.count(F.lit(1)).alias("_degree"))
    sums = (
        active.join(neighbour_edges, F.col("sku") == F.col("dst"))
        .groupBy("store_id", "src")
        .agg(F.sum("active_days").alias("_days"))
    )
    peers = (
        active.select(*SERIES)
        .join(degree, F.col("sku") == F.col("src"))
        .drop("src")
        .join(sums.withColumnRenamed("src", "sku"), SERIES, "left")
        .select(*SERIES, (F.coalesce("_days", F.lit(0)) / F.col("_degree")).alias("_peer_mean"))
    )
    return _frequency(active, peers)


def co_stock_frequency_by_group(
    curated: DataFrame, groups: DataFrame, cutoff=None
) -> DataFrame:
    """The same when every product of a group neighbours every other.

    Group totals less the own part replace the pairs. ``groups`` has one row
    (sku, category) per product.
    """
    active = stage(active_days(curated, cutoff), "active-days")
    sizes = groups.groupBy("category").agg((F.count(F.lit(1)) - 1).alias("_others"))
    member = active.join(groups, "sku")
    totals = member.groupBy("store_id", "category").agg(F.sum("active_days").alias("_days"))
    peers = (
        member.join(sizes, "category")
        .join(totals, ["store_id", "category"])
        .filter("_others > 0")
        .select(*SERIES, ((F.col("_days") - F.col("active_days")) / F.col("_others")).alias("_peer_mean"))
    )
    return _frequency(active, peers)


def with_previous_shelf(curated: DataFrame) -> DataFrame:
    by_day = Window.partitionBy(*SERIES).orderBy("date")
    return curated.withColumn(
        "prev_day_shelf", F.coalesce(F.lag("avg_shelf_qty").over(by_day), F.lit(0.0))
    )


# Days packed into one integer of the availability bit sets.
_BITS = 62


def _day_bit() -> tuple[Column, Column]:
    """The word of a day, and its bit there."""
    day = F.unix_date("date")
    bit = F.pmod(day, F.lit(_BITS)).cast("int")
    return F.floor(day / _BITS), F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _stocked_words(lagged: DataFrame, minimum: float) -> DataFrame:
    """store_id, sku, _word, _days: the days a product had stock the day before."""
    word, bit = _day_bit()
    return (
        lagged.filter(F.col("prev_day_shelf") > minimum)
        .groupBy(*SERIES, word.alias("_word"))
        .agg(F.bit_or(bit).alias("_days"))
    )


def _with_reached_days(lagged: DataFrame, reached: DataFrame) -> DataFrame:
    """The flag of every day from the words (store_id, sku, _word, _days) that hold it."""
    word, bit = _day_bit()
    peers = reached.groupBy(*SERIES).agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_days"))).alias("_peers")
    )
    days = F.coalesce(F.element_at("_peers", word), F.lit(0).cast("long"))
    stocked = days.bitwiseAND(bit) != 0
    return (
        lagged.drop("prev_day_shelf", "graph_substitute_available")
        .join(peers, SERIES, "left")
        .withColumn("graph_substitute_available", F.coalesce(stocked.cast("double"), F.lit(0.0)))
        .drop("_peers")
    )


def with_substitute_available(
    curated: DataFrame, neighbour_edges: DataFrame, minimum: float = 2.0
) -> DataFrame:
    """1.0 on days when a neighbour had shelf stock the day before, else 0.0.

    Availability is packed into bit sets, 62 days per integer, before it
    follows the edges: a series with ten years of days crosses an edge as 59
    integers, and OR-ing them combines on the map side. The dense rows
    themselves are only shuffled by series, as for the lag.
    """
    lagged = with_previous_shelf(curated)
    reached = (
        _stocked_words(lagged, minimum)
        .join(neighbour_edges, F.col("sku") == F.col("dst"))
        .groupBy("store_id", F.col("src").alias("sku"), "_word")
        .agg(F.bit_or("_days").alias("_days"))
    )
    return _with_reached_days(lagged, reached)


def with_substitute_available_by_group(
    curated: DataFrame, groups: DataFrame, minimum: float = 2.0
) -> DataFrame:
    """The same when every product of a group neighbours every other.

    Another product differs from this one in some bit of their numbers. So a
    group keeps, for every bit, the days of its products that have it and of
    those that have not; a product takes the days of the other side of each
    bit, and its own days are in none of them. Two sets a bit combine on the
    map side, and no dense row leaves its series.
    """
    lagged = with_previous_shelf(curated)
    numbers = stage(dense_index(groups.select("sku").distinct(), "sku", "_number").join(groups, "sku"), "group-numbers")
    most = numbers.agg(F.max("_number")).first()[0] or 0
    bits = range(max(1, int(most).bit_length()))
    has = lambda b: F.col("_number").bitwiseAND(F.lit(1 << b)) != 0
    sides = [F.bit_or(F.when(has(b) == side, F.col("_days"))).alias(f"_side{int(side)}_{b}") for b in bits for side in (False, True)]
    held = _stocked_words(lagged, minimum).join(numbers, "sku").groupBy("store_id", "category", "_word").agg(*sides)
    series = curated.select(*SERIES).distinct().join(numbers, "sku")
    days = F.lit(0).cast("long")
    for b in bits:
        other = F.when(has(b), F.col(f"_side0_{b}")).otherwise(F.col(f"_side1_{b}"))
        days = days.bitwiseOR(F.coalesce(other, F.lit(0).cast("long")))
    reached = series.join(held, ["store_id", "category"]).select(*SERIES, "_word", days.alias("_days")).filter("_days <> 0")
    return _with_reached_days(lagged, reached)


def point_in_time_features(
    curated: DataFrame,
    neighbour_edges: DataFrame | None = None,
    groups: DataFrame | None = None,
    cutoff=None,
    default: float = 0.5,
) -> DataFrame:
    """Both graph features. Frequencies see days up to the cutoff only, stock
    is the day before's, so no row depends on its own day or on later ones.

    Pass edges, or groups for the whole-group neighbourhood.
    """
    if (neighbour_edges is None) == (groups is None):
        raise ValueError("pass either neighbour_edges or groups")
    if groups is None:
        stocked = with_substitute_available(curated, neighbour_edges)
        frequency = co_stock_frequency(curated, neighbour_edges, cutoff)
    else:
        stocked = with_substitute_available_by_group(curated, groups)
        frequency = co_stock_frequency_by_group(curated, groups, cutoff)
    return stocked.join(frequency, SERIES, "left").withColumn(
        "graph_co_stock_freq", F.coalesce("graph_co_stock_freq", F.lit(default))
    )


def top_selling_pairs(daily: DataFrame, top: int = 5) -> DataFrame:
    """Products that share a store's weekly top list, with the weeks shared.

    The list length bounds the pairs per store and week. Ties are broken by
    product, so a list never grows beyond its length.
    """
    weekly = daily.groupBy("store_id", F.date_trunc("week", "date").alias("week"), "sku").agg(
        F.sum("qty_sold").alias("qty")
    )
    best = Window.partitionBy("store_id", "week").orderBy(F.desc("qty"), "sku")
    listed = (
        weekly.filter("qty > 0")
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= top)
        .select("store_id", "week", "sku")
    )
    skus = F.array_sort(F.collect_list("sku"))
    partners = F.flatten(
        F.transform(
            F.col("skus"),
            lambda a: F.transform(
                F.filter(F.col("skus"), lambda b: b > a),
                lambda b: F.struct(a.alias("sku_a"), b.alias("sku_b")),
            ),
        )
    )
    return (
        listed.groupBy("store_id", "week")
        .agg(skus.alias("skus"))
        .select("store_id", F.explode(partners).alias("p"))
        .groupBy("p.sku_a", "p.sku_b")
        .agg(F.count(F.lit(1)).alias("weeks"), F.countDistinct("store_id").alias("stores"))
    )


def unique_node_report(nodes: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Duplicate keys per node table; zero everywhere if all keys are unique."""
    parts = [
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicate_keys"), F.count(F.lit(1)).alias("keys"))
        .select(F.lit(name).alias("node"), "keys", "duplicate_keys")
        for name, df, key in nodes
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


