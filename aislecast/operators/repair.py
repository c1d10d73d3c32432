"""Keep the stored dense table right after late, changed or emptied days.

A daily row decides its own day, and the price of the days up to the next priced
row of its series. So a change touches a span of days of one series; only these
rows are made anew, and only the parts of the table that hold some are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.operators.curate import DEFAULT_SHELF, KEYS, SERIES, carried_rows, opening_prices, series_of, stretch
from aislecast.operators.fill import DEFAULT_PRICE
from aislecast.session import stage
from aislecast.sources.versions import VersionedTable


def dense_table(root: str, buckets: int) -> VersionedTable:
    """The dense table in parts by month and bucket of series."""
    return VersionedTable(root, tuple(SERIES), buckets, "date")


def changed_rows(old: DataFrame, new: DataFrame, values: list[str]) -> DataFrame:
    """Keys of days that came, went or changed, and whether each value did (``changed_<value>``)."""
    side = lambda df, s: df.select(*KEYS, F.lit(True).alias(f"_{s}"), *[F.col(v).alias(f"_{s}_{v}") for v in values])
    both = side(old, "old").join(side(new, "new"), KEYS, "full_outer")
    differs = {v: ~F.col(f"_old_{v}").eqNullSafe(F.col(f"_new_{v}")) for v in values}
    gone = F.col("_old").isNull() | F.col("_new").isNull()
    some = gone
    for d in differs.values():
        some = some | d
    return both.filter(some).select(*KEYS, *[d.alias(f"changed_{v}") for v, d in differs.items()])


def _bounds(daily: DataFrame) -> tuple:
    row = daily.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    return row["first"], row["last"]


def _day(value) -> Column:
    return F.lit(value).cast("date")


def _until_next_price(changed: DataFrame, daily: DataFrame, last: Column) -> DataFrame:
    """Spans from each changed price to the day before the series' next own price."""
    own = daily.filter(F.col("avg_price").isNotNull()).select(*KEYS, F.lit(False).alias("_changed"))
    rows = own.unionByName(changed.select(*KEYS, F.lit(True).alias("_changed"))).groupBy(*KEYS).agg(
        F.max("_changed").alias("_changed"), F.bool_or(~F.col("_changed")).alias("_priced")
    )
    after = Window.partitionBy(*SERIES).orderBy("date").rowsBetween(1, Window.unboundedFollowing)
    following = F.min(F.when(F.col("_priced"), F.col("date"))).over(after)
    spans = rows.withColumn("_next", following).filter("_changed")
    return spans.select(*SERIES, F.col("date").alias("start"), F.coalesce(F.date_sub("_next", 1), last).alias("end"))


def _joined(spans: DataFrame) -> DataFrame:
    """Spans of a series that meet, as one."""
    before = Window.partitionBy(*SERIES).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("start") > F.date_add(F.max("end").over(before), 1), F.lit(True))
    so_far = Window.partitionBy(*SERIES).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    numbered = spans.withColumn("_new", begins).withColumn("_island", F.sum(F.col("_new").cast("int")).over(so_far))
    return numbered.groupBy(*SERIES, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def touched_spans(
    old: DataFrame,
    new: DataFrame,
    old_shelf: DataFrame | None = None,
    new_shelf: DataFrame | None = None,
    price_default: float = DEFAULT_PRICE,
    partition_by_store: bool = False,
    pairs: str = "all",
) -> DataFrame:
    """store_id, sku, start, end: the days of the dense table that may differ after a change of the roll-ups.

    Also days whose opening price changed, because a neighbouring store got
    another price, days by which the calendar grew or shrank, and all days of
    series that came or went.
    """
    (first, last), (first_, last_) = _bounds(old), _bounds(new)
    low, high = _day(min(first, first_)), _day(max(last, last_))
    changed = stage(changed_rows(old, new, ["qty_sold", "revenue", "avg_price"]), "changed-days")
    day = lambda df: df.select(*SERIES, F.col("date").alias("start"), F.col("date").alias("end"))
    spans = day(changed).unionByName(_until_next_price(changed.filter("changed_avg_price"), new, high))
    if old_shelf is not None or new_shelf is not None:
        none = new.sparkSession.createDataFrame([], "store_id string, sku string, date date, avg_shelf_qty double")
        spans = spans.unionByName(day(changed_rows(old_shelf or none, new_shelf or none, ["avg_shelf_qty"])))

    series, series_ = series_of(old, pairs), series_of(new, pairs)
    whole = lambda df, start, end: df.select(*SERIES, start.alias("start"), end.alias("end"))
    spans = spans.unionByName(whole(series.join(series_, SERIES, "left_anti"), low, high))
    spans = spans.unionByName(whole(series_.join(series, SERIES, "left_anti"), low, high))
    for one, other in ((first, first_), (last_, last)):
        if one != other:
            a, b = sorted((one, other))
            spans = spans.unionByName(whole(series_, _day(a), _day(b)))

    # Opening prices depend on the other stores of a product.
    skus = changed.filter("changed_avg_price").select("sku").distinct()
    some = lambda df: df.join(skus, "sku", "left_semi")
    opening = lambda daily, name: opening_prices(some(daily), some(series_of(daily, pairs)), price_default, partition_by_store).withColumnRenamed("opening_price", name)
    moved = opening(new, "_new").join(opening(old, "_old"), SERIES).filter("_new <> _old").select(*SERIES)
    priced = some(new).filter(F.col("avg_price").isNotNull()).groupBy(*SERIES).agg(F.min("date").alias("_first"))
    ends = F.coalesce(F.date_sub("_first", 1), high)
    spans = spans.unionByName(moved.join(priced, SERIES, "left").select(*SERIES, low.alias("start"), ends.alias("end")).filter("start <= end"))
    return stage(_joined(spans), "touched-spans")


def repair_dense(
    table: VersionedTable,
    old: DataFrame,
    new: DataFrame,
    old_shelf: DataFrame | None = None,
    new_shelf: DataFrame | None = None,
    sentiment: DataFrame | None = None,
    price_default: float = DEFAULT_PRICE,
    shelf_default: float = DEFAULT_SHELF,
    partition_by_store: bool = False,
    pairs: str = "all",
) -> int:
    """Bring a stored dense table from one state of the roll-ups to the next; returns the new version.

    ``old`` and ``new`` are the daily roll-ups the table was made from and is to
    be made from. It then equals a full rebuild. Sentiment is taken as given and
    is not looked at for changes.
    """
    spark = new.sparkSession
    base, _ = table.record.read(spark)
    spans = touched_spans(old, new, old_shelf, new_shelf, price_default, partition_by_store, pairs)
    if spans.isEmpty():
        return base
    months = F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month"))
    parts = table.touched(spans.select(*SERIES, F.explode(months).alias("date")))
    in_span = lambda df, s: [df[c] == s[f"_{c}"] for c in SERIES]
    named = spans.select(*[F.col(c).alias(f"_{c}") for c in SERIES], "start", "end")

    stored = table.read(spark, base, parts)
    kept = stored.join(named, [*in_span(stored, named), F.col("date").between(F.col("start"), F.col("end"))], "left_anti")

    series = spans.select(*SERIES).distinct()
    first, last = _bounds(new)
    skus = spans.select("sku").distinct()
    among = series_of(new, pairs).join(skus, "sku", "left_semi")
    carried = carried_rows(
        new.join(skus, "sku", "left_semi"), new_shelf, sentiment, price_default, partition_by_store, pairs,
        among, series, (_day(first), _day(last)),
    )
    until = F.date_sub("_until", 1)
    begin, end = F.greatest("date", "start"), F.least(until, F.col("end"))
    met = carried.join(named, [*in_span(carried, named), (F.col("date") <= F.col("end")) & (until >= F.col("start"))]).filter(begin <= end)
    rows = stretch(met, begin, end, shelf_default)
    return table.replace(kept.unionByName(rows.select(*kept.columns)), parts, base)
