"""Reporting queries over curated days, forecasts and anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.operators.anomalies import active_stockouts
from aislecast.operators.curate import KEYS, SERIES
from aislecast.operators.graph import product_category
from aislecast.operators.ordering import global_position

FALLBACK_UNIT_PRICE = 185.0
LOW_STOCK = 5.0


def members(df: DataFrame, column: str) -> DataFrame:
    """Distinct stores or products, sorted."""
    return df.select(column).distinct().orderBy(column)


def daily_totals(curated: DataFrame) -> DataFrame:
    return curated.groupBy("date").agg(F.sum("qty_sold").alias("qty_sold"))


def forecast_totals(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("date").agg(
        F.sum("forecast_qty").alias("forecast_qty"),
        F.sum("lower_ci").alias("lower_ci"),
        F.sum("upper_ci").alias("upper_ci"),
    )


def trend(curated: DataFrame, forecasts: DataFrame, days: int = 60) -> DataFrame:
    """The last days of actual totals, then the forecast totals."""
    recent = daily_totals(curated).orderBy(F.desc("date")).limit(days)
    return recent.select("date", F.lit("actual").alias("kind"), "qty_sold").unionByName(
        forecast_totals(forecasts).withColumn("kind", F.lit("forecast")), allowMissingColumns=True
    )


def trend_by(curated: DataFrame, grain: str = "week") -> DataFrame:
    """Units and revenue per day, week or month."""
    return curated.groupBy(F.to_date(F.date_trunc(grain, "date")).alias("period")).agg(
        F.sum("qty_sold").alias("qty_sold"), F.sum("revenue").alias("revenue")
    )


def kpi_totals(curated: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Units, revenue, forecast units and mean price per unit, in one row."""
    ahead = forecasts.agg(F.sum("forecast_qty").alias("n")).scalar()
    return curated.agg(
        F.sum("qty_sold").alias("total_units"), F.sum("revenue").alias("total_revenue")
    ).select(
        "*",
        F.coalesce(ahead, F.lit(0.0)).alias("forecast_units"),
        F.when(F.col("total_units") > 0, F.try_divide("total_revenue", "total_units"))
        .otherwise(FALLBACK_UNIT_PRICE)
        .alias("unit_price"),
    )


def series_kpis(curated: DataFrame, forecasts: DataFrame, horizon: int = 14) -> DataFrame:
    """Mean demand, last shelf reading, revenue and horizon forecast per series."""
    nearest = Window.partitionBy(*SERIES).orderBy("date")
    ahead = (
        forecasts.withColumn("_rank", F.row_number().over(nearest))
        .filter(F.col("_rank") <= horizon)
        .groupBy(*SERIES)
        .agg(F.sum("forecast_qty").alias("horizon_forecast"))
    )
    return (
        curated.groupBy(*SERIES)
        .agg(
            F.avg("qty_sold").alias("mean_demand"),
            F.max_by("avg_shelf_qty", "date").alias("last_shelf"),
            F.sum("revenue").alias("total_revenue"),
        )
        .join(ahead, SERIES, "left")
    )


def recent_days(curated: DataFrame, days: int = 45) -> DataFrame:
    """The last days of every series."""
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    return (
        curated.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= days)
        .drop("_rank")
    )


def store_share(curated: DataFrame) -> DataFrame:
    """Units per store and their share of all units."""
    stores = curated.groupBy("store_id").agg(F.sum("qty_sold").alias("qty_sold"))
    total = curated.agg(F.sum("qty_sold").alias("n")).scalar()
    return stores.withColumn("share", F.try_divide("qty_sold", total))


def restock_list(curated: DataFrame, top: int = 5) -> DataFrame:
    """The first depleted series, in store and product order."""
    return active_stockouts(curated).orderBy(*SERIES).limit(top)


def preview(curated: DataFrame, rows: int = 100) -> DataFrame:
    return curated.orderBy(*KEYS).limit(rows)


def forecast_against_actual(curated: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Curated days with the forecast of the same day, where one was made."""
    return curated.join(forecasts.select(*KEYS, "forecast_qty"), KEYS, "left")


def days_with_open_alerts(curated: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Curated days with the number of open alerts of their series.

    Alerts are counted per series first, so days do not multiply by alerts.
    """
    open_alerts = (
        anomalies.filter(~F.col("acknowledged"))
        .groupBy(*SERIES)
        .agg(F.count(F.lit(1)).alias("open_alerts"))
    )
    return curated.join(open_alerts, SERIES, "left").withColumn(
        "open_alerts", F.coalesce("open_alerts", F.lit(0))
    )


def wape_accuracy(curated: DataFrame, forecasts: DataFrame) -> Column:
    """1 - sum of absolute errors / sum of actuals; 1 without any actual.

    Days without a forecast count as forecast 0, as a blank does in the model.
    """
    error = F.abs(F.col("qty_sold") - F.coalesce("forecast_qty", F.lit(0.0)))
    return (
        forecast_against_actual(curated, forecasts)
        .agg(
            F.when(
                F.sum("qty_sold") > 0, F.lit(1.0) - F.sum(error) / F.sum("qty_sold")
            ).otherwise(1.0).alias("w")
        )
        .scalar()
    )


def bi_measures(curated: DataFrame, forecasts: DataFrame, anomalies: DataFrame) -> DataFrame:
    """The business measures in one row."""
    is_open = (F.col("anomaly_type") == "stockout_risk") & ~F.col("acknowledged")
    return curated.agg(
        F.sum("revenue").alias("total_revenue"), F.sum("qty_sold").alias("total_units")
    ).select(
        "*",
        forecasts.agg(F.sum("forecast_qty").alias("n")).scalar().alias("projected_demand"),
        anomalies.agg(F.count_if(is_open).alias("n")).scalar().alias("open_stockout_alerts"),
        wape_accuracy(curated, forecasts).alias("wape_accuracy"),
    )


def demand_by_category(curated: DataFrame, delimiter: str = "_") -> DataFrame:
    """Units per product category; products are reduced before they are named."""
    return (
        curated.groupBy("sku")
        .agg(F.sum("qty_sold").alias("_qty"))
        .groupBy(product_category(F.col("sku"), delimiter).alias("category"))
        .agg(F.sum("_qty").alias("qty_sold"))
    )


def stock_status(curated: DataFrame, low: float = LOW_STOCK, risk: float = 2.0) -> DataFrame:
    """Series per stock status on their latest day."""
    shelf = F.col("shelf")
    status = (
        F.when(shelf <= risk, "Stockout risk").when(shelf < low, "Low stock").otherwise("In stock")
    )
    return (
        curated.groupBy(*SERIES)
        .agg(F.max_by("avg_shelf_qty", "date").alias("shelf"))
        .groupBy(status.alias("status"))
        .agg(F.count(F.lit(1)).alias("series"))
    )


def products_at_risk(curated: DataFrame, days: int = 28, top: int = 10) -> DataFrame:
    """The series with the fewest days of cover, and the revenue behind them."""
    cover = F.try_divide("shelf", "daily_demand")
    return (
        recent_days(curated, days)
        .groupBy(*SERIES)
        .agg(
            F.max_by("avg_shelf_qty", "date").alias("shelf"),
            F.avg("qty_sold").alias("daily_demand"),
            F.avg("revenue").alias("daily_revenue_at_risk"),
        )
        .filter("daily_demand > 0")
        .withColumn("days_of_cover", cover)
        .orderBy("days_of_cover", *SERIES)
        .limit(top)
    )


def inventory_levels(curated: DataFrame, low: float = LOW_STOCK) -> DataFrame:
    """Mean shelf level per store and product, marked when low."""
    return (
        curated.groupBy(*SERIES)
        .agg(F.avg("avg_shelf_qty").alias("avg_shelf_qty"))
        .withColumn("is_low", F.col("avg_shelf_qty") < low)
    )


def inventory_heatmap(curated: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """Products down, all stores across, or the named ones; naming them saves a job."""
    across = curated.groupBy("sku").pivot("store_id", None if stores is None else list(stores))
    return across.agg(F.avg("avg_shelf_qty"))


def enrichment_summary(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("graph_co_stock_freq").alias("mean_co_stock_freq"),
        F.avg("graph_substitute_available").alias("substitute_available_rate"),
    )


def export_slice(
    df: DataFrame, columns: Sequence[str], store_id: str | None = None, sku: str | None = None
) -> DataFrame:
    """The columns and series a download asks for."""
    for name, value in (("store_id", store_id), ("sku", sku)):
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df.select(*columns)


def first_events(sales: DataFrame, n: int) -> DataFrame:
    """The first events by time; 0 means all of them."""
    rest = [c for c in sales.columns if c != "ts"]
    return sales.orderBy("ts", *rest).limit(n) if n > 0 else sales


def numbered(df: DataFrame) -> DataFrame:
    """Rows with their position in (store, product, day) order."""
    return global_position(df)
