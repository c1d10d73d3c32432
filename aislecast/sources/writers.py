"""Table writers: raw zone, curated zone, predictions and the warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aislecast.contracts import REVIEWS, SALES, require_columns
from aislecast.functions.dates import with_event_date
from aislecast.operators.curate import with_date_text


def gather_days(df: DataFrame) -> DataFrame:
    """Bring the rows of a day together, ahead of a write by day.

    Adaptive execution splits large days over tasks and joins small ones, by
    the sizes it measures in the shuffle; the input is evaluated once.
    """
    return df.hint("rebalance", "date")


def write_by_date(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """One folder per day; only the days that are written are replaced."""
    (
        gather_days(df)
        .write.format(fmt)
        .options(partitionOverwriteMode="dynamic", **options)
        .partitionBy("date")
        .mode("overwrite")
        .save(path)
    )


def counted_by_date(df: DataFrame, path: str, fmt: str = "parquet", **options) -> int:
    """As :func:`write_by_date`, and the number of rows, counted by the tasks that write them."""
    seen = Observation()
    (
        gather_days(df)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.format(fmt)
        .options(partitionOverwriteMode="dynamic", **options)
        .partitionBy("date")
        .mode("overwrite")
        .save(path)
    )
    return seen.get["rows"]


def land_sales(sales: DataFrame, path: str, fmt: str = "csv") -> int:
    """Raw sales by event day; returns the rows written. Rows without a day land in a folder of their own."""
    require_columns(sales, SALES, "sales")
    options = {"header": True} if fmt == "csv" else {}
    return counted_by_date(with_event_date(sales), path, fmt, **options)


def land_reviews(reviews: DataFrame, path: str) -> None:
    require_columns(reviews, REVIEWS, "reviews")
    write_csv(reviews.select("sku", "review_text"), path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_curated(curated: DataFrame, folder: str, fmt: str = "parquet", csv: bool = True) -> None:
    """The curated table: as a table by day, and as a CSV copy."""
    write_by_date(curated, f"{folder}/sales_daily", fmt)
    if csv:
        write_csv(with_date_text(curated), f"{folder}/sales_daily_csv")


def write_version(df: DataFrame, folder: str, version: str) -> str:
    """A new version of a table next to the one that is being read."""
    path = f"{folder}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_forecast(forecasts: DataFrame, path: str) -> None:
    forecasts.write.mode("overwrite").parquet(path)


def write_anomalies(anomalies: DataFrame, folder: str) -> None:
    """Parquet, JSON and CSV of one result, computed once."""
    spark = anomalies.sparkSession
    anomalies.write.mode("overwrite").parquet(f"{folder}/parquet")
    stored = spark.read.schema(anomalies.schema).parquet(f"{folder}/parquet")
    stored.write.mode("overwrite").json(f"{folder}/json")
    write_csv(stored, f"{folder}/csv")


def write_acknowledged(state: DataFrame, folder: str, version: str) -> str:
    """The triaged anomalies as a new version; the old one stays readable."""
    return write_version(state, folder, version)


# Comments of the experimental columns in the warehouse.
COLUMN_COMMENTS = {
    "graph_co_stock_freq": "Experimental: how often graph neighbours sell in the store",
    "graph_substitute_available": "Experimental: a substitute had stock the day before",
}


def sync_warehouse(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], database: str | None = None
) -> dict[str, int]:
    """Replace each table that exists; returns its row count.

    Running it twice leaves the same tables.
    """
    counts: dict[str, int] = {}
    for name, df in tables.items():
        if df is None:
            continue
        full = f"{database}.{name}" if database else name
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet").saveAsTable(full)
        for column, comment in COLUMN_COMMENTS.items():
            if column in df.columns:
                spark.sql(f"ALTER TABLE {full} ALTER COLUMN {column} COMMENT '{comment}'")
        counts[name] = seen.get["rows"]
    return counts


def sync_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Replace a table of a relational warehouse, keeping its definition."""
    df.write.mode("overwrite").options(truncate="true", **options).jdbc(url, table)


def publish_events(events: DataFrame, servers: str, topic: str) -> None:
    """Events to a Kafka topic, keyed by store. Needs the connector."""
    keyed_json(events).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def keyed_json(events: DataFrame, key: str = "store_id") -> DataFrame:
    """Key and JSON value, as a message sink takes them."""
    return events.select(
        F.col(key).alias("key"), F.to_json(F.struct(*events.columns)).alias("value")
    )


def write_buffer(events: DataFrame, folder: str, stream: str) -> None:
    """Events as buffer files of one stream, one JSON record per line."""
    events.write.mode("append").json(f"{folder}/{stream}")
