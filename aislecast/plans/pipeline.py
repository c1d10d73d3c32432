"""The batch jobs: refresh of the tables, and the run over an uploaded export."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislecast.functions.dates import with_event_date
from aislecast.operators.anomalies import detect_anomalies
from aislecast.operators.curate import curate, stage_curated
from aislecast.operators.evaluate import Backtest, backtest, error_metrics
from aislecast.operators.features import build_features, feature_columns
from aislecast.operators.forecast import (
    predict,
    recursive_forecast,
    train_demand_model,
    training_split,
)
from aislecast.operators.normalize import dataset_profile, normalize_export, require_history
from aislecast.operators.quality import quality_gate
from aislecast.session import stage
from aislecast.sources.writers import counted_by_date, land_sales, sync_warehouse


@dataclass(frozen=True)
class RunResult:
    """Tables of one run. Small results are one-row DataFrames as well."""

    curated: DataFrame
    quality: DataFrame
    forecasts: DataFrame
    anomalies: DataFrame
    backtest: Backtest
    profile: DataFrame
    validation: DataFrame
    warehouse_warning: str | None


def train_and_forecast(
    curated: DataFrame, horizon: int = 14, trees: int = 250, graph: bool = False,
    model_path: str | None = None, max_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Forecasts, and the validation errors whose RMSE sets their interval."""
    columns = feature_columns(curated, graph)
    features = stage_curated(build_features(curated), "features")
    train, valid = training_split(features, columns)
    model = train_demand_model(train, columns, trees, path=model_path, max_rows=max_rows)
    scored = predict(model, valid, columns)
    validation = stage(
        error_metrics(scored, "qty_sold", {"validation": "prediction"}), "validation"
    )
    sigma = validation.first()["validation_rmse"] or 0.0
    return recursive_forecast(model, features, columns, sigma, horizon), validation


def run_pipeline(
    sales: DataFrame,
    readings: DataFrame | None = None,
    sentiment: DataFrame | None = None,
    tables: str | None = None,
    trees: int = 250,
    horizon: int = 14,
    holdout_days: int = 28,
    fail_on_error: bool = False,
    max_rows: int | None = None,
) -> RunResult:
    """Curate, gate, train, backtest, detect and sync under one session.

    ``tables`` is the database for the warehouse copy; without it none is made.
    A failed sync does not lose the run: its message is part of the result.
    """
    spark = sales.sparkSession
    curated = stage_curated(curate(sales, readings, sentiment))
    quality = quality_gate(curated, fail_on_error)
    forecasts, validation = train_and_forecast(curated, horizon, trees, max_rows=max_rows)
    forecasts = stage(forecasts, "forecasts")
    scores = backtest(curated, holdout_days, trees, max_rows=max_rows)
    anomalies = stage(detect_anomalies(curated), "anomalies")
    warning = None
    if tables is not None:
        try:
            sync_warehouse(spark, warehouse_tables(curated, forecasts, anomalies), tables)
        except Exception as error:  # noqa: BLE001 - reported to the caller
            warning = str(error)
    return RunResult(
        curated, quality, forecasts, anomalies, scores, dataset_profile(curated), validation, warning
    )


def warehouse_tables(
    curated: DataFrame | None, forecasts: DataFrame | None, anomalies: DataFrame | None
) -> Mapping[str, DataFrame | None]:
    return {
        "curated_sales_daily": curated,
        "predictions_forecast": forecasts,
        "predictions_anomaly": anomalies,
    }


def run_upload(raw: DataFrame, **options) -> RunResult:
    """An export of unknown layout: normalise, check its history, run."""
    sales = require_history(normalize_export(raw))
    return run_pipeline(sales.select("store_id", "sku", "ts", "qty_sold", "price", "channel"), **options)


def refresh(
    spark: SparkSession, sales: DataFrame, readings: DataFrame | None, zone: str,
    database: str | None = None, sentiment: DataFrame | None = None, transform: bool = True,
) -> DataFrame:
    """Land the raw rows, rebuild curated and sync it: one row of counts.

    The sources are evaluated once, by the writes, which also count them;
    curated is made from what has landed.
    """
    raw = {"sales_events": sales} | ({} if readings is None else {"iot_events": readings})
    landed, read = {}, {}
    for name, df in raw.items():
        path = f"{zone}/raw/{name}"
        if name == "sales_events":
            landed[name] = land_sales(df, path, "parquet")
        else:
            landed[name] = counted_by_date(with_event_date(df), path)
        read[name] = spark.read.schema(df.schema).parquet(path)
    counts = {
        "sales_records_ingested": landed["sales_events"],
        "iot_records_ingested": landed.get("iot_events", 0),
    }
    if transform:
        curated = stage_curated(curate(read["sales_events"], read.get("iot_events"), sentiment))
        synced = sync_warehouse(spark, {"curated_sales_daily": curated}, database)
        counts["curated_records"] = synced["curated_sales_daily"]
    return spark.range(1).select(
        F.lit("completed").alias("status"),
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()],
    )
