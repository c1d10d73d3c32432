"""Boosted-tree demand model and its recursive multi-day forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislecast.functions.dates import is_weekend, weekday
from aislecast.functions.numeric import at_least_zero, interval_bounds, round_even
from aislecast.operators.curate import KEYS, SERIES
from aislecast.operators.features import (
    LAGS,
    WINDOWS,
    complete_rows,
    latest_rows,
    recent_history,
    split_by_position,
    split_holdout,
)
from aislecast.session import shared_dir, stage

HISTORY = 28
# Steps of the recursion between two stage tables.
STAGE_EVERY = 7


def _assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="_features").transform(df)


def train_demand_model(
    rows: DataFrame,
    columns: Sequence[str],
    trees: int = 250,
    step: float = 0.04,
    depth: int = 5,
    row_share: float = 0.85,
    column_share: float = 0.85,
    seed: int = 42,
    path: str | None = None,
    max_rows: int | None = None,
) -> GBTRegressionModel:
    """Fit on rows that have every feature; saved if a path is given.

    With ``max_rows`` about so many rows are drawn by a hash of store, product
    and day, so reruns fit the same rows.
    """
    shared_dir(rows.sparkSession)
    if max_rows is not None:
        share = min(1.0, max_rows / max(1, rows.count()))
        draw = F.pmod(F.xxhash64(*KEYS), F.lit(1 << 20))
        # few partitions: every level of every tree is a job over all of them
        rows = rows.filter(draw < int(share * (1 << 20))).repartition(max(1, -(-max_rows // 10_000)))
    model = GBTRegressor(
        featuresCol="_features",
        labelCol="_label",
        maxIter=trees,
        stepSize=step,
        maxDepth=depth,
        subsamplingRate=row_share,
        featureSubsetStrategy=str(column_share),
        seed=seed,
        checkpointInterval=25,
    ).fit(
        _assembled(rows, columns).select(
            "_features", F.col("qty_sold").cast("double").alias("_label")
        )
    )
    if path:
        model.write().overwrite().save(path)
    return model


def predict(
    model: GBTRegressionModel, rows: DataFrame, columns: Sequence[str], out: str = "prediction"
) -> DataFrame:
    """Predictions, never below zero. The model is a plain task closure."""
    scored = model.setPredictionCol("_raw").transform(_assembled(rows, columns))
    return scored.withColumn(out, at_least_zero(F.col("_raw"))).drop("_raw", "_features")


def training_split(
    features: DataFrame, columns: Sequence[str], days: int = 28, min_rows: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Time split of the complete rows; by position if nothing lies before it."""
    rows = complete_rows(features, columns, min_rows)
    train, valid = split_holdout(rows, days)
    return (train, valid) if not train.isEmpty() else split_by_position(rows)


def _tail_mean(window: int) -> Column:
    tail = F.slice("history", -window, window)
    return F.aggregate(tail, F.lit(0.0), lambda acc, x: acc + x) / window


def _tail_std(window: int) -> Column:
    """Population deviation, as the forecast step uses it."""
    tail = F.slice("history", -window, window)
    mean = F.col(f"rolling_mean_{window}")
    squares = F.aggregate(tail, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))
    return F.sqrt(squares / window)


def with_history_features(state: DataFrame, date: Column) -> DataFrame:
    """The feature row of the next day, from the last quantities alone."""
    return (
        state.withColumns(
            {
                "dayofweek": weekday(date),
                "is_weekend": is_weekend(date),
                "month": F.month(date),
                "day": F.dayofmonth(date),
                **{f"qty_lag_{k}": F.element_at("history", -k) for k in LAGS},
                **{f"rolling_mean_{w}": _tail_mean(w) for w in WINDOWS},
            }
        ).withColumns({f"rolling_std_{w}": _tail_std(w) for w in WINDOWS})
    )


def forecast_state(features: DataFrame, graph: Sequence[str] = ()) -> DataFrame:
    """One row per series: what stays fixed, and the last quantities."""
    fixed = ["store_encoded", "sku_encoded", "avg_shelf_qty", "sentiment_score", *graph]
    last_day = features.agg(F.max("date").alias("d")).scalar()
    return (
        latest_rows(features.select(*SERIES, "date", *fixed))
        .select(*SERIES, *fixed, last_day.alias("_last_day"))
        .join(recent_history(features.select(*SERIES, "date", "qty_sold"), HISTORY), SERIES)
    )


def recursive_forecast(
    model: GBTRegressionModel,
    features: DataFrame,
    columns: Sequence[str],
    sigma: float,
    horizon: int = 14,
    version: str = "boosted_trees_v1",
) -> DataFrame:
    """Day by day: each forecast becomes the newest lag of the next day.

    The state is one row per series and every step is narrow. The plan is cut
    at a stage table every few steps, so it does not grow with the horizon.
    """
    graph = [c for c in columns if c.startswith("graph_")]
    state = stage(forecast_state(features, graph), "forecast-state")
    keep = [*state.columns]
    made: list[str] = []
    for step in range(1, horizon + 1):
        date = F.date_add("_last_day", step)
        rows = predict(model, with_history_features(state, date), columns, "_next")
        name = f"_day_{step}"
        made.append(name)
        state = (
            rows.withColumn(name, at_least_zero(round_even(F.col("_next"), 1)))
            .withColumn("history", F.concat(F.slice("history", 2, HISTORY - 1), F.array(name)))
            .select(*keep, *made)
        )
        if step % STAGE_EVERY == 0 and step < horizon:
            state = stage(state, "forecast-state")
    days = F.array(
        *[
            F.struct(F.date_add("_last_day", i).alias("date"), F.col(c).alias("qty"))
            for i, c in enumerate(made, 1)
        ]
    )
    lower, upper = interval_bounds(F.col("forecast_qty"), F.lit(sigma))
    return (
        state.select(*SERIES, F.explode(days).alias("_f"))
        .select(*SERIES, F.col("_f.date"), F.col("_f.qty").alias("forecast_qty"))
        .withColumns({"lower_ci": lower, "upper_ci": upper, "model_version": F.lit(version)})
    )


class UnknownSeries(LookupError):
    """No forecast exists for a store and product."""


def serve_forecast(
    forecasts: DataFrame, store_id: str, sku: str, horizon: int = 14, must_exist: bool = False
) -> DataFrame:
    """The first days of one series. Shorter forecasts return what exists;
    none at all is an error on request."""
    if not 1 <= horizon <= 30:
        raise ValueError("horizon must lie in 1..30")
    days = (
        forecasts.filter((F.col("store_id") == store_id) & (F.col("sku") == sku))
        .orderBy("date")
        .limit(horizon)
    )
    if must_exist and days.isEmpty():
        raise UnknownSeries(f"{store_id} / {sku}")
    return days


def first_available(*tables: DataFrame | None) -> DataFrame:
    """The first forecast table that exists."""
    for table in tables:
        if table is not None:
            return table
    raise LookupError("no forecasts have been made yet")


def latest_forecast(forecasts: DataFrame) -> DataFrame:
    """The furthest forecast day of each series."""
    return latest_rows(forecasts)
