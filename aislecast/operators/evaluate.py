"""Forecast errors and the backtest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislecast.functions.dates import present
from aislecast.operators.baseline import smoothed_paths
from aislecast.operators.curate import KEYS, stage_curated
from aislecast.operators.features import (
    build_features,
    feature_columns,
    split_by_date_quantile,
    split_by_position,
    split_holdout,
)
from aislecast.operators.forecast import predict, recursive_forecast, train_demand_model
from aislecast.session import stage


def error_columns(actual: str, predicted: str) -> dict[str, Column]:
    """MAE, RMSE and MAPE. MAPE looks at days with sales only, 0 without any."""
    a, p = F.col(actual), F.col(predicted)
    error = a - p
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mape": F.coalesce(F.avg(F.when(a > 0, F.abs(error / a))) * 100.0, F.lit(0.0)),
    }


def error_metrics(
    df: DataFrame, actual: str, predictions: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Errors of several predictions side by side, in one pass."""
    columns = [
        col.alias(f"{name}_{metric}")
        for name, predicted in predictions.items()
        for metric, col in error_columns(actual, predicted).items()
    ]
    return df.groupBy(*by).agg(*columns) if by else df.agg(*columns)


def sku_scoreboard(
    df: DataFrame, actual: str = "qty_sold", baseline: str = "baseline_pred",
    champion: str = "champion_pred",
) -> DataFrame:
    """Errors per product and who wins; the champion wins ties."""
    scores = error_metrics(df, actual, {"baseline": baseline, "champion": champion}, ["sku"])
    ahead = F.col("champion_mape") <= F.col("baseline_mape")
    return scores.withColumn("winner", F.when(ahead, "champion").otherwise("baseline"))


def match_predictions(test: DataFrame, baseline: DataFrame, champion: DataFrame) -> DataFrame:
    """Test days that both models predicted."""
    return test.join(baseline.select(*KEYS, "baseline_pred"), KEYS).join(
        champion.select(*KEYS, "champion_pred"), KEYS
    )


def match_or_default(
    test: DataFrame, baseline: DataFrame, champion: DataFrame, default: float = 10.0
) -> DataFrame:
    """As above; if no day matches at all, both predictions are a constant."""
    matched = match_predictions(test, baseline, champion)
    if not matched.isEmpty():
        return matched
    return test.withColumns({"baseline_pred": F.lit(default), "champion_pred": F.lit(default)})


@dataclass(frozen=True)
class Backtest:
    """Result tables of one backtest."""

    matched: DataFrame
    overall: DataFrame
    by_sku: DataFrame


def backtest(
    curated: DataFrame,
    holdout_days: int = 28,
    trees: int = 250,
    recursive: bool = False,
    graph: bool = False,
    max_rows: int | None = None,
) -> Backtest:
    """Baseline against boosted trees on the last days of the history.

    The baseline forecasts the whole window from its start. The trees are
    scored one step ahead with the true lags by default; ``recursive`` feeds
    them their own forecasts instead, which compares like with like.
    """
    train, test = split_holdout(curated, holdout_days)
    if train.isEmpty() or test.isEmpty():
        train, test = split_by_date_quantile(curated)
    baseline = smoothed_paths(train, holdout_days, short="mean").withColumnRenamed(
        "yhat", "baseline_pred"
    )

    columns = feature_columns(curated, graph)
    features = stage_curated(build_features(curated), "backtest-features")
    complete = present(features, *columns)
    split = train.agg(F.max("date").alias("d")).scalar()
    fit_rows, score_rows = (
        complete.filter(F.col("date") <= split),
        complete.filter(F.col("date") > split),
    )
    if fit_rows.isEmpty():
        fit_rows, score_rows = split_by_position(complete)
    model = train_demand_model(fit_rows, columns, trees, max_rows=max_rows)
    if recursive:
        known = features.filter(F.col("date") <= split)
        champion = recursive_forecast(model, known, columns, 0.0, holdout_days).withColumnRenamed(
            "forecast_qty", "champion_pred"
        )
    else:
        champion = predict(model, score_rows, columns, "champion_pred")
    matched = stage(
        match_or_default(test.select(*KEYS, "qty_sold"), baseline, champion), "backtest-matched"
    )
    models = {"baseline": "baseline_pred", "champion": "champion_pred"}
    overall = error_metrics(matched, "qty_sold", models)
    return Backtest(matched, overall, sku_scoreboard(matched))
