"""Additive seasonal baseline per series, and its mean fallbacks."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.functions.numeric import at_least_zero, interval_bounds, round_even
from aislecast.operators.curate import SERIES

SEASON = 7
MIN_HISTORY = 14
FALLBACK_SIGMA = 2.5

# Search grid of the smoothing weights: level, trend, season.
GRID = np.array(list(itertools.product((0.05, 0.1, 0.2, 0.4, 0.7), (0.0, 0.01, 0.1), (0.05, 0.1, 0.3))))


def ordered_series(df: DataFrame) -> DataFrame:
    """Each series as one array in day order: one value per calendar day."""
    points = F.array_sort(F.collect_list(F.struct("date", "qty_sold")))
    return df.groupBy(*SERIES).agg(
        F.transform(points, lambda p: p["qty_sold"].cast("double")).alias("series"),
        F.max("date").alias("last_date"),
    )


def _smooth(series: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts and residual deviations of equally long series.

    All series and all grid points advance together, one step per day; the
    grid point with the smallest squared error wins, the first on ties.
    """
    alpha, beta, gamma = (GRID[:, i][None, :] for i in range(3))
    count, length = series.shape
    first = series[:, :SEASON].mean(axis=1)
    second = series[:, SEASON : 2 * SEASON].mean(axis=1)
    level = np.repeat(first[:, None], len(GRID), axis=1)
    trend = np.repeat(((second - first) / SEASON)[:, None], len(GRID), axis=1)
    season = np.repeat((series[:, :SEASON] - first[:, None])[:, :, None], len(GRID), axis=2)
    total = np.zeros_like(level)
    squares = np.zeros_like(level)
    for day in range(length):
        value = series[:, day][:, None]
        slot = day % SEASON
        expected = level + trend + season[:, slot]
        error = value - expected
        total += error
        squares += error * error
        old = level
        level = alpha * (value - season[:, slot]) + (1 - alpha) * (level + trend)
        trend = beta * (level - old) + (1 - beta) * trend
        season[:, slot] = gamma * (value - level) + (1 - gamma) * season[:, slot]
    best = np.argmin(np.where(np.isfinite(squares), squares, np.inf), axis=1)
    pick = (np.arange(count), best)
    ahead = np.arange(1, horizon + 1)
    slots = (length + ahead - 1) % SEASON
    path = level[pick][:, None] + trend[pick][:, None] * ahead + season[:, :, :][pick[0], :, best][:, slots]
    sigma = np.sqrt(np.maximum(squares[pick] / length - (total[pick] / length) ** 2, 0.0))
    return np.maximum(path, 0.0), sigma


def _fit_batches(horizon: int):
    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["series"].map(len)
            for length, rows in batch.groupby(lengths, sort=False):
                values = np.stack(rows["series"].to_numpy()).astype(float)
                if length < MIN_HISTORY:
                    mean = np.maximum(values.mean(axis=1), 0.0)
                    path = np.repeat(mean[:, None], horizon, axis=1)
                    sigma = np.full(len(rows), FALLBACK_SIGMA)
                else:
                    path, sigma = _smooth(values, horizon)
                    bad = ~np.isfinite(path).all(axis=1)
                    path[bad] = np.maximum(values[bad, -SEASON:].mean(axis=1), 0.0)[:, None]
                    sigma[bad] = FALLBACK_SIGMA
                out = rows[[*SERIES, "last_date"]].copy()
                out["path"] = list(path)
                out["sigma"] = sigma
                yield out

    return fit


def smoothed_paths(curated: DataFrame, horizon: int, short: str = "skip") -> DataFrame:
    """Unrounded daily baseline and residual deviation per series.

    ``short`` says what happens to series below two weeks: ``skip`` them, or
    forecast their overall ``mean``.
    """
    series = ordered_series(curated)
    if short == "skip":
        series = series.filter(F.size("series") >= MIN_HISTORY)
    fitted = series.mapInPandas(
        _fit_batches(horizon),
        "store_id string, sku string, last_date date, path array<double>, sigma double",
    )
    return fitted.select(*SERIES, "last_date", "sigma", F.posexplode("path").alias("_i", "yhat")).select(
        *SERIES, F.date_add("last_date", F.col("_i") + 1).alias("date"), "yhat", "sigma"
    )


def _as_forecast(paths: DataFrame, version: str) -> DataFrame:
    qty = round_even(F.col("yhat"), 1)
    lower, upper = interval_bounds(F.col("forecast_qty"), F.col("sigma"))
    return paths.withColumn("forecast_qty", qty).select(
        *SERIES, "date", "forecast_qty", lower.alias("lower_ci"), upper.alias("upper_ci"),
        F.lit(version).alias("model_version"),
    )


def baseline_forecast(curated: DataFrame, horizon: int = 14) -> DataFrame:
    """Seasonal baseline with intervals; series below two weeks are skipped."""
    return _as_forecast(smoothed_paths(curated, horizon), "baseline_seasonality_v1")


def _flat(sums: DataFrame, value: Column, horizon: int) -> DataFrame:
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_step")
    return sums.select(*SERIES, "last_date", at_least_zero(value).alias("yhat"), steps).select(
        *SERIES, F.expr("date_add(last_date, _step)").alias("date"), "yhat",
        F.lit(FALLBACK_SIGMA).alias("sigma"),
    )


def mean_forecast(curated: DataFrame, horizon: int = 14, tail: int = SEASON) -> DataFrame:
    """The fallback baseline: the mean of the last week, for every day ahead."""
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    recent = (
        curated.select(*SERIES, "date", "qty_sold")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= tail)
        .groupBy(*SERIES)
        .agg(F.avg("qty_sold").alias("_mean"), F.max("date").alias("last_date"))
    )
    return _as_forecast(_flat(recent, F.col("_mean"), horizon), "baseline_mean_v1")


def short_history_forecast(curated: DataFrame, horizon: int = 28) -> DataFrame:
    """The fallback for series below two weeks: their overall mean."""
    short = (
        curated.groupBy(*SERIES)
        .agg(
            F.avg("qty_sold").alias("_mean"),
            F.max("date").alias("last_date"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter(F.col("_n") < MIN_HISTORY)
    )
    return _flat(short, F.col("_mean"), horizon)


def residual_sigma(df: DataFrame, actual: str, fitted: str) -> DataFrame:
    """Population deviation of the residuals per series."""
    return df.groupBy(*SERIES).agg(F.stddev_pop(F.col(actual) - F.col(fitted)).alias("sigma"))
