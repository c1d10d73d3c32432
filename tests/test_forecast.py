import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislecast.operators import baseline, evaluate, features, forecast
from aislecast.plans.pipeline import train_and_forecast
from tests import frames

SERIES = ["store_id", "sku"]


@pytest.fixture(scope="module")
def curated(spark):
    return frames.to_spark(spark, frames.random_curated(7, days=90), frames.CURATED_DDL).cache()


def smooth_by_hand(series, horizon):
    """The seasonal baseline for one series and one weight set at a time."""
    best = None
    for alpha, beta, gamma in itertools.product((0.05, 0.1, 0.2, 0.4, 0.7), (0.0, 0.01, 0.1), (0.05, 0.1, 0.3)):
        level = np.mean(series[:7])
        trend = (np.mean(series[7:14]) - level) / 7
        season = [x - level for x in series[:7]]
        errors = []
        for i, x in enumerate(series):
            errors.append(x - (level + trend + season[i % 7]))
            old = level
            level = alpha * (x - season[i % 7]) + (1 - alpha) * (level + trend)
            trend = beta * (level - old) + (1 - beta) * trend
            season[i % 7] = gamma * (x - level) + (1 - gamma) * season[i % 7]
        sse = sum(e * e for e in errors)
        if best is None or sse < best[0] * (1 - 1e-12):
            n = len(series)
            path = [max(0.0, level + trend * h + season[(n + h - 1) % 7]) for h in range(1, horizon + 1)]
            best = (sse, path, np.std(errors))
    return best[1], best[2]


def test_baseline_equals_smoothing_by_hand(spark):
    data = frames.random_curated(3, days=45, stores=1, skus=3)
    # One series is shorter than the others.
    data = data[~((data["sku"] == "SKU_003") & (data["date"] < dt.date(2025, 1, 11)))]
    df = frames.to_spark(spark, data, frames.CURATED_DDL)
    got = baseline.smoothed_paths(df, 10).toPandas().sort_values([*SERIES, "date"])
    for sku, rows in got.groupby("sku"):
        path, sigma = smooth_by_hand(list(data[data["sku"] == sku]["qty_sold"]), 10)
        np.testing.assert_allclose(rows["yhat"], path, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(rows["sigma"], sigma, rtol=1e-9)
        assert list(rows["date"])[0] == dt.date(2025, 2, 15)


def test_baseline_beats_the_mean_on_a_weekly_pattern(curated):
    train, test = features.split_holdout(curated, 14)
    paths = baseline.smoothed_paths(train, 14).withColumnRenamed("yhat", "p")
    mean = train.groupBy(*SERIES).agg(F.avg("qty_sold").alias("m"))
    joined = test.join(paths, [*SERIES, "date"]).join(mean, SERIES)
    row = evaluate.error_metrics(joined, "qty_sold", {"hw": "p", "mean": "m"}).first()
    assert row["hw_rmse"] < row["mean_rmse"]


def test_short_series(spark):
    df = frames.to_spark(spark, frames.random_curated(3, days=10, stores=1, skus=2), frames.CURATED_DDL)
    assert baseline.baseline_forecast(df).count() == 0
    by_mean = baseline.smoothed_paths(df, 5, short="mean").select(*SERIES, "date", "yhat", "sigma")
    direct = baseline.short_history_forecast(df, 5)
    assert sorted(map(tuple, by_mean.collect())) == sorted(map(tuple, direct.collect()))


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 0.0), ("a", 2, 1.0, 2.0), ("b", 0, 3.0, 4.0)], "sku string, y long, p double, q double")
    row = evaluate.error_metrics(df, "y", {"p": "p"}).first()
    assert row["p_mae"] == pytest.approx(5 / 3) and row["p_rmse"] == pytest.approx((11 / 3) ** 0.5)
    assert row["p_mape"] == pytest.approx(50.0)
    board = {r["sku"]: r for r in evaluate.sku_scoreboard(df, "y", "p", "q").collect()}
    assert board["a"]["winner"] == "champion"
    assert board["b"]["baseline_mape"] == 0.0 and board["b"]["winner"] == "champion"


def test_constant_predictions_when_nothing_matches(spark):
    day = dt.date(2025, 1, 1)
    test = spark.createDataFrame([("S", "K", day, 5)], "store_id string, sku string, date date, qty_sold long")
    none = spark.createDataFrame([], "store_id string, sku string, date date, baseline_pred double")
    row = evaluate.match_or_default(test, none, none.withColumnRenamed("baseline_pred", "champion_pred")).first()
    assert row["baseline_pred"] == row["champion_pred"] == 10.0


def test_history_features_equal_numpy(spark):
    history = [float(x) for x in np.random.default_rng(1).integers(0, 30, 28)]
    state = spark.createDataFrame([("S", "K", history)], "store_id string, sku string, history array<double>")
    row = forecast.with_history_features(state, F.lit("2025-03-08").cast("date")).first()
    assert (row["dayofweek"], row["is_weekend"], row["month"], row["day"]) == (5, 1, 3, 8)
    for k in features.LAGS:
        assert row[f"qty_lag_{k}"] == history[-k]
    for w in features.WINDOWS:
        assert row[f"rolling_mean_{w}"] == pytest.approx(np.mean(history[-w:]))
        assert row[f"rolling_std_{w}"] == pytest.approx(np.std(history[-w:]))


@pytest.fixture(scope="module")
def trained(curated):
    feats = features.build_features(curated).cache()
    columns = features.feature_columns(feats)
    train, _ = forecast.training_split(feats, columns)
    return forecast.train_demand_model(train, columns, trees=8), feats, columns


def test_recursive_forecast_feeds_itself(spark, trained):
    model, feats, columns = trained
    got = forecast.recursive_forecast(model, feats, columns, sigma=2.0, horizon=9).toPandas()
    assert len(got) == 6 * 9 and (got["lower_ci"] >= 0).all() and (got["forecast_qty"] >= 0).all()
    assert got["date"].min() == dt.date(2025, 4, 1)
    again = forecast.recursive_forecast(model, feats, columns, sigma=2.0, horizon=9).toPandas()
    order = [*SERIES, "date"]
    assert got.sort_values(order).reset_index(drop=True).equals(again.sort_values(order).reset_index(drop=True))
    # Redo one series step by step on the driver.
    one = feats.filter("store_id = 'STORE_001' and sku = 'SKU_002'")
    last = one.orderBy(F.desc("date")).first()
    history = [float(r["qty_sold"]) for r in one.orderBy("date").collect()]
    want = got[(got["store_id"] == "STORE_001") & (got["sku"] == "SKU_002")].sort_values("date")
    for step, expected in enumerate(want["forecast_qty"], 1):
        day = last["date"] + dt.timedelta(days=step)
        row = {
            "store_encoded": last["store_encoded"], "sku_encoded": last["sku_encoded"],
            "dayofweek": day.weekday(), "is_weekend": int(day.weekday() >= 5), "month": day.month, "day": day.day,
            "avg_shelf_qty": last["avg_shelf_qty"], "sentiment_score": last["sentiment_score"],
            **{f"qty_lag_{k}": history[-k] for k in features.LAGS},
            **{f"rolling_mean_{w}": float(np.mean(history[-w:])) for w in features.WINDOWS},
            **{f"rolling_std_{w}": float(np.std(history[-w:])) for w in features.WINDOWS},
        }
        from pyspark.ml.linalg import Vectors

        value = max(0.0, round(max(0.0, model.predict(Vectors.dense([float(row[c]) for c in columns]))), 1))
        assert value == pytest.approx(expected, abs=0.1000001)
        history.append(expected)


def test_train_and_serve(curated):
    forecasts, validation = train_and_forecast(curated, horizon=5, trees=4)
    errors = validation.first()
    assert errors["validation_rmse"] > 0 and forecasts.count() == 6 * 5
    served = forecast.serve_forecast(forecasts, "STORE_001", "SKU_001", 30).collect()
    assert len(served) == 5 and [r["date"] for r in served] == sorted(r["date"] for r in served)
    with pytest.raises(ValueError):
        forecast.serve_forecast(forecasts, "STORE_001", "SKU_001", 31)
    with pytest.raises(forecast.UnknownSeries):
        forecast.serve_forecast(forecasts, "STORE_001", "none", must_exist=True)
    assert forecast.latest_forecast(forecasts).count() == 6
    with pytest.raises(LookupError):
        forecast.first_available(None, None)


@pytest.mark.parametrize("recursive", [False, True])
def test_backtest(curated, recursive):
    result = evaluate.backtest(curated, holdout_days=14, trees=4, recursive=recursive)
    assert result.matched.count() == 6 * 14
    row = result.overall.first()
    assert row["champion_rmse"] > 0 and row["baseline_rmse"] > 0
    assert {r["winner"] for r in result.by_sku.collect()} <= {"champion", "baseline"}


def test_backtest_features_do_not_see_the_holdout_when_recursive(spark):
    data = frames.random_curated(7, days=70, stores=1, skus=2)
    changed = data.copy()
    late = changed["date"] > dt.date(2025, 1, 1) + dt.timedelta(days=70 - 1 - 10)
    changed.loc[late, "qty_sold"] = 999

    def predictions(frame):
        df = frames.to_spark(spark, frame, frames.CURATED_DDL)
        result = evaluate.backtest(df, holdout_days=10, trees=3, recursive=True)
        return sorted(map(tuple, result.matched.select(*SERIES, "date", "baseline_pred", "champion_pred").collect()))

    assert predictions(data) == predictions(changed)
