import numpy as np
import pandas as pd
import pytest

from aislecast.operators import features, ordering
from tests import frames

SERIES = ["store_id", "sku"]


@pytest.fixture(scope="module")
def curated():
    return frames.random_curated(11)


def test_lags_and_rolling_equal_pandas(spark, curated):
    df = frames.to_spark(spark, curated, frames.CURATED_DDL)
    got = features.build_features(df).toPandas().sort_values([*SERIES, "date"]).reset_index(drop=True)
    want = curated.sort_values([*SERIES, "date"]).reset_index(drop=True)
    by = want.groupby(SERIES)["qty_sold"]
    for k in features.LAGS:
        np.testing.assert_array_equal(got[f"qty_lag_{k}"], by.shift(k))
    for w in features.WINDOWS:
        mean = by.transform(lambda s: s.shift(1).rolling(w, min_periods=1).mean())
        std = by.transform(lambda s: s.shift(1).rolling(w, min_periods=1).std()).fillna(0)
        np.testing.assert_allclose(got[f"rolling_mean_{w}"], mean)
        np.testing.assert_allclose(got[f"rolling_std_{w}"], std, atol=1e-6)
    dates = pd.to_datetime(want["date"])
    np.testing.assert_array_equal(got["dayofweek"], dates.dt.dayofweek)
    np.testing.assert_array_equal(got["is_weekend"], dates.dt.dayofweek >= 5)
    codes = {s: i for i, s in enumerate(sorted(set(want["sku"])))}
    np.testing.assert_array_equal(got["sku_encoded"], want["sku"].map(codes))


def test_position_is_the_global_order(spark, curated):
    df = frames.to_spark(spark, curated, frames.CURATED_DDL)
    got = ordering.global_position(df).toPandas().sort_values("position")
    assert list(got["position"]) == list(range(len(curated)))
    keys = [tuple(r) for r in got[[*SERIES, "date"]].itertuples(index=False)]
    assert keys == sorted(keys)


def test_splits(spark, curated):
    df = frames.to_spark(spark, curated, frames.CURATED_DDL)
    train, test = features.split_holdout(df, 10)
    assert train.count() == 40 * 6 and test.count() == 10 * 6
    head, tail = features.split_by_position(df)
    assert head.count() == 240 and tail.count() == 60
    early, late = features.split_by_date_quantile(df)
    cut = pd.to_datetime(curated["date"]).quantile(0.8)
    assert early.count() == (pd.to_datetime(curated["date"]) <= cut).sum()
    assert early.count() + late.count() == len(curated)


def test_history_is_padded_in_front(spark):
    short = frames.random_curated(3, days=5, stores=1, skus=1)
    df = frames.to_spark(spark, short, frames.CURATED_DDL)
    qty = [float(q) for q in short["qty_sold"]]
    assert features.recent_history(df, 8).first()["history"] == [qty[-1]] * 3 + qty


def test_too_few_complete_rows_are_an_error(spark):
    df = frames.to_spark(spark, frames.random_curated(3, days=20), frames.CURATED_DDL)
    with pytest.raises(ValueError):
        features.complete_rows(features.build_features(df), features.FEATURES, 10)


def test_graph_features_only_on_request(spark):
    df = frames.to_spark(spark, frames.random_curated(3, days=2), frames.CURATED_DDL)
    assert features.feature_columns(df, graph=True) == features.FEATURES
    from pyspark.sql import functions as F

    wide = df.withColumn("graph_co_stock_freq", F.lit(0.5))
    assert features.feature_columns(wide) == features.FEATURES
    assert features.feature_columns(wide, graph=True)[-1] == "graph_co_stock_freq"
