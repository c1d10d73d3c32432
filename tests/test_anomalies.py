import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislecast.operators import anomalies as an
from tests import frames

SERIES = ["store_id", "sku"]


def flat_series(spark, last_qty, last_shelf, days=20, base=(5, 6)):
    rows = [
        ("S", "K", dt.date(2025, 1, 1) + dt.timedelta(days=i), base[i % 2], 1.0, 1.0, 20.0, 0.0)
        for i in range(days - 1)
    ]
    rows.append(("S", "K", dt.date(2025, 1, 1) + dt.timedelta(days=days - 1), last_qty, 1.0, 1.0, last_shelf, 0.0))
    return spark.createDataFrame(rows, frames.CURATED_DDL)


@pytest.mark.parametrize(
    "qty, shelf, kind, severity",
    [
        (5, 0.0, "stockout_risk", "high"),
        (50, 2.0, "stockout_risk", "medium"),
        (15, 20.0, "demand_spike", "high"),
        (50, 40.0, "demand_spike", "high"),
        (14, 20.0, None, None),
    ],
)
def test_first_rule_that_fits(spark, qty, shelf, kind, severity):
    found = an.flag_anomalies(flat_series(spark, qty, shelf)).collect()
    if kind is None:
        assert found == []
    else:
        assert [(r["anomaly_type"], r["severity"]) for r in found] == [(kind, severity)]


def test_mismatch_needs_sales_and_shelf_without_a_spike(spark):
    found = an.flag_anomalies(flat_series(spark, 22, 40.0, base=(5, 35))).orderBy("date").collect()
    last = found[-1]
    assert (last["anomaly_type"], last["severity"], last["score"]) == ("sensor_mismatch", "low", 0.55)


def test_scores_equal_pandas(spark):
    curated = frames.random_curated(21)
    got = (
        an.with_demand_scores(frames.to_spark(spark, curated, frames.CURATED_DDL))
        .toPandas().sort_values([*SERIES, "date"])
    )
    by = curated.sort_values([*SERIES, "date"]).groupby(SERIES)["qty_sold"]
    mean = by.transform(lambda s: s.shift(1).rolling(14, min_periods=3).mean()).fillna(curated["qty_sold"].mean())
    std = by.transform(lambda s: s.shift(1).rolling(14, min_periods=3).std()).fillna(1.0).replace(0, 1.0)
    np.testing.assert_allclose(got["rolling_mean"], mean)
    np.testing.assert_allclose(got["rolling_std"], std)


@pytest.fixture(scope="module")
def found(spark):
    curated = frames.to_spark(spark, frames.random_curated(5, days=90), frames.CURATED_DDL)
    return an.detect_anomalies(curated).cache()


def test_ids_count_in_order(found):
    rows = found.orderBy(*SERIES, "date").collect()
    assert len(rows) > 20
    assert [r["id"] for r in rows] == [f"ANOM_{i:04d}" for i in range(1, len(rows) + 1)]


def test_listing(found):
    totals, page = an.list_anomalies(found, limit=7, severity="HIGH")
    assert totals.first()["total"] == found.count()
    rows = page.collect()
    assert len(rows) == 7 and {r["severity"] for r in rows} == {"high"}
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)
    with pytest.raises(ValueError):
        an.list_anomalies(found, limit=0)


def test_acknowledging(spark, found):
    ids = [r["id"] for r in found.limit(3).collect()]
    acks = spark.createDataFrame([(i,) for i in ids + ids[:1]], "id string")
    state = an.acknowledge(found, acks)
    assert state.count() == found.count()
    assert an.anomaly_totals(state).first()["acknowledged_count"] == 3
    assert an.filter_anomalies(state, status="acknowledged").count() == 3
    with pytest.raises(an.UnknownAnomaly):
        an.acknowledge(found, spark.createDataFrame([("ANOM_x",)], "id string"))


def test_stats_add_up(found):
    row = an.anomaly_stats(found).first()
    assert sum(row["by_type"].values()) == row["total"] == sum(row["by_severity"].values())


def test_recall_and_precision(spark, found):
    hit = found.filter("anomaly_type = 'stockout_risk'").first()
    truth = spark.createDataFrame(
        [
            (hit["store_id"], hit["sku"], hit["date"], hit["date"], "stockout_risk"),
            ("nowhere", "SKU_001", hit["date"], hit["date"], "stockout_risk"),
        ],
        "store_id string, sku string, start_date date, end_date date, type string",
    )
    assert an.scenario_recall(found, truth).first().asDict() == {"scenarios": 2, "found": 1, "recall_pct": 50.0}
    precision = an.detection_precision(found, truth).first()
    assert precision["true_detections"] == 1
    assert precision["detections"] == found.filter("anomaly_type = 'stockout_risk'").count()
    assert an.scenario_recall(found, truth.limit(0)).first()["recall_pct"] == 100.0


def test_known_window_flag_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("S", "K", dt.date(2025, 1, d)) for d in range(1, 10)], "store_id string, sku string, date date")
    windows = spark.createDataFrame(
        [("S", "K", dt.date(2025, 1, 2), dt.date(2025, 1, 4)), ("S", "K", dt.date(2025, 1, 3), dt.date(2025, 1, 6))],
        "store_id string, sku string, start_date date, end_date date",
    )
    rows = an.in_known_window(df, windows).collect()
    assert len(rows) == 9 and sum(r["in_window"] for r in rows) == 5


def stockouts(spark, rows):
    df = spark.createDataFrame(
        rows, "store_id string, sku string, date date, avg_shelf_qty double, anomaly_type string, stock_level double"
    )
    return {r["sku"]: r for r in an.active_stockouts(df).collect()}


def test_active_stockouts_use_the_latest_known_values(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    got = stockouts(
        spark,
        [
            ("S", "empty", d1, 9.0, None, None), ("S", "empty", d2, 0.0, None, None),
            ("S", "refilled", d1, 0.0, None, None), ("S", "refilled", d2, 8.0, None, None),
            ("S", "typed", d1, 3.0, " Stockout_Risk ", None), ("S", "typed", d2, 3.0, None, None),
            ("S", "spike", d2, 0.0, "demand_spike", 0.0),
            ("S", "level", d2, 4.0, None, 0.0), ("S", "stocked", d2, 0.0, None, 6.0),
        ],
    )
    assert set(got) == {"empty", "typed", "level"}
    assert got["empty"]["id"] == "STOCKOUT_S_empty_2025-01-02"
    assert got["level"]["shelf_qty"] == 4.0 and got["level"]["stock_level"] == 0.0


def test_optional_columns_may_be_absent(spark):
    df = spark.createDataFrame([("S", "K", dt.date(2025, 1, 1), 0.0)], "store_id string, sku string, date date, avg_shelf_qty double")
    assert an.active_stockouts(df).count() == 1
    assert an.active_stockouts(df.withColumn("avg_shelf_qty", F.lit(1.0))).count() == 0
