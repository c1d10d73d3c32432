import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislecast.contracts import CURATED, SALES, ContractError, require_columns
from aislecast.operators import drift, normalize, quality
from aislecast.operators.curate import with_default_flags
from tests import frames


def ks_by_hand(a, b):
    points = np.sort(np.concatenate([a, b]))
    cdf = lambda x: np.searchsorted(np.sort(x), points, side="right") / len(x)
    return np.abs(cdf(a) - cdf(b)).max()


@pytest.mark.parametrize("cuts", [0, 3, 255])
def test_gap_equals_brute_force_for_any_cut_points(spark, cuts):
    rng = np.random.default_rng(4)
    ref = np.column_stack([rng.normal(0, 1, 500), rng.integers(0, 3, 500)])
    cur = np.column_stack([rng.normal(0.4, 1, 120), rng.integers(0, 3, 120)])
    to_df = lambda x: spark.createDataFrame([(float(a), float(b)) for a, b in x], "x double, k double")
    counts = drift.value_counts(to_df(ref), to_df(cur), ["x", "k"])
    points = drift.cut_points(to_df(ref), ["x", "k"], cuts) if cuts else {"x": [], "k": []}
    got = {r["feature"]: r for r in drift.largest_gap(counts, points).collect()}
    for i, name in enumerate(["x", "k"]):
        assert got[name]["statistic"] == pytest.approx(ks_by_hand(ref[:, i], cur[:, i]))
        assert (got[name]["ref_rows"], got[name]["cur_rows"]) == (500, 120)


def test_points_below(spark):
    points = sorted({float(x) for x in np.random.default_rng(1).integers(0, 500, 90)})
    values = [-1.0, 0.0, *points, 250.5, 999.0]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    got = [r[0] for r in df.select(drift.points_below(points)).collect()]
    assert got == [sum(p < v for p in points) for v in values]


def test_p_values(spark):
    df = spark.createDataFrame([(0.0, 100, 100), (1.0, 100, 100), (0.05, 1000, 1000), (0.15, 100, 100)], "d double, a long, b long")
    got = [r[0] for r in df.select(drift.p_value(F.col("d"), F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and got[1] < 1e-20
    assert got[2] == pytest.approx(0.1643, abs=0.01) and 0.15 < got[3] < 0.25


@pytest.mark.parametrize("moved, verdict", [(0, "PASS"), (1, "PASS"), (2, "WARN"), (3, "FAIL")])
def test_verdict_limits(spark, moved, verdict):
    rows = [(f"f{i}", i < moved) for i in range(5)]
    got = drift.drift_summary(spark.createDataFrame(rows, "feature string, drifted boolean")).first()
    assert got["verdict"] == verdict and got["share_of_drifted_columns"] == pytest.approx(moved / 5)


def test_shifted_feature_is_found_and_missing_values_are_ignored(spark):
    data = frames.random_curated(5, days=100)
    late = data["date"] > dt.date(2025, 1, 1) + dt.timedelta(days=71)
    data.loc[late, "revenue"] += 30
    df = frames.to_spark(spark, data, frames.CURATED_DDL).withColumn(
        "avg_shelf_qty", F.when(F.col("sku") != "SKU_001", F.col("avg_shelf_qty"))
    )
    got = {r["feature"]: r for r in drift.drift_report(df).collect()}
    assert got["revenue"]["drifted"] and not got["sentiment_score"]["drifted"]
    assert got["avg_shelf_qty"]["ref_rows"] == 72 * 4


@pytest.fixture
def curated(spark):
    df = frames.to_spark(spark, frames.random_curated(2, days=10), frames.CURATED_DDL)
    return with_default_flags(df)


def test_gate_passes(curated):
    report = quality.quality_gate(curated, fail_on_error=True)
    assert quality.quality_verdict(report).first()["passed"]


def test_gate_reports_each_kind_of_failure(curated):
    bad = (
        curated.drop("sentiment_score")
        .withColumn("revenue", F.when(F.col("sku") == "SKU_001", -1.0).otherwise(F.col("revenue")))
        .withColumn("avg_price", F.when(F.col("sku") != "SKU_001", F.col("avg_price")))
    )
    verdict = quality.quality_verdict(quality.quality_gate(bad)).first()
    assert verdict["violations"] == [
        "non_negative_bounds:revenue", "null_rate_tolerance:avg_price", "schema_completeness:sentiment_score",
    ]
    with pytest.raises(ContractError):
        quality.quality_gate(bad, fail_on_error=True)
    empty = quality.quality_verdict(quality.quality_gate(curated.limit(0))).first()
    assert empty["violations"] == ["min_record_threshold:*"]
    text = quality.as_json(quality.quality_report(curated)).first()["json"]
    assert '"passed":true' in text


def test_wrong_types_count_when_failing_on_errors(curated):
    with pytest.raises(ContractError):
        quality.quality_gate(curated.withColumn("qty_sold", F.col("qty_sold").cast("string")), fail_on_error=True)
    assert len(CURATED) == 9


def test_contract_lists_what_is_missing(spark):
    with pytest.raises(ContractError, match="channel"):
        require_columns(spark.createDataFrame([], SALES).drop("channel"), SALES, "sales")


def test_roles():
    got = normalize.infer_roles(["Order Date", "Item Description", "Quantity", "Unit Rate", "Outlet"])
    assert got == {"date": "Order Date", "sku": "Item Description", "qty": "Quantity", "price": "Unit Rate", "revenue": None, "store": "Outlet"}
    assert normalize.infer_roles(["a", "b", "c"])["sku"] == "b"
    assert normalize.infer_roles(["a", "b"])["qty"] == "a"
    wide = ["date", "store_id", "sku", "qty_sold", "price_inr", "revenue_inr", "shelf_sensor_stock", "customer_sentiment"]
    got = normalize.infer_roles(wide)
    assert (got["price"], got["revenue"], got["store"]) == ("price_inr", "revenue_inr", "store_id")


def test_coercion(spark):
    raw = spark.createDataFrame(
        [("2025-01-01", "A", "3", "x", "S"), ("bad", "A", "1", "1", "S"), ("2025-01-02", None, "1", "1", "S"), ("2025-01-03", "B", "?", "2.5", "S"), ("2025-01-04", "B", "2.9", "2", "S")],
        "`Order Date` string, Item string, Units string, Rate string, Branch string",
    )
    got = [tuple(r) for r in normalize.normalize_export(raw).orderBy("date").select("sku", "qty_sold", "price", "revenue", "store_id", "channel").collect()]
    assert got == [("A", 3, 150.0, 450.0, "S", "in_store"), ("B", 0, 2.5, 0.0, "S", "in_store"), ("B", 2, 2.0, 4.0, "S", "in_store")]
    bare = normalize.normalize_export(raw.drop("Rate", "Branch")).first()
    assert bare["price"] == 185.0 and bare["store_id"] == "STORE_001"
    stated = raw.withColumn("Turnover", F.when(F.col("Units") == "3", "77").otherwise("no"))
    assert normalize.normalize_export(stated).filter("sku = 'A'").first()["revenue"] == 77.0


def test_history_gate(spark):
    df = frames.to_spark(spark, frames.random_curated(2, days=34, stores=1, skus=1), frames.CURATED_DDL)
    assert not normalize.history_verdict(df).first()["accepted"]
    with pytest.raises(normalize.HistoryTooShort):
        normalize.require_history(df)
    longer = frames.to_spark(spark, frames.random_curated(2, days=35, stores=1, skus=1), frames.CURATED_DDL)
    assert normalize.require_history(longer) is longer
