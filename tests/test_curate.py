import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aislecast.operators import curate, fill
from tests import frames

KEYS = ["store_id", "sku", "date"]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("chunk", [None, "hour", "month"])
def test_prices_fill_as_a_sorted_scan_would(spark, seed, chunk):
    sales = frames.random_sales(seed)
    df = frames.to_spark(spark, sales, frames.SALES_DDL)
    got = fill.fill_prices(curate.drop_unsold(df), chunk, salts=3).toPandas()
    want = frames.fill_prices(sales)
    order = ["store_id", "sku", "ts", "qty_sold", "price", "channel"]
    got, want = (x.astype({"qty_sold": int}).sort_values(order)[order].reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_copies_of_an_unpriced_row_are_all_given_back(spark, monkeypatch):
    monkeypatch.setattr(fill, "COPY_BATCH", 10)
    row = ("S", "K", dt.datetime(2025, 1, 2), 1, None, "online")
    priced = ("S", "K", dt.datetime(2025, 1, 1), 1, 4.0, "online")
    df = spark.createDataFrame([row] * 57 + [priced], frames.SALES_DDL)
    got = fill.fill_prices(df).groupBy("ts", "price").count().orderBy("ts").collect()
    assert [(r["price"], r["count"]) for r in got] == [(4.0, 1), (4.0, 57)]


@pytest.mark.parametrize("seed", [4, 5])
def test_dense_table_equals_brute_force(spark, seed):
    sales = frames.random_sales(seed, rows=150)
    df = frames.to_spark(spark, sales, frames.SALES_DDL)
    filled = frames.fill_prices(sales)
    filled["date"] = pd.to_datetime(filled["ts"]).dt.date
    filled["line"] = filled["qty_sold"].astype(float) * filled["price"]
    daily = filled.groupby(KEYS, as_index=False).agg(
        qty_sold=("qty_sold", "sum"), revenue=("line", "sum"), avg_price=("price", "mean")
    )
    shelf = daily.iloc[::2][KEYS].copy()
    shelf["avg_shelf_qty"] = [float(i % 30) for i in range(len(shelf))]
    # Readings of a product and a day outside the sales do not add rows.
    stray = pd.DataFrame(
        [("STORE_001", "SKU_999", daily["date"].iloc[0], 1.0), ("STORE_001", "SKU_001", dt.date(2030, 1, 1), 1.0)],
        columns=[*KEYS, "avg_shelf_qty"],
    )
    readings = spark.createDataFrame(
        pd.concat([shelf, stray]), "store_id string, sku string, date date, avg_shelf_qty double"
    )
    out = curate.densify(curate.daily_sales_filled(df), readings).toPandas()
    want = frames.dense(daily, shelf)
    columns = [*KEYS, "qty_sold", "revenue", "avg_price", "avg_shelf_qty"]
    got, want = (x.sort_values(KEYS)[columns].reset_index(drop=True) for x in (out, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, atol=0.0101, rtol=0)
    assert (got["avg_price"] - want["avg_price"]).abs().gt(1e-9).mean() < 0.01
    stores, skus = want["store_id"].nunique(), want["sku"].nunique()
    assert len(got) == stores * skus * want["date"].nunique()


def daily_frame(spark, rows):
    return spark.createDataFrame(rows, "store_id string, sku string, date date, qty_sold long, revenue double, avg_price double")


def test_price_crosses_stores_unless_told_not_to(spark):
    day = dt.date
    daily = daily_frame(
        spark,
        [
            ("A", "K", day(2025, 1, 2), 1, 5.0, 5.0),
            ("B", "L", day(2025, 1, 1), 1, 7.0, 7.0),
            ("C", "K", day(2025, 1, 3), 1, 9.0, 9.0),
        ],
    )

    def price(df, store, sku, date):
        return df.filter((F.col("store_id") == store) & (F.col("sku") == sku) & (F.col("date") == date)).first()["avg_price"]

    across = curate.densify(daily)
    assert across.count() == 3 * 2 * 3
    assert price(across, "A", "K", day(2025, 1, 1)) == 5.0  # own first price, backwards
    assert price(across, "B", "K", day(2025, 1, 1)) == 5.0  # from the store before
    assert price(across, "C", "K", day(2025, 1, 1)) == 5.0  # before its own first price
    assert price(across, "C", "K", day(2025, 1, 3)) == 9.0
    assert price(across, "A", "L", day(2025, 1, 1)) == 7.0  # from the next store
    alone = curate.densify(daily, partition_by_store=True)
    assert price(alone, "C", "K", day(2025, 1, 1)) == 9.0
    assert price(alone, "B", "K", day(2025, 1, 1)) == 10.0
    observed = curate.densify(daily, pairs="observed")
    assert observed.count() == 3 * 3


def test_sentiment_defaults_to_neutral_and_flags_are_off(spark):
    daily = daily_frame(spark, [("A", "K", dt.date(2025, 1, 1), 1, 5.0, 5.0), ("A", "L", dt.date(2025, 1, 1), 1, 5.0, 5.0)])
    scores = spark.createDataFrame([("K", 0.5)], "sku string, sentiment_score double")
    rows = {r["sku"]: r for r in curate.densify(daily, sentiment=scores).collect()}
    assert rows["K"]["sentiment_score"] == 0.5 and rows["L"]["sentiment_score"] == 0.0
    assert not rows["K"]["graph_co_stock_flag"] and rows["K"]["avg_shelf_qty"] == 20.0


def test_dense_rows_are_shuffled_only_as_sparse_rows(spark):
    daily = daily_frame(spark, [("A", "K", dt.date(2025, 1, d), 1, 5.0, 5.0) for d in (1, 9)])
    plan = curate.densify(daily)._jdf.queryExecution().executedPlan().toString()
    after_explode = plan[: plan.index("explode(sequence(date")]
    assert "Exchange" not in after_explode and "CartesianProduct" not in plan


def test_replay_events(spark):
    sales = spark.createDataFrame(
        [("S", "K", dt.datetime(2025, 6, 1, 12, 30), None, None, None), ("S", "K", dt.datetime(2025, 6, 1), 30, 2.5, "online")],
        frames.SALES_DDL,
    )
    pos = curate.replay_sales(sales).collect()
    assert pos[0].asDict() == {
        "store_id": "S", "sku": "K", "ts": "2025-06-01 12:30:00", "qty_sold": 0, "price": 0.0, "channel": "in-store",
    }
    iot = curate.replay_shelf(sales).collect()
    assert [r["shelf_qty"] for r in iot] == [25, 0] and iot[0]["sensor_id"] == "SNSR_S_K"


def test_rows_without_keys_are_kept_by_the_fill_and_left_out_of_days(spark):
    at = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame(
        [("S", None, at, 1, None, "online"), ("S", "K", None, 1, None, "online"), ("S", "K", at, 2, 3.0, "online")],
        frames.SALES_DDL,
    )
    assert sorted(r["price"] for r in fill.fill_prices(df).collect()) == [3.0, 10.0, 10.0]
    assert [r["qty_sold"] for r in curate.daily_sales_filled(df).collect()] == [2]


def test_fill_reads_the_reduced_times_once(spark, tmp_path):
    frames.to_spark(spark, frames.random_sales(1), frames.SALES_DDL).write.parquet(str(tmp_path / "s"))
    sales = curate.by_day(spark.read.parquet(str(tmp_path / "s")))
    df = fill.missing_price_fills(sales, "hour")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "IsNotNull(sku)" in plan
    # in ranges of rows they are a written table, and the sales are not read again
    plan = fill.missing_price_fills(sales)._jdf.queryExecution().optimizedPlan().toString()
    assert "qty_sold" not in plan and "_chunk" in plan


def test_one_product_in_one_hour_fills_in_several_tasks(spark):
    ts = F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id") * 100).cast("timestamp_ntz")
    price = F.when(F.col("id") % 500 == 0, (F.col("id") / 500).cast("decimal(18,2)"))
    sales = spark.range(30_000).select(F.lit("S").alias("store_id"), F.lit("K").alias("sku"), ts.alias("ts"), F.col("id").cast("int").alias("qty_sold"), price.alias("price"), F.lit("online").alias("channel"))
    times = fill._ranges(sales.groupBy("sku", "ts").agg(F.min("price").alias("_low"), F.max("price").alias("_high"), F.max(F.col("price").isNull()).alias("_missing")), None)
    sizes = [r["count"] for r in times.groupBy("_chunk").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
    got = fill.fill_prices(sales, salts=3).agg(F.count_if(F.col("price") != F.floor(F.col("qty_sold") / 500)).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    assert got["bad"] == 0 and got["n"] == 30_000
