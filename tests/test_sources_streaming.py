import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aislecast.contracts import POS_EVENT, SHELF_EVENT, TRUTH
from aislecast.operators import curate, sentiment
from aislecast.plans.pipeline import refresh, run_upload
from aislecast.sources import readers, writers
from aislecast.streaming import landing
from tests import frames

POS = {"store_id": "S1", "sku": "K1", "ts": "2025-06-01 12:30:00", "qty_sold": 2, "price": 14.99, "channel": "in-store"}
IOT = {"store_id": "S1", "sku": "K1", "ts": "2025-06-01 12:30:00", "shelf_qty": 20, "sensor_id": "SNSR_S1_K1"}


def put(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(records))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def zone(tmp_path):
    return landing.Landing(str(tmp_path / "zone"))


def drain(spark, tmp_path, land, checkpoint="cp", **options):
    source = readers.stream_buffer(spark, str(tmp_path / "buffer"), "pos_stream_*.json", POS_EVENT, **options)
    landing.drain(source, land.one("sales_events"), str(tmp_path / checkpoint))
    return land.read(spark, "sales_events")


def test_array_files_land_by_day_without_duplicates(spark, tmp_path, zone):
    buffer = tmp_path / "buffer"
    late = {**POS, "ts": "2025-05-20 01:00:00", "qty_sold": 9}
    put(buffer, "pos_stream_1.json", [POS, {**POS, "qty_sold": 3}, POS])
    put(buffer, "iot_stream_1.json", [IOT])
    assert drain(spark, tmp_path, zone, max_files=1).count() == 2
    # A repeated row, a late row, and one whose time is unusable.
    put(buffer, "pos_stream_2.json", [POS, late, {**POS, "ts": "whenever"}])
    got = drain(spark, tmp_path, zone, max_files=1)
    days = [r["date"] for r in got.orderBy("date").collect()]
    assert days == [dt.date(2025, 5, 20), dt.date(2025, 6, 1), dt.date(2025, 6, 1)]
    aside = [json.loads(r["value"])["ts"] for r in zone.quarantined(spark, "sales_events").collect()]
    assert aside == ["whenever"]


def test_a_new_checkpoint_does_not_touch_landed_batches(spark, tmp_path, zone):
    put(tmp_path / "buffer", "pos_stream_1.json", [POS])
    drain(spark, tmp_path, zone, "cp1")
    put(tmp_path / "buffer", "pos_stream_2.json", [{**POS, "qty_sold": 5}])
    got = drain(spark, tmp_path, zone, "cp2")
    assert sorted(r["qty_sold"] for r in got.collect()) == [2, 5]


def test_a_batch_that_runs_again_changes_nothing(spark, zone):
    first = spark.createDataFrame([tuple(POS.values())], POS_EVENT)
    second = spark.createDataFrame([tuple({**POS, "qty_sold": q}.values()) for q in (2, 7)], POS_EVENT)
    zone.land(first, "sales_events", 0)
    zone.land(second, "sales_events", 1)
    before = rows(zone.read(spark, "sales_events"))
    zone.land(second, "sales_events", 1)
    zone.land(first, "sales_events", 0)
    assert rows(zone.read(spark, "sales_events")) == before and len(before) == 2


def test_missing_cells_are_equal_when_deduplicating(spark, zone):
    df = spark.createDataFrame([("S", "K", "2025-01-01 00:00:00", None, None, None)], POS_EVENT)
    zone.land(df, "sales_events", 0)
    zone.land(df, "sales_events", 1)
    assert zone.read(spark, "sales_events").count() == 1


def test_a_missing_time_lands_today(spark, zone):
    df = spark.createDataFrame([("S", "K", None, 1, 1.0, "online")], POS_EVENT)
    zone.land(df, "sales_events", 0)
    assert abs((zone.read(spark, "sales_events").first()["date"] - dt.date.today()).days) <= 1


def test_dedupe_key_is_a_choice(spark, tmp_path):
    land = landing.Landing(str(tmp_path), keys={"sales_events": ["store_id", "sku", "ts"]})
    df = spark.createDataFrame([tuple({**POS, "qty_sold": q}.values()) for q in (1, 2)], POS_EVENT)
    land.land(df, "sales_events", 0)
    land.land(df, "sales_events", 1)
    assert land.read(spark, "sales_events").count() == 1


def test_messages_are_routed_and_bad_ones_kept_aside(spark, tmp_path, zone):
    messages = spark.createDataFrame(
        [("pos-events", json.dumps(POS)), ("iot-stock-events", json.dumps(IOT)), ("pos-events", "{oops"), ("other", "{}")],
        "topic string, value string",
    )
    zone.routed()(messages, 3)
    assert zone.read(spark, "sales_events").count() == 1
    assert zone.read(spark, "iot_stock_events").first()["shelf_qty"] == 20
    kept = spark.read.text(str(tmp_path / "zone" / "_quarantine" / "sales_events"))
    assert [r["value"] for r in kept.collect()] == ["{oops"]


def test_stream_equals_batch(spark, tmp_path):
    sales = frames.to_spark(spark, frames.random_sales(8, rows=120), frames.SALES_DDL)
    events = curate.replay_sales(sales)
    parts = events.randomSplit([1.0, 1.0, 1.0], 1)
    land = landing.Landing(str(tmp_path / "zone"))
    for part in [*parts, parts[0]]:
        writers.write_buffer(part, str(tmp_path / "buffer"), "pos")
        source = readers.stream_buffer(spark, str(tmp_path / "buffer" / "pos"), "*.json", POS_EVENT, arrays=False, max_files=2)
        landing.drain(source, land.one("sales_events"), str(tmp_path / "cp"))
    assert rows(land.read(spark, "sales_events").drop("date")) == rows(events.distinct())


def test_event_contracts(spark):
    raw = spark.createDataFrame([(json.dumps(POS),), (json.dumps({**POS, "qty_sold": "many"}),)], "value string")
    good, bad = readers.parse_events(raw, POS_EVENT).collect()
    assert good["qty_sold"] == 2 and good["price"] == 14.99 and good["_corrupt_record"] is None
    assert bad["_corrupt_record"] is not None
    raw = spark.createDataFrame([(json.dumps(IOT),)], "value string")
    assert readers.parse_events(raw, SHELF_EVENT).drop("_corrupt_record").first().asDict() == IOT


def test_bounded_dedupe_is_a_streaming_plan(spark, tmp_path):
    put(tmp_path / "buffer", "pos_stream_1.json", [POS, POS])
    source = readers.stream_buffer(spark, str(tmp_path / "buffer"), "pos_stream_*.json", POS_EVENT)
    timed = source.withColumn("at", F.col("ts").cast("timestamp"))
    out = landing.bounded_dedupe(timed, "at", ["store_id", "sku", "ts"], "2 days")
    query = out.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert spark.table("deduped").count() == 1


def test_refreshing_days_leaves_the_others(spark, tmp_path):
    day = dt.date
    daily = lambda df: df.groupBy("date").agg(F.sum("qty_sold").alias("qty_sold"))
    path = str(tmp_path / "daily")
    old = spark.createDataFrame([(day(2025, 1, 1), 1), (day(2025, 1, 2), 2)], "date date, qty_sold int")
    landing.refresh_days(daily, old, [day(2025, 1, 1), day(2025, 1, 2)], path)
    new = spark.createDataFrame([(day(2025, 1, 1), 100), (day(2025, 1, 2), 5)], "date date, qty_sold int")
    landing.refresh_days(daily, new, [day(2025, 1, 2)], path)
    got = {r["date"].day: r["qty_sold"] for r in spark.read.parquet(path).collect()}
    assert got == {1: 1, 2: 5}


def test_csv_round_trip_keeps_quotes_and_line_breaks(spark, tmp_path):
    texts = [("K1", 'He said "fine", twice.'), ("K2", "two\nlines, one review"), ("K3", "Decent, not great")]
    df = spark.createDataFrame(texts, "sku string, review_text string")
    writers.land_reviews(df, str(tmp_path / "reviews"))
    assert rows(readers.read_reviews_csv(spark, str(tmp_path / "reviews"))) == sorted(texts)


def test_json_array_file(spark, tmp_path):
    put(tmp_path, "truth.json", [{"store_id": "S", "sku": "K", "start_date": "2025-06-01", "end_date": "2025-06-05", "type": "stockout_risk"}])
    row = readers.read_json_array(spark, str(tmp_path / "truth.json"), TRUTH).first()
    assert row["end_date"] == dt.date(2025, 6, 5)


def test_landing_twice_is_the_same(spark, tmp_path):
    sales = frames.to_spark(spark, frames.random_sales(1, rows=60, days=5), frames.SALES_DDL)
    path = str(tmp_path / "raw")
    writers.land_sales(sales, path)
    writers.land_sales(sales, path)
    assert spark.read.option("header", True).csv(path).count() == sales.count()


def test_warehouse_sync_is_idempotent_and_comments_columns(spark, tmp_path):
    spark.sql(f"CREATE DATABASE wh LOCATION '{tmp_path / 'wh'}'")
    df = spark.createDataFrame([(1, 0.5)], "id int, graph_co_stock_freq double")
    for _ in range(2):
        assert writers.sync_warehouse(spark, {"t": df, "absent": None}, "wh") == {"t": 1}
    comments = {f.name: f.metadata.get("comment") for f in spark.table("wh.t").schema}
    assert comments["graph_co_stock_freq"].startswith("Experimental")


def test_stored_scores_follow_their_reviews(spark, tmp_path):
    df = spark.createDataFrame([("K", "good"), ("L", "  "), (None, "good")], "sku string, review_text string")
    first = sentiment.stored_sentiment(df, str(tmp_path))
    assert rows(first) == [("K", 1.0), ("L", 0.0)]
    more = df.union(spark.createDataFrame([("K", "bad")], df.schema))
    assert rows(sentiment.stored_sentiment(more, str(tmp_path))) == [("K", 0.0), ("L", 0.0)]
    assert sentiment.input_fingerprint(df) != sentiment.input_fingerprint(more)


def test_upload_runs_end_to_end(spark):
    data = frames.random_sales(12, rows=1500, days=60, stores=2, skus=2)
    data = data.rename(columns={"ts": "Order Date", "sku": "Item", "qty_sold": "Units", "price": "Unit Price", "store_id": "Branch"})
    ddl = "Branch string, Item string, `Order Date` timestamp_ntz, Units int, `Unit Price` double, channel string"
    data = data[["Branch", "Item", "Order Date", "Units", "Unit Price", "channel"]].dropna(subset=["Units"])
    raw = spark.createDataFrame(
        [(a, b, c.to_pydatetime(), int(d), None if e is None or e != e else float(e), f) for a, b, c, d, e, f in data.itertuples(index=False)], ddl
    )
    result = run_upload(raw, trees=3, horizon=4, holdout_days=7)
    profile = result.profile.first()
    assert profile["total_rows"] == 2 * 2 * profile["history_days"]
    assert result.forecasts.count() == 4 * 4 and result.warehouse_warning is None
    assert result.backtest.matched.count() == 4 * 7


def test_refresh_returns_counts(spark, tmp_path):
    sales = frames.to_spark(spark, frames.random_sales(2, rows=80, days=6), frames.SALES_DDL)
    spark.sql(f"CREATE DATABASE rf LOCATION '{tmp_path / 'rf'}'")
    row = refresh(spark, sales, None, str(tmp_path / "zone"), "rf").first()
    assert row["status"] == "completed" and row["sales_records_ingested"] == sales.count()
    assert row["iot_records_ingested"] == 0 and row["curated_records"] == spark.table("rf.curated_sales_daily").count()
