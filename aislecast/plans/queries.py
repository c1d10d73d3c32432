"""Registered queries: one per inventory row, with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislecast import contracts
from aislecast.functions import dates, ids, money
from aislecast.functions.numeric import at_least_zero, interval_bounds, round_even, unit_interval
from aislecast.functions.text import lexicon_score, tokens, truncate
from aislecast.operators import (
    anomalies as an,
)
from aislecast.operators import (
    baseline,
    curate,
    drift,
    evaluate,
    features,
    fill,
    forecast,
    graph,
    normalize,
    ordering,
    quality,
    repair,
    reports,
    sentiment,
    upsert,
)
from aislecast.plans import oracle
from aislecast.plans.oracle import r
from aislecast.plans.tables import TRAIN_ROWS, Tables, sample_scorer
from aislecast.session import stage, stage_path
from aislecast.sources import readers, versions, writers
from aislecast.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

KEYS = curate.KEYS
SERIES = curate.SERIES


def query(name: str, sql: str | None = None):
    """Register a function of the shared tables, and its SQL twin."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Tables.of(spark, sf_dir))
        if sql is not None:
            SQL[name] = oracle.sql(sql)
        return build

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Float sums depend on their order in the last bits; compare rounded."""
    return df.withColumns({c: round_even(F.col(c), digits) for c in columns})


# --- A: sources ---------------------------------------------------------------


@query(
    "a1_sales_csv_scan",
    "SELECT store_id, sku, ts, qty_sold, price::DOUBLE AS price, channel FROM sales_raw",
)
def a1(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "sales-csv")
    writers.write_csv(t.sales, path)
    return readers.read_sales_csv(t.spark, path)


@query("a2_reviews_csv_scan", "SELECT sku, review_text FROM reviews")
def a2(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "reviews-csv")
    writers.land_reviews(t.reviews, path)
    return readers.read_reviews_csv(t.spark, path)


@query(
    "a3_parquet_scan",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'",
)
def a3(t: Tables) -> DataFrame:
    lines = readers.read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet")
    return lines.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@query(
    "a4_json_array_scan",
    "SELECT store_id, sku, date AS start_date, date AS end_date, anomaly_type AS type FROM anomalies",
)
def a4(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "truth-json")
    event = F.struct(
        *SERIES, F.col("date").alias("start_date"), F.col("date").alias("end_date"),
        F.col("anomaly_type").alias("type"),
    )
    (
        t.anomalies.groupBy(F.col("store_id").alias("of_store"), F.col("sku").alias("of_sku"))
        .agg(F.to_json(F.collect_list(event)).alias("value"))
        .write.partitionBy("of_store", "of_sku")
        .text(path)
    )
    return readers.read_json_array(t.spark, path).select(*contracts.TRUTH.names)


@query(
    "a5_contract_check",
    "SELECT channel, count(*) AS rows FROM sales_raw GROUP BY channel",
)
def a5(t: Tables) -> DataFrame:
    sales = contracts.require_columns(t.sales, contracts.SALES, "sales")
    return sales.groupBy("channel").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a6_message_parse",
    "SELECT store_id, sku, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, coalesce(qty_sold, 0)::INTEGER AS qty_sold, "
    "coalesce(price::DOUBLE, 0.0) AS price, coalesce(channel, 'in-store') AS channel FROM sales_raw",
)
def a6(t: Tables) -> DataFrame:
    messages = writers.keyed_json(curate.replay_sales(t.sales))
    return readers.parse_events(messages, contracts.POS_EVENT).drop("_corrupt_record")


# --- B: sinks -----------------------------------------------------------------


@query(
    "b1_land_sales_by_date",
    "SELECT ts::DATE AS date, count(*) AS rows, sum(qty_sold)::BIGINT AS qty_sold FROM sales_raw GROUP BY 1",
)
def b1(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "raw-sales")
    writers.land_sales(t.sales, path)
    by_day = contracts.T.StructType(
        [*contracts.SALES.fields, contracts.T.StructField("date", contracts.T.DateType())]
    )
    return (
        t.spark.read.schema(by_day).option("header", True).csv(path)
        .groupBy("date").agg(F.count(F.lit(1)).alias("rows"), F.sum("qty_sold").alias("qty_sold"))
    )


@query(
    "b2_land_reviews",
    "SELECT sku, count(*) AS rows, sum(length(review_text))::BIGINT AS characters FROM reviews GROUP BY sku",
)
def b2(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "raw-reviews")
    writers.land_reviews(t.reviews, path)
    return readers.read_reviews_csv(t.spark, path).groupBy("sku").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("review_text")).alias("characters")
    )


@query(
    "b3_curated_csv",
    f"SELECT store_id, date, sum(qty_sold)::BIGINT AS qty_sold, {r('sum(revenue)', 2)} AS revenue "
    "FROM curated GROUP BY ALL",
)
def b3(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "curated-csv")
    writers.write_csv(curate.with_date_text(t.curated), path)
    back = t.spark.read.schema(t.curated.schema).option("header", True).csv(path)
    out = back.groupBy("store_id", "date").agg(
        F.sum("qty_sold").alias("qty_sold"), F.sum("revenue").alias("revenue")
    )
    return rounded(out, 2, "revenue")


@query(
    "b4_curated_by_date",
    f"SELECT date, count(*) AS rows, sum(qty_sold)::BIGINT AS qty_sold, {r('sum(avg_shelf_qty)', 2)} AS shelf "
    "FROM curated GROUP BY date",
)
def b4(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "curated-zone")
    writers.write_curated(t.curated, folder, csv=False)
    out = t.spark.read.schema(t.curated.schema).parquet(f"{folder}/sales_daily").groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("qty_sold").alias("qty_sold"),
        F.sum("avg_shelf_qty").alias("shelf"),
    )
    return rounded(out, 2, "shelf")


CO_STOCK_SQL = """
  SELECT a.store_id, a.sku, least(greatest(CASE WHEN count(n.dst) > 0
      THEN sum(coalesce(p.active_days, 0))::DOUBLE / count(n.dst)
      ELSE any_value(a.active_days)::DOUBLE END / any_value(d.store_days), 0.0), 1.0) AS freq
  FROM {active} a JOIN {days} d ON a.store_id = d.store_id
  LEFT JOIN {edges} n ON n.src = a.sku
  LEFT JOIN {active} p ON p.store_id = a.store_id AND p.sku = n.dst
  GROUP BY a.store_id, a.sku"""


def graph_sql(edges: str, cutoff: str | None = None) -> str:
    history = f"curated WHERE date <= DATE '{cutoff}'" if cutoff else "curated WHERE true"
    co_stock = CO_STOCK_SQL.format(active="active", days="days", edges=edges)
    return f"""
SELECT c.store_id, c.sku, c.date,
  coalesce(f.freq, 0.5) AS graph_co_stock_freq,
  CASE WHEN s.sku IS NULL THEN 0.0 ELSE 1.0 END AS graph_substitute_available
FROM curated c
LEFT JOIN (WITH
    active AS (SELECT store_id, sku, count(DISTINCT date) AS active_days FROM {history}
      AND qty_sold > 0 GROUP BY ALL),
    days AS (SELECT store_id, count(DISTINCT date) AS store_days FROM {history} GROUP BY ALL)
  {co_stock}) f ON f.store_id = c.store_id AND f.sku = c.sku
LEFT JOIN (SELECT DISTINCT p.store_id, p.date, n.src AS sku FROM prev_shelf p
    JOIN {edges} n ON n.dst = p.sku WHERE p.prev > 2.0) s
  ON s.store_id = c.store_id AND s.sku = c.sku AND s.date = c.date"""


CUTOFF = "2000-12-31"


@query(
    "b5_enriched_version",
    f"SELECT store_id, {r('avg(graph_co_stock_freq)', 6)} AS freq, "
    f"sum(graph_substitute_available)::DOUBLE AS available FROM ({graph_sql('neighbours')}) GROUP BY store_id",
)
def b5(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "curated-versions")
    path = writers.write_version(graph.point_in_time_features(t.curated, t.neighbours), folder, "v2")
    out = t.spark.read.parquet(path).groupBy("store_id").agg(
        F.avg("graph_co_stock_freq").alias("freq"),
        F.sum("graph_substitute_available").alias("available"),
    )
    return rounded(out, 6, "freq")


@query(
    "b5_committed_version",
    f"SELECT 'before' AS seen, store_id, 0.0::DOUBLE AS freq FROM ({graph_sql('neighbours')}) GROUP BY store_id UNION ALL "
    f"SELECT 'after', store_id, {r('avg(graph_co_stock_freq)', 6)} FROM ({graph_sql('neighbours')}) GROUP BY store_id",
)
def b5_committed(t: Tables) -> DataFrame:
    """Enriching a table that is being read: until the commit readers see the old version, then the new one."""
    table = versions.VersionedTable(stage_path(t.spark, "curated-table"), tuple(SERIES), 8)
    table.write(t.curated.withColumn("graph_co_stock_freq", F.lit(0.0)))
    plain = table.read(t.spark).drop("graph_co_stock_freq")
    enriched = graph.point_in_time_features(plain, t.neighbours).select(*plain.columns, "graph_co_stock_freq")
    base, _ = table.record.read(t.spark)
    staged = table.stage(enriched)
    before = table.read(t.spark)
    table.commit(t.spark, base, staged, enriched.schema)
    seen = [(name, df) for name, df in (("before", before), ("after", table.read(t.spark)))]
    means = [
        df.groupBy("store_id").agg(F.avg("graph_co_stock_freq").alias("freq")).select(F.lit(name).alias("seen"), "store_id", "freq")
        for name, df in seen
    ]
    return rounded(means[0].unionByName(means[1]), 6, "freq")


@query("b6_forecast_sink", "SELECT * FROM mean_forecast")
def b6(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "forecast-sink")
    writers.write_forecast(baseline.mean_forecast(t.curated), path)
    return readers.read_parquet(t.spark, path, contracts.FORECAST)


@query(
    "b7_anomaly_sinks",
    "SELECT f.format, anomaly_type, count(*) AS rows FROM anomalies, "
    "(VALUES ('parquet'), ('json'), ('csv')) f(format) GROUP BY ALL",
)
def b7(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "anomaly-sinks")
    writers.write_anomalies(t.anomalies, folder)
    schema = t.anomalies.schema
    read = t.spark.read.schema(schema)
    back = [
        ("parquet", read.parquet(f"{folder}/parquet")),
        ("json", t.spark.read.schema(schema).json(f"{folder}/json")),
        ("csv", t.spark.read.schema(schema).options(header=True, escape='"').csv(f"{folder}/csv")),
    ]
    out = None
    for name, df in back:
        part = df.select(F.lit(name).alias("format"), "anomaly_type")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("format", "anomaly_type").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "b8_warehouse_sync",
    "SELECT 'curated_sales_daily' AS name, count(*) AS rows FROM curated UNION ALL "
    "SELECT 'predictions_forecast', count(*) FROM mean_forecast UNION ALL "
    "SELECT 'predictions_anomaly', count(*) FROM anomalies",
)
def b8(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "warehouse")
    database = "aislecast_" + path[-12:]
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    tables = {
        "curated_sales_daily": t.curated,
        "predictions_forecast": t.forecasts,
        "predictions_anomaly": t.anomalies,
    }
    for _ in range(2):
        writers.sync_warehouse(t.spark, tables, database)
    out = None
    for name in tables:
        part = t.spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), "rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "b12_export_slice",
    "SELECT date, store_id, sku, forecast_qty, lower_ci, upper_ci FROM mean_forecast WHERE store_id = 'ASIA'",
)
def b12(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "export")
    columns = ["date", "store_id", "sku", "forecast_qty", "lower_ci", "upper_ci"]
    sliced = reports.export_slice(t.forecasts, columns, store_id="ASIA")
    writers.write_csv(sliced, path)
    return t.spark.read.schema(sliced.schema).option("header", True).csv(path)


@query("b15_stored_sentiment", "SELECT sku, sentiment_score FROM sentiment")
def b15(t: Tables) -> DataFrame:
    folder = stage_path(t.spark, "sentiment")
    sentiment.stored_sentiment(t.reviews, folder, sample_scorer, "test")
    return sentiment.stored_sentiment(t.reviews, folder, sample_scorer, "test")


@query(
    "b16_keyed_messages",
    "SELECT store_id AS key, count(*) AS rows, sum(coalesce(qty_sold, 0))::BIGINT AS qty_sold "
    "FROM sales_raw GROUP BY store_id",
)
def b16(t: Tables) -> DataFrame:
    messages = writers.keyed_json(curate.replay_sales(t.sales))
    qty = F.get_json_object("value", "$.qty_sold").cast("long")
    return messages.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum(qty).alias("qty_sold"))


ACKED_SQL = """SELECT *, severity = 'high' AND anomaly_type = 'stockout_risk' AS acked FROM anomalies"""


@query(
    "b18_acknowledged_version",
    f"SELECT acked AS acknowledged, count(*) AS rows FROM ({ACKED_SQL}) GROUP BY acked",
)
def b18(t: Tables) -> DataFrame:
    state = an.with_acknowledgements(t.anomalies, t.acks)
    path = writers.write_acknowledged(state, stage_path(t.spark, "triage"), "1")
    return t.spark.read.parquet(path).groupBy("acknowledged").agg(F.count(F.lit(1)).alias("rows"))


# --- P: projections and filters -------------------------------------------------


@query(
    "p1_drop_unsold",
    "SELECT store_id, sku, ts, qty_sold, price::DOUBLE AS price FROM sales_raw WHERE qty_sold IS NOT NULL",
)
def p1(t: Tables) -> DataFrame:
    return curate.drop_unsold(t.sales).select(
        "store_id", "sku", "ts", "qty_sold", F.col("price").cast("double").alias("price")
    )


@query(
    "p2_event_date",
    "SELECT event_id, ts::DATE AS date, TRY_CAST(substr(event_type, 1, 4) AS DATE) AS bad FROM events",
)
def p2(t: Tables) -> DataFrame:
    events = t.table("events").withColumn("ts", F.col("ts").cast("string"))
    return dates.with_event_date(events).select(
        "event_id", "date", F.to_date(dates.lenient_timestamp(F.substring("event_type", 1, 4))).alias("bad")
    )


@query(
    "p3_line_revenue",
    "SELECT store_id, sku, ts, qty_sold, (qty_sold * price)::DOUBLE AS revenue_line FROM sales_raw",
)
def p3(t: Tables) -> DataFrame:
    lines = curate.with_line_revenue(t.sales)
    return lines.select("store_id", "sku", "ts", "qty_sold", F.col("revenue_line").cast("double").alias("revenue_line"))


FILLED_MEASURES = f"""coalesce(qty_sold, 0)::BIGINT AS qty_sold, {r('coalesce(revenue, 0.0)', 2)} AS revenue,
  {r('coalesce(avg_shelf_qty, 20.0)', 2)} AS avg_shelf_qty"""


@query(
    "p4_fill_measures",
    f"SELECT store_id, sku, date, {FILLED_MEASURES} FROM daily FULL JOIN "
    "shelf s USING (store_id, sku, date)",
)
def p4(t: Tables) -> DataFrame:
    stocked = curate.daily_shelf(t.iot)
    joined = curate.join_daily(curate.daily_sales_filled(t.sales), stocked)
    return curate.fill_missing_measures(joined).select(*KEYS, "qty_sold", "revenue", "avg_shelf_qty")


@query(
    "p5_default_flags",
    "SELECT store_id, sku, date, qty_sold, false AS graph_co_stock_flag, "
    "false AS graph_substitute_available FROM daily",
)
def p5(t: Tables) -> DataFrame:
    return curate.with_default_flags(curate.daily_sales_filled(t.sales)).select(
        *KEYS, "qty_sold", "graph_co_stock_flag", "graph_substitute_available"
    )


@query(
    "p6_date_text",
    "SELECT strftime(date, '%Y-%m-%d') AS date, sum(qty_sold)::BIGINT AS qty_sold FROM curated GROUP BY 1",
)
def p6(t: Tables) -> DataFrame:
    return curate.with_date_text(t.curated).groupBy("date").agg(F.sum("qty_sold").alias("qty_sold"))


@query(
    "p7_pos_events",
    "SELECT store_id, sku, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, coalesce(qty_sold, 0)::INTEGER AS qty_sold, "
    "coalesce(price::DOUBLE, 0.0) AS price, coalesce(channel, 'in-store') AS channel FROM sales_raw",
)
def p7(t: Tables) -> DataFrame:
    return curate.replay_sales(t.sales)


@query(
    "p8_shelf_events",
    "SELECT store_id, sku, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, "
    "greatest(0, 25 - coalesce(qty_sold, 0))::INTEGER AS shelf_qty, "
    "'SNSR_' || store_id || '_' || sku AS sensor_id FROM sales_raw",
)
def p8(t: Tables) -> DataFrame:
    return curate.replay_shelf(t.sales)


EXPORT_SQL = """SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'unknown'
    ELSE strftime(l_shipdate, '%Y-%m-%d') END AS "Order Date",
  p_brand AS "Item", CASE WHEN l_orderkey % 50 = 0 THEN 'n/a' WHEN l_orderkey % 51 = 0 THEN 'nan' WHEN l_orderkey % 52 = 0 THEN '3000000000' ELSE l_quantity::INTEGER::VARCHAR END AS "Units",
  CASE WHEN l_orderkey % 60 = 0 THEN '?' WHEN l_orderkey % 61 = 0 THEN 'nan' WHEN l_orderkey % 62 = 0 THEN 'inf' ELSE l_extendedprice::DECIMAL(18, 2)::VARCHAR END AS "Unit Rate",
  r_name AS "Branch" FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey"""


def export(t: Tables) -> DataFrame:
    """Order lines as an export with foreign headers and some bad cells."""
    from aislecast.sources.views import sale_lines

    key = F.col("l_orderkey")
    return sale_lines(t.spark, t.sf_dir).select(
        F.when(key % 97 == 0, "unknown").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("Order Date"),
        F.col("sku").alias("Item"),
        F.when(key % 50 == 0, "n/a").when(key % 51 == 0, "nan").when(key % 52 == 0, "3000000000").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("Units"),
        F.when(key % 60 == 0, "?").when(key % 61 == 0, "nan").when(key % 62 == 0, "inf")
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .alias("Unit Rate"),
        F.col("store_id").alias("Branch"),
    )


NORMALIZED_SQL = f"""SELECT TRY_CAST("Order Date" AS DATE) AS date, "Item" AS sku,
  coalesce(TRY_CAST(CASE WHEN isfinite(TRY_CAST("Units" AS DOUBLE)) THEN TRY_CAST("Units" AS DOUBLE) END AS INTEGER), 0) AS qty_sold,
  coalesce(CASE WHEN isfinite(TRY_CAST("Unit Rate" AS DOUBLE)) THEN TRY_CAST("Unit Rate" AS DOUBLE) END, 150.0) AS price,
  qty_sold * price AS revenue,
  "Branch" AS store_id, 'in_store' AS channel
FROM ({EXPORT_SQL}) WHERE TRY_CAST("Order Date" AS DATE) IS NOT NULL"""


@query("p10_normalize_export", NORMALIZED_SQL)
def p10(t: Tables) -> DataFrame:
    return normalize.normalize_export(export(t)).drop("ts")


@query(
    "p11_history_gate",
    f"SELECT (max(date) - min(date) + 1)::INTEGER AS history_days, max(date) - min(date) + 1 >= 35 AS accepted "
    f"FROM ({NORMALIZED_SQL})",
)
def p11(t: Tables) -> DataFrame:
    return normalize.history_verdict(normalize.normalize_export(export(t)))


def side_counts(train: DataFrame, test: DataFrame) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("store_id", F.lit(name).alias("side")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last")
        )

    return side(train, "train").unionByName(side(test, "test"))


@query(
    "p12_holdout_split",
    "SELECT store_id, CASE WHEN date <= (SELECT max(date) - 28 FROM curated) THEN 'train' ELSE 'test' END AS side, "
    "count(*) AS rows, min(date) AS first, max(date) AS last FROM curated GROUP BY ALL",
)
def p12(t: Tables) -> DataFrame:
    return side_counts(*features.split_holdout(t.curated))


@query(
    "p13_quantile_split",
    "SELECT store_id, CASE WHEN date - DATE '1970-01-01' <= (SELECT quantile_cont((date - DATE '1970-01-01')::DOUBLE, 0.8) "
    "FROM curated) THEN 'train' ELSE 'test' END AS side, "
    "count(*) AS rows, min(date) AS first, max(date) AS last FROM curated GROUP BY ALL",
)
def p13(t: Tables) -> DataFrame:
    return side_counts(*features.split_by_date_quantile(t.curated))


@query(
    "p13_position_split",
    "SELECT store_id, CASE WHEN k <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS side, "
    "count(*) AS rows, min(date) AS first, max(date) AS last FROM (SELECT *, "
    "row_number() OVER (ORDER BY store_id, sku, date) AS k, count(*) OVER () AS n FROM curated) GROUP BY ALL",
)
def p13b(t: Tables) -> DataFrame:
    return side_counts(*features.split_by_position(t.curated))


@query(
    "p14_complete_rows",
    "SELECT store_id, sku, count(*) AS rows FROM (SELECT *, lag(qty_sold, 28) OVER "
    "(PARTITION BY store_id, sku ORDER BY date) AS l FROM curated) WHERE l IS NOT NULL GROUP BY ALL",
)
def p14(t: Tables) -> DataFrame:
    rows = features.complete_rows(t.features, features.FEATURES, 10)
    return rows.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("rows"))


PAGE = "id, store_id, sku, date, ts, anomaly_type, severity, score, shelf_qty, qty_sold"
PAGE_COLUMNS = [c.strip() for c in PAGE.split(",")]


@query(
    "p17_filter_anomalies",
    f"SELECT {PAGE} FROM anomalies WHERE NOT acknowledged AND severity = 'high' "
    "AND anomaly_type = 'stockout_risk' AND store_id = 'EUROPE'",
)
def p17(t: Tables) -> DataFrame:
    found = an.filter_anomalies(
        t.anomalies, status="open", severity="HIGH", anomaly_type="Stockout_Risk", store_id="EUROPE"
    )
    return found.select(*PAGE_COLUMNS)


@query(
    "p18_point_lookup",
    "SELECT store_id, sku, date, qty_sold, revenue FROM curated WHERE store_id = 'ASIA' AND sku = 'Brand#7'",
)
def p18(t: Tables) -> DataFrame:
    return reports.export_slice(t.curated, [*KEYS, "qty_sold", "revenue"], "ASIA", "Brand#7")


@query(
    "p19_bands_and_names",
    f"""SELECT p_partkey, {oracle.suffix_name('p_brand', graph.CATEGORIES, 'General', '#')} AS category,
  {oracle.suffix_name('p_name', graph.REGIONS, 'Central', '_')} AS region,
  TRY_CAST(list_extract(string_split(p_brand, '#'), -1) AS INTEGER) AS suffix FROM part""",
)
def p19(t: Tables) -> DataFrame:
    brand = F.col("p_brand")
    return t.table("part").select(
        "p_partkey",
        graph.product_category(brand, "#").alias("category"),
        ids.name_by_suffix(F.col("p_name"), graph.REGIONS, "Central").alias("region"),
        ids.suffix_number(brand, "#").alias("suffix"),
    )


@query("p20_product_price", "SELECT sku, avg_price, price_band FROM products")
def p20(t: Tables) -> DataFrame:
    return graph.products(t.curated, "#").select("sku", "avg_price", "price_band")


@query(
    "p21_route_by_topic",
    "SELECT event_type AS topic, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events "
    "WHERE event_type IN ('purchase', 'view') GROUP BY event_type",
)
def p21(t: Tables) -> DataFrame:
    messages = writers.keyed_json(t.table("events").select("event_id", "event_type"), "event_type")
    routes = landing.route(messages.withColumnRenamed("key", "topic"), ["purchase", "view"])
    out = None
    for topic, mine in routes.items():
        event_id = F.get_json_object("value", "$.event_id").cast("long")
        part = mine.agg(F.count(F.lit(1)).alias("rows"), F.sum(event_id).alias("ids"))
        part = part.select(F.lit(topic).alias("topic"), "rows", "ids")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "p22_event_day",
    "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '2030-01-02' WHEN event_id % 10 = 1 THEN 'soon' "
    "ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events",
)
def p22(t: Tables) -> DataFrame:
    """Some events without a time, which means now, and some whose time is no date."""
    now, key = F.lit("2030-01-02 03:04:05").cast("timestamp"), F.col("event_id") % 10
    ts = F.when(key == 1, "soon").when(key > 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.table("events").select("event_id", dates.event_day(ts, now).alias("day"))


@query(
    "p23_open_alerts",
    f"SELECT id, store_id, sku, date FROM ({ACKED_SQL}) WHERE NOT acked",
)
def p23(t: Tables) -> DataFrame:
    state = an.with_acknowledgements(t.anomalies, t.acks)
    return an.filter_anomalies(state, status="open").select("id", *KEYS)


@query(
    "p24_nonzero_mape",
    f"SELECT sku, {r('''coalesce(avg(CASE WHEN qty_sold > 0 THEN abs((qty_sold - baseline_pred) / qty_sold) END)
      * 100.0, 0.0)''', 4)} AS mape FROM naive GROUP BY sku",
)
def p24(t: Tables) -> DataFrame:
    out = evaluate.error_metrics(t.naive, "qty_sold", {"b": "baseline_pred"}, ["sku"])
    return rounded(out.select("sku", F.col("b_mape").alias("mape")), 4, "mape")


# --- J: joins -------------------------------------------------------------------


@query(
    "j1_sales_shelf_outer",
    f"SELECT store_id, sku, date, qty_sold, {r('avg_price', 4)} AS avg_price, avg_shelf_qty FROM daily FULL JOIN "
    "shelf s USING (store_id, sku, date)",
)
def j1(t: Tables) -> DataFrame:
    stocked = curate.daily_shelf(t.iot)
    out = curate.join_daily(curate.daily_sales_filled(t.sales), stocked)
    return rounded(out.select(*KEYS, "qty_sold", "avg_price", "avg_shelf_qty"), 4, "avg_price")


@query(
    "j2_sentiment_lookup",
    "SELECT p_partkey, p_brand AS sku, coalesce(sentiment_score, 0.0) AS sentiment_score FROM part "
    "LEFT JOIN sentiment ON p_brand = sku",
)
def j2(t: Tables) -> DataFrame:
    parts = t.table("part").select("p_partkey", F.col("p_brand").alias("sku"))
    return curate.with_sentiment(parts, t.sentiment).select("p_partkey", "sku", "sentiment_score")


@query(
    "j3_dense_curated",
    "SELECT store_id, sku, date, qty_sold, revenue, avg_price, avg_shelf_qty, sentiment_score, "
    "graph_co_stock_flag, graph_substitute_available FROM curated",
)
def j3(t: Tables) -> DataFrame:
    return curate.curate(t.sales, t.iot, t.sentiment)


@query(
    "j4_known_windows",
    "SELECT c.store_id, c.sku, c.date, EXISTS (SELECT 1 FROM truth w WHERE w.store_id = c.store_id "
    "AND w.sku = c.sku AND c.date BETWEEN w.start_date AND w.end_date) AS in_window FROM curated c",
)
def j4(t: Tables) -> DataFrame:
    return an.in_known_window(t.curated.select(*KEYS), t.truth)


@query(
    "j5_scenario_coverage",
    "SELECT w.store_id, w.sku, w.start_date, w.end_date, w.type, count(a.date) AS detections, "
    "count(a.date) > 0 AS found FROM truth w LEFT JOIN anomalies a ON a.store_id = w.store_id AND a.sku = w.sku "
    "AND a.anomaly_type = w.type AND a.date BETWEEN w.start_date AND w.end_date GROUP BY ALL",
)
def j5(t: Tables) -> DataFrame:
    return an.scenario_coverage(t.anomalies, t.truth)


SUBS = f"src, dst, category, {r('similarity_score', 6)} AS similarity_score"


@query("j6_substitute_pairs", f"SELECT {SUBS} FROM substitutes")
def j6(t: Tables) -> DataFrame:
    return rounded(t.substitutes, 6, "similarity_score")


@query(
    "j6_part_substitutes",
    """SELECT p_brand AS brand, count(*) AS pairs FROM (
  SELECT a.p_brand FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_partkey < b.p_partkey
    AND abs(a.p_retailprice - b.p_retailprice) <= 0.35::DOUBLE * a.p_retailprice) GROUP BY p_brand""",
)
def j6b(t: Tables) -> DataFrame:
    """The pair search over the whole part table, by type."""
    parts = t.table("part")
    nodes = parts.select(
        F.col("p_partkey").alias("sku"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("avg_price"),
    )
    pairs = graph.substitutes(nodes).groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.join(parts, F.col("src") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("brand"))
        .agg(F.sum("n").alias("pairs"))
    )


@query("j7_neighbours", "SELECT src, dst FROM neighbours")
def j7(t: Tables) -> DataFrame:
    return graph.neighbours(t.substitutes)


@query(
    "j8_category_peers",
    f"SELECT store_id, sku, date, {r('graph_co_stock_freq', 6)} AS graph_co_stock_freq, "
    f"graph_substitute_available::DOUBLE AS graph_substitute_available FROM ({graph_sql('category_peers')})",
)
def j8(t: Tables) -> DataFrame:
    out = graph.point_in_time_features(t.curated, groups=t.categories)
    columns = ["graph_co_stock_freq", "graph_substitute_available"]
    return rounded(out.select(*KEYS, *columns), 6, "graph_co_stock_freq")


@query(
    "j9_substitute_available",
    f"SELECT store_id, sku, date, graph_substitute_available::DOUBLE AS graph_substitute_available "
    f"FROM ({graph_sql('neighbours')})",
)
def j9(t: Tables) -> DataFrame:
    out = graph.with_substitute_available(t.curated, t.neighbours)
    return out.select(*KEYS, "graph_substitute_available")


@query(
    "j10_co_stock_frequency",
    f"SELECT store_id, sku, {r('max(graph_co_stock_freq)', 6)} AS graph_co_stock_freq "
    f"FROM ({graph_sql('neighbours')}) GROUP BY ALL",
)
def j10(t: Tables) -> DataFrame:
    return rounded(graph.co_stock_frequency(t.curated, t.neighbours), 6, "graph_co_stock_freq")


SUPPLY_SQL = """SELECT sku, supplier_id FROM (SELECT sku, (row_number() OVER (ORDER BY sku) - 1) % 3 AS k FROM products)
  JOIN (SELECT supplier_id, row_number() OVER (ORDER BY supplier_id) - 1 AS k FROM suppliers) USING (k)"""


@query("j11_supplied_by", SUPPLY_SQL)
def j11(t: Tables) -> DataFrame:
    return graph.supplied_by(t.products, t.suppliers)


@query("j12_match_predictions", "SELECT store_id, sku, date, qty_sold, baseline_pred, champion_pred FROM naive")
def j12(t: Tables) -> DataFrame:
    test = t.naive.select(*KEYS, "qty_sold")
    return evaluate.match_predictions(
        test, t.naive.select(*KEYS, "baseline_pred"), t.naive.select(*KEYS, "champion_pred")
    )


@query(
    "j13_constant_fallback",
    "SELECT store_id, sku, date, qty_sold, 10.0::DOUBLE AS baseline_pred, 10.0::DOUBLE AS champion_pred FROM naive",
)
def j13(t: Tables) -> DataFrame:
    # Predictions moved out of the test window match no day at all.
    test = t.naive.select(*KEYS, "qty_sold")
    moved = t.naive.withColumn("date", F.date_add("date", 1000))
    return evaluate.match_or_default(
        test, moved.select(*KEYS, "baseline_pred"), moved.select(*KEYS, "champion_pred")
    )


@query(
    "j14_category_codes",
    "SELECT sku, dense_rank() OVER (ORDER BY sku) - 1 AS sku_encoded, rows FROM "
    "(SELECT sku, count(*) AS rows FROM curated GROUP BY sku)",
)
def j14(t: Tables) -> DataFrame:
    codes = ordering.dense_index(t.curated, "sku", "sku_encoded")
    return (
        t.curated.join(codes, "sku").groupBy("sku", F.col("sku_encoded").cast("long").alias("sku_encoded"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "j15_days_with_alerts",
    "SELECT c.store_id, c.sku, c.date, coalesce(n, 0) AS open_alerts FROM curated c LEFT JOIN "
    "(SELECT store_id, sku, count(*) AS n FROM anomalies WHERE NOT acknowledged GROUP BY ALL) a "
    "ON a.store_id = c.store_id AND a.sku = c.sku",
)
def j15(t: Tables) -> DataFrame:
    return reports.days_with_open_alerts(t.curated, t.anomalies).select(*KEYS, "open_alerts")


J16_SQL = """WITH o AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey, o_totalprice, 0 AS version FROM orders),
    n AS (SELECT o_orderkey, 0.0::DOUBLE AS o_totalprice, 1 AS version FROM o WHERE o_orderkey % 3 = 0
          UNION ALL SELECT o_orderkey, 1.0, 2 FROM o WHERE o_orderkey % 9 = 0
          UNION ALL SELECT NULL, o_totalprice, o_orderkey::INTEGER FROM orders WHERE o_orderkey < 100)
    SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1
    UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey IS NOT DISTINCT FROM o.o_orderkey)"""


@query("j16_upsert", J16_SQL)
def j16(t: Tables) -> DataFrame:
    """Several new rows of a key, and NULL keys on both sides."""
    old, changed = order_changes(t)
    once = upsert.upsert(old, changed, ["o_orderkey"], "version")
    return upsert.upsert(once, changed, ["o_orderkey"], "version")


def order_changes(t: Tables) -> tuple[DataFrame, DataFrame]:
    orders = t.table("orders").select("o_orderkey", "o_totalprice")
    key = F.col("o_orderkey")
    old = orders.select(F.when(key % 7 != 0, key).alias("o_orderkey"), "o_totalprice", F.lit(0).alias("version"))
    changed = (
        old.filter(key % 3 == 0).select(key, F.lit(0.0).alias("o_totalprice"), F.lit(1).alias("version"))
        .unionByName(old.filter(key % 9 == 0).select(key, F.lit(1.0).alias("o_totalprice"), F.lit(2).alias("version")))
        .unionByName(
            orders.filter(key < 100).select(
                F.lit(None).cast("long").alias("o_orderkey"), "o_totalprice", key.cast("int").alias("version")
            )
        )
    )
    return old, changed


# --- E: aggregations --------------------------------------------------------------


@query(
    "e1_daily_rollup",
    f"SELECT store_id, sku, date, qty_sold, {r('revenue', 2)} AS revenue, {r('avg_price', 4)} AS avg_price FROM daily",
)
def e1(t: Tables) -> DataFrame:
    return rounded(rounded(curate.daily_sales_filled(t.sales), 2, "revenue"), 4, "avg_price")


@query(
    "e1_plain_rollup",
    f"SELECT store_id, sku, ts::DATE AS date, sum(qty_sold)::BIGINT AS qty_sold, "
    f"{r('sum(qty_sold * price)', 2)} AS revenue, {r('sum(price)::DOUBLE / count(price)', 4)} AS avg_price "
    "FROM sales_raw WHERE price IS NOT NULL GROUP BY ALL",
)
def e1b(t: Tables) -> DataFrame:
    out = curate.daily_sales(t.sales.filter(F.col("price").isNotNull()))
    return rounded(rounded(out, 2, "revenue"), 4, "avg_price")


@query("e2_daily_shelf", "SELECT store_id, sku, date, avg_shelf_qty FROM shelf")
def e2(t: Tables) -> DataFrame:
    return curate.daily_shelf(t.iot)


@query(
    "e3_sku_stats",
    f"SELECT sku, sum(qty_sold)::BIGINT AS total_qty, {r('sum(revenue)', 2)} AS total_rev, "
    f"{r('avg(avg_shelf_qty)', 4)} AS avg_shelf, {r('avg(sentiment_score)', 4)} AS avg_sentiment "
    "FROM curated GROUP BY sku",
)
def e3(t: Tables) -> DataFrame:
    return rounded(rounded(graph.sku_stats(t.curated), 2, "total_rev"), 4, "avg_shelf", "avg_sentiment")


@query(
    "e4_store_sku_stats",
    f"SELECT store_id, sku, {r('avg(qty_sold)', 6)} AS avg_daily_qty, {r('sum(revenue)', 2)} AS total_revenue "
    "FROM curated GROUP BY ALL",
)
def e4(t: Tables) -> DataFrame:
    return rounded(rounded(graph.sold_at(t.curated).drop("active"), 2, "total_revenue"), 6, "avg_daily_qty")


@query("e5_members", "SELECT DISTINCT sku FROM curated ORDER BY sku")
def e5(t: Tables) -> DataFrame:
    return reports.members(t.curated, "sku")


@query(
    "e6_profile",
    "SELECT count(*) AS total_rows, count(DISTINCT store_id) AS stores_count, count(DISTINCT sku) AS skus_count, "
    "min(date) AS date_start, max(date) AS date_end, (max(date) - min(date) + 1)::INTEGER AS history_days FROM curated",
)
def e6(t: Tables) -> DataFrame:
    return normalize.dataset_profile(t.curated)


@query(
    "e7_null_rates",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0 END) AS null_rate FROM sales_raw"
        for c in contracts.SALES.names
    ),
)
def e7(t: Tables) -> DataFrame:
    return quality.null_rates(t.sales)


@query(
    "e8_conditional_counts",
    "SELECT count(*) AS total, count(*) FILTER (NOT acked) AS open_count, count(*) FILTER (acked) AS acknowledged_count "
    f"FROM ({ACKED_SQL})",
)
def e8(t: Tables) -> DataFrame:
    return an.anomaly_totals(an.with_acknowledgements(t.anomalies, t.acks))


@query(
    "e9_value_counts",
    "SELECT 'anomaly_type' AS field, anomaly_type AS value, count(*) AS rows FROM anomalies GROUP BY ALL "
    "UNION ALL SELECT 'severity', severity, count(*) FROM anomalies GROUP BY ALL",
)
def e9(t: Tables) -> DataFrame:
    return an.anomaly_counts(t.anomalies)


@query(
    "e10_active_days",
    "SELECT a.store_id, a.sku, a.active_days, d.store_days FROM "
    "(SELECT store_id, sku, count(DISTINCT date) AS active_days FROM curated WHERE qty_sold > 0 GROUP BY ALL) a "
    "JOIN (SELECT store_id, count(DISTINCT date) AS store_days FROM curated GROUP BY ALL) d USING (store_id)",
)
def e10(t: Tables) -> DataFrame:
    return graph.active_days(t.curated)


@query(
    "e11_sentiment_by_sku",
    f"SELECT sku, coalesce({r('avg(score)', 4)}, 0.0) AS sentiment_score FROM default_scores GROUP BY sku",
)
def e11(t: Tables) -> DataFrame:
    return sentiment.sentiment_by_sku(t.reviews)


def error_sql(pred: str, name: str) -> str:
    e = f"(qty_sold - {pred})"
    return (
        f"{r(f'avg(abs({e}))', 4)} AS {name}_mae, {r(f'sqrt(avg({e} * {e}))', 4)} AS {name}_rmse, "
        + r(f"coalesce(avg(CASE WHEN qty_sold > 0 THEN abs({e} / qty_sold) END) * 100.0, 0.0)", 4)
        + f" AS {name}_mape"
    )


METRICS = [f"{m}_{k}" for m in ("baseline", "champion") for k in ("mae", "rmse", "mape")]
BOTH = f"{error_sql('baseline_pred', 'baseline')}, {error_sql('champion_pred', 'champion')}"


@query("e12_error_metrics", f"SELECT {BOTH} FROM naive")
def e12(t: Tables) -> DataFrame:
    models = {"baseline": "baseline_pred", "champion": "champion_pred"}
    return rounded(evaluate.error_metrics(t.naive, "qty_sold", models), 4, *METRICS)


@query(
    "e13_sku_scoreboard",
    f"SELECT *, CASE WHEN champion_mape <= baseline_mape THEN 'champion' ELSE 'baseline' END AS winner "
    f"FROM (SELECT sku, {BOTH} FROM naive GROUP BY sku)",
)
def e13(t: Tables) -> DataFrame:
    return rounded(evaluate.sku_scoreboard(t.naive), 4, *METRICS)


@query("e14_daily_totals", "SELECT date, sum(qty_sold)::BIGINT AS qty_sold FROM curated GROUP BY date")
def e14(t: Tables) -> DataFrame:
    return reports.daily_totals(t.curated)


FORECAST_SUMS = ", ".join(f"{r(f'sum({c})', 1)} AS {c}" for c in ("forecast_qty", "lower_ci", "upper_ci"))


@query("e14_forecast_totals", f"SELECT date, {FORECAST_SUMS} FROM mean_forecast GROUP BY date")
def e14b(t: Tables) -> DataFrame:
    return rounded(reports.forecast_totals(t.forecasts), 1, "forecast_qty", "lower_ci", "upper_ci")


@query(
    "e15_kpi_totals",
    f"SELECT sum(qty_sold)::BIGINT AS total_units, {r('sum(revenue)', 2)} AS total_revenue, "
    f"(SELECT {r('sum(forecast_qty)', 1)} FROM mean_forecast) AS forecast_units, "
    f"{r('CASE WHEN sum(qty_sold) > 0 THEN sum(revenue) / sum(qty_sold) ELSE 185.0 END', 4)} AS unit_price FROM curated",
)
def e15(t: Tables) -> DataFrame:
    out = reports.kpi_totals(t.curated, t.forecasts)
    return rounded(rounded(rounded(out, 2, "total_revenue"), 1, "forecast_units"), 4, "unit_price")


@query(
    "e16_series_kpis",
    f"""SELECT c.store_id, c.sku, c.mean_demand, c.last_shelf, c.total_revenue, f.horizon_forecast FROM
  (SELECT store_id, sku, {r('avg(qty_sold)', 4)} AS mean_demand, arg_max(avg_shelf_qty, date) AS last_shelf,
    {r('sum(revenue)', 2)} AS total_revenue FROM curated GROUP BY ALL) c LEFT JOIN
  (SELECT store_id, sku, {r('sum(forecast_qty)', 1)} AS horizon_forecast FROM mean_forecast GROUP BY ALL) f
  USING (store_id, sku)""",
)
def e16(t: Tables) -> DataFrame:
    out = reports.series_kpis(t.curated, t.forecasts)
    return rounded(rounded(rounded(out, 4, "mean_demand"), 2, "total_revenue"), 1, "horizon_forecast")


@query(
    "e17_latest_known",
    """SELECT store_id, sku, max(date) AS date, arg_max(anomaly_type, date) AS anomaly_type,
  arg_max(score, date) AS score, arg_max(avg_shelf_qty, date) AS avg_shelf_qty FROM
  (SELECT c.store_id, c.sku, c.date, c.avg_shelf_qty, a.anomaly_type, a.score FROM curated c
    LEFT JOIN anomalies a ON a.store_id = c.store_id AND a.sku = c.sku AND a.date = c.date) GROUP BY ALL""",
)
def e17(t: Tables) -> DataFrame:
    return an.latest_known(with_found(t).select(*KEYS, "anomaly_type", "score", "avg_shelf_qty"))


def with_found(t: Tables) -> DataFrame:
    """Curated days with the anomaly found on them, if any."""
    found = t.anomalies.select(*KEYS, "anomaly_type", "score")
    return t.curated.select(*KEYS, "avg_shelf_qty").join(found, KEYS, "left")


WAPE_SQL = """CASE WHEN sum(qty_sold) > 0 THEN 1.0 - sum(abs(qty_sold - coalesce(f.forecast_qty, 0.0)))
  / sum(qty_sold) ELSE 1.0 END"""


@query(
    "e18_bi_measures",
    f"""SELECT {r('sum(revenue)', 2)} AS total_revenue, sum(qty_sold)::BIGINT AS total_units,
  (SELECT {r('sum(forecast_qty)', 1)} FROM mean_forecast) AS projected_demand,
  (SELECT count(*) FROM anomalies WHERE anomaly_type = 'stockout_risk' AND NOT acknowledged) AS open_stockout_alerts,
  {r(WAPE_SQL, 6)} AS wape_accuracy
FROM curated c LEFT JOIN (SELECT store_id, sku, date - 14 AS date, forecast_qty FROM mean_forecast) f
  USING (store_id, sku, date)""",
)
def e18(t: Tables) -> DataFrame:
    # Forecasts are moved back by their horizon so that they meet actual days.
    past = t.forecasts.withColumn("date", F.date_sub("date", 14))
    out = reports.bi_measures(t.curated, past, t.anomalies)
    return rounded(rounded(rounded(out, 2, "total_revenue"), 1, "projected_demand"), 6, "wape_accuracy")


@query(
    "e19_fill_value",
    f"SELECT sku, {r('rolling_mean', 6)} AS fill, count(*) AS rows FROM demand "
    "WHERE date < (SELECT min(date) + 3 FROM curated) GROUP BY ALL",
)
def e19(t: Tables) -> DataFrame:
    """Days without enough past take the mean of all days."""
    first = t.curated.agg(F.date_add(F.min("date"), 3).alias("d")).scalar()
    early = an.with_demand_scores(t.curated).filter(F.col("date") < first)
    return early.groupBy("sku", round_even(F.col("rolling_mean"), 6).alias("fill")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "e20_residual_sigma",
    f"SELECT store_id, sku, {r('stddev_pop(qty_sold - champion_pred)', 4)} AS sigma FROM naive GROUP BY ALL",
)
def e20(t: Tables) -> DataFrame:
    return rounded(baseline.residual_sigma(t.naive, "qty_sold", "champion_pred"), 4, "sigma")


@query(
    "e21_graph_summary",
    f"""SELECT (SELECT count(*) FROM products) AS products, (SELECT count(*) FROM stores) AS stores,
  (SELECT count(*) FROM suppliers) AS suppliers,
  (SELECT count(*) FROM (SELECT DISTINCT store_id, sku FROM curated)) AS sold_at,
  (SELECT 2 * count(*) FROM substitutes) AS substitutes, (SELECT count(*) FROM ({SUPPLY_SQL})) AS supplied_by""",
)
def e21(t: Tables) -> DataFrame:
    return graph.graph_summary(
        t.products, t.stores, t.suppliers, graph.sold_at(t.curated), t.substitutes,
        graph.supplied_by(t.products, t.suppliers),
    )


@query(
    "e22_enrichment_means",
    f"SELECT count(*) AS rows, {r('avg(graph_co_stock_freq)', 6)} AS mean_co_stock_freq, "
    f"{r('avg(graph_substitute_available)', 6)} AS substitute_available_rate FROM ({graph_sql('neighbours')})",
)
def e22(t: Tables) -> DataFrame:
    out = reports.enrichment_summary(graph.point_in_time_features(t.curated, t.neighbours))
    return rounded(out, 6, "mean_co_stock_freq", "substitute_available_rate")


@query(
    "e23_landing_counts",
    "SELECT 'sales' AS stream, count(*) AS landed, count(DISTINCT ts::DATE) AS partitions FROM sales_raw UNION ALL "
    "SELECT 'events', count(*), count(DISTINCT ts::DATE) FROM events",
)
def e23(t: Tables) -> DataFrame:
    out = quality.landing_counts(
        {"sales": dates.with_event_date(t.sales), "events": dates.with_event_date(t.table("events"))}
    )
    return out


@query(
    "e23_observed_counts",
    "SELECT 'events' AS stream, count(*) FILTER (event_id % 10 <> 0) AS landed, "
    "count(DISTINCT ts::DATE) FILTER (event_id % 10 <> 0) AS partitions, count(*) FILTER (event_id % 10 = 0) AS aside FROM events",
)
def e23_observed(t: Tables) -> DataFrame:
    """Counts that the landing writes made themselves; every tenth event has no day."""
    land = landing.Landing(stage_path(t.spark, "observed"), {"events": EVENTS})
    events = event_rows(t).withColumn("ts", F.when(F.col("event_id") % 10 == 0, "soon").otherwise(F.col("ts")))
    for k in range(2):
        land.land(events.filter(F.col("event_id") % 2 == k), "events", k)
        land.land(events.filter(F.col("event_id") % 2 == k), "events", k)  # again, as after a lost driver
    return land.counts(t.spark)


@query(
    "e24_date_quantile",
    f"SELECT store_id, {r("quantile_cont((date - DATE '1970-01-01')::DOUBLE, 0.8)", 4)} AS day "
    "FROM daily GROUP BY store_id",
)
def e24(t: Tables) -> DataFrame:
    daily = curate.daily_sales_filled(t.sales)
    out = daily.groupBy("store_id").agg(F.percentile(F.unix_date("date"), 0.8).alias("day"))
    return rounded(out, 4, "day")


@query(
    "e25_scenario_recall",
    """SELECT count(*) AS scenarios, count(*) FILTER (n > 0) AS found, count(*) FILTER (n > 0) * 100.0::DOUBLE / count(*) AS recall_pct
FROM (SELECT w.store_id, w.sku, w.type, count(a.date) AS n FROM truth w LEFT JOIN anomalies a
  ON a.store_id = w.store_id AND a.sku = w.sku AND a.anomaly_type = w.type
  AND a.date BETWEEN w.start_date AND w.end_date GROUP BY ALL)""",
)
def e25(t: Tables) -> DataFrame:
    return an.scenario_recall(t.anomalies, t.truth)


# --- F: windows -------------------------------------------------------------------


@query(
    "f1_fill_prices",
    "SELECT store_id, sku, ts, qty_sold, price::DOUBLE AS price, channel FROM filled",
)
def f1(t: Tables) -> DataFrame:
    out = fill.fill_prices(curate.drop_unsold(t.sales))
    return out.withColumn("price", F.col("price").cast("double"))


@query("f2_carry_price", "SELECT store_id, sku, date, avg_price FROM curated")
def f2(t: Tables) -> DataFrame:
    daily = stage(curate.daily_sales_filled(t.sales), "daily-sales")
    return curate.densify(daily).select(*KEYS, "avg_price")


LAG_SQL = ", ".join(
    f"lag(qty_sold, {k}) OVER (PARTITION BY store_id, sku ORDER BY date) AS qty_lag_{k}" for k in features.LAGS
)
ROLL_SQL = ", ".join(
    f"{r(f'CASE WHEN n{w} >= 1 THEN s{w} / n{w} END', 4)} AS rolling_mean_{w}, "
    f"{r(f'coalesce(CASE WHEN n{w} >= 2 THEN {oracle.std(w)} END, 0.0)', 4)} AS rolling_std_{w}"
    for w in features.WINDOWS
)
ROLLED = ", ".join(oracle.rolling(w) for w in features.WINDOWS)
ROLLING_NAMES = [f"rolling_{s}_{w}" for w in features.WINDOWS for s in ("mean", "std")]


@query("f3_lags", f"SELECT store_id, sku, date, {LAG_SQL} FROM curated")
def f3(t: Tables) -> DataFrame:
    return features.with_lags(t.curated.select(*KEYS, "qty_sold")).drop("qty_sold")


def rolling_sql(stat: str) -> str:
    names = ", ".join(f"rolling_{stat}_{w}" for w in features.WINDOWS)
    return f"SELECT store_id, sku, date, {names} FROM (SELECT store_id, sku, date, {ROLL_SQL} FROM (SELECT *, {ROLLED} FROM curated))"


def rolling(t: Tables, stat: str) -> DataFrame:
    names = [f"rolling_{stat}_{w}" for w in features.WINDOWS]
    out = features.with_rolling(t.curated.select(*KEYS, "qty_sold"))
    return rounded(out.select(*KEYS, *names), 4, *names)


@query("f4_rolling_mean", rolling_sql("mean"))
def f4(t: Tables) -> DataFrame:
    return rolling(t, "mean")


def sample_std_sql(value: str) -> str:
    """By the engine's own deviation over the frame, not by the operator's formula."""
    columns = ", ".join(
        r(f"coalesce(stddev_samp({value}) OVER ({oracle.SERIES_WINDOW} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0.0)", 4)
        + f" AS rolling_std_{w}"
        for w in features.WINDOWS
    )
    return f"SELECT store_id, sku, date, {columns} FROM curated"


@query("f5_rolling_std", sample_std_sql("qty_sold"))
def f5(t: Tables) -> DataFrame:
    return rolling(t, "std")


@query("f5_large_values", sample_std_sql("(30000000 + qty_sold % 3)::DOUBLE"))
def f5_large(t: Tables) -> DataFrame:
    """Small spreads of large quantities."""
    names = [f"rolling_std_{w}" for w in features.WINDOWS]
    large = t.curated.select(*KEYS, (F.lit(30_000_000) + F.col("qty_sold") % 3).cast("int").alias("qty_sold"))
    return rounded(features.with_rolling(large).select(*KEYS, *names), 4, *names)


@query(
    "f6_demand_window",
    f"SELECT store_id, sku, date, {r('rolling_mean', 4)} AS rolling_mean, {r('rolling_std', 4)} AS rolling_std FROM demand",
)
def f6(t: Tables) -> DataFrame:
    names = ["rolling_mean", "rolling_std"]
    return rounded(an.with_demand_scores(t.curated).select(*KEYS, *names), 4, *names)


@query("f7_z_score", f"SELECT store_id, sku, date, {r('z_score', 4)} AS z_score FROM demand")
def f7(t: Tables) -> DataFrame:
    return rounded(an.with_demand_scores(t.curated).select(*KEYS, "z_score"), 4, "z_score")


@query("f8_previous_shelf", "SELECT store_id, sku, date, prev AS prev_day_shelf FROM prev_shelf")
def f8(t: Tables) -> DataFrame:
    return graph.with_previous_shelf(t.curated).select(*KEYS, "prev_day_shelf")


@query(
    "f9_latest_rows",
    "SELECT store_id, sku, date, qty_sold, avg_shelf_qty FROM curated WHERE date = (SELECT max(date) FROM curated)",
)
def f9(t: Tables) -> DataFrame:
    return features.latest_rows(t.curated.select(*KEYS, "qty_sold", "avg_shelf_qty"))


@query(
    "f10_recent_history",
    """SELECT store_id, sku, (28 - k)::INTEGER AS slot, qty_sold::DOUBLE AS qty FROM
  (SELECT *, row_number() OVER (PARTITION BY store_id, sku ORDER BY date DESC) AS k FROM curated) WHERE k <= 28""",
)
def f10(t: Tables) -> DataFrame:
    return features.recent_history(t.curated).select(*SERIES, F.posexplode("history").alias("slot", "qty"))


@query("f11_sequential_ids", "SELECT id, store_id, sku, date FROM anomalies")
def f11(t: Tables) -> DataFrame:
    return an.detect_anomalies(t.curated).select("id", *KEYS)


@query(
    "f12_dense_index",
    "SELECT p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS idx FROM (SELECT DISTINCT p_name FROM part)",
)
def f12(t: Tables) -> DataFrame:
    out = ordering.dense_index(t.table("part"), "p_name", "idx")
    return out.withColumn("idx", F.col("idx").cast("long"))


@query(
    "f13_store_share",
    f"SELECT store_id, sum(qty_sold)::BIGINT AS qty_sold, "
    f"{r('sum(qty_sold)::DOUBLE / (SELECT sum(qty_sold) FROM curated)', 6)} AS share FROM curated GROUP BY store_id",
)
def f13(t: Tables) -> DataFrame:
    return rounded(reports.store_share(t.curated), 6, "share")


# --- G: sorts and limits ------------------------------------------------------------


@query(
    "g1_position",
    "SELECT store_id, sku, date, row_number() OVER (ORDER BY store_id, sku, date) - 1 AS position FROM curated",
)
def g1(t: Tables) -> DataFrame:
    return reports.numbered(t.curated.select(*KEYS))


@query(
    "g2_page",
    f"SELECT {PAGE} FROM anomalies ORDER BY length(id), id LIMIT 250",
)
def g2(t: Tables) -> DataFrame:
    return an.list_anomalies(t.anomalies, limit=250)[1].select(*PAGE_COLUMNS)


SERVED = """SELECT * FROM mean_forecast WHERE store_id = 'AMERICA' AND sku = 'Brand#10' ORDER BY date LIMIT 10"""


@query("g3_first_days", SERVED)
def g3(t: Tables) -> DataFrame:
    return forecast.serve_forecast(t.forecasts, "AMERICA", "Brand#10", 10)


@query(
    "g4_first_events",
    "SELECT ts, event_id, event_type FROM (SELECT ts, event_id, event_type FROM events "
    "ORDER BY ts, event_id, event_type LIMIT 500)",
)
def g4(t: Tables) -> DataFrame:
    return reports.first_events(t.table("events").select("ts", "event_id", "event_type"), 500)


@query(
    "g6_preview",
    "SELECT store_id, sku, date, qty_sold, revenue, avg_price FROM curated ORDER BY store_id, sku, date LIMIT 100",
)
def g6(t: Tables) -> DataFrame:
    return reports.preview(t.curated).select(*KEYS, "qty_sold", "revenue", "avg_price")


# --- H: set operations ----------------------------------------------------------------


@query(
    "h1_union_distinct",
    "SELECT store_id, sku, ts, qty_sold, price::DOUBLE AS price, channel FROM "
    "(SELECT * FROM sales_raw UNION SELECT * FROM sales_raw WHERE channel = 'online')",
)
def h1(t: Tables) -> DataFrame:
    out = landing.merge_rows(t.sales, t.sales.filter("channel = 'online'"))
    return out.withColumn("price", F.col("price").cast("double"))


@query("h2_all_series_forecast", "SELECT * FROM mean_forecast")
def h2(t: Tables) -> DataFrame:
    return baseline.mean_forecast(t.curated)


@query("h3_series", "SELECT DISTINCT s.store_id, k.sku FROM daily s, (SELECT DISTINCT sku FROM daily) k")
def h3(t: Tables) -> DataFrame:
    return curate.series_of(stage(curate.daily_sales_filled(t.sales), "daily-sales"))


@query(
    "h5_token_intersection",
    f"""SELECT doc_id, len(list_intersect(list_distinct(regexp_split_to_array(lower(text), '{oracle.SPACES}')),
  {oracle.words(('the', 'and', 'le', 'die', 'best'))}))::INTEGER AS hits FROM documents""",
)
def h5(t: Tables) -> DataFrame:
    listed = F.array(*[F.lit(w) for w in ("the", "and", "le", "die", "best")])
    return t.table("documents").select(
        "doc_id", F.size(F.array_intersect(tokens(F.col("text")), listed)).alias("hits")
    )


# --- I: scalar functions ----------------------------------------------------------------


@query(
    "i1_text_shaping",
    "SELECT doc_id, length(lower(trim(text)))::INTEGER AS chars, substr(trim(text), 1, 512) AS head FROM documents",
)
def i1(t: Tables) -> DataFrame:
    text = F.trim("text")
    return t.table("documents").select(
        "doc_id", F.length(F.lower(text)).alias("chars"), truncate(text).alias("head")
    )


@query(
    "i2_tokens",
    f"""SELECT doc_id, len(list_distinct(list_filter(regexp_split_to_array(lower(text), '{oracle.SPACES}'),
  lambda x: x <> '')))::INTEGER AS words FROM documents""",
)
def i2(t: Tables) -> DataFrame:
    words = F.filter(F.array_distinct(tokens(F.col("text"))), lambda x: x != "")
    return t.table("documents").select("doc_id", F.size(words).alias("words"))


@query(
    "i3_lexicon_score",
    f"""SELECT doc_id, {r(oracle.lexicon(oracle.TEST_POSITIVE, oracle.TEST_NEGATIVE), 6)} AS score FROM (SELECT doc_id,
  list_distinct(regexp_split_to_array(lower(text), '{oracle.SPACES}')) AS toks FROM documents)""",
)
def i3(t: Tables) -> DataFrame:
    score = lexicon_score(F.col("text"), oracle.TEST_POSITIVE, oracle.TEST_NEGATIVE)
    return t.table("documents").select("doc_id", round_even(score, 6).alias("score"))


@query(
    "i4_date_prefix",
    "SELECT o_orderkey, substr(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 1, 10) AS day, "
    "split_part(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), ' ', 1) AS first FROM orders",
)
def i4(t: Tables) -> DataFrame:
    ts = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.table("orders").select(
        "o_orderkey", dates.event_day(ts).alias("day"), F.substring_index(ts, " ", 1).alias("first")
    )


@query(
    "i5_id_suffix",
    "SELECT c_custkey, TRY_CAST(list_extract(string_split(c_name, '#'), -1) AS INTEGER) AS suffix, "
    "CASE WHEN contains(c_mktsegment, '_') THEN -1 END::INTEGER AS none FROM customer",
)
def i5(t: Tables) -> DataFrame:
    name = F.col("c_name")
    suffix = F.when(F.contains(name, F.lit("#")), ids.suffix_number(name, "#")).otherwise(
        name.try_cast("int")
    )
    return t.table("customer").select(
        "c_custkey", suffix.alias("suffix"), ids.suffix_number(F.col("c_mktsegment")).alias("none")
    )


@query(
    "i7_templated_ids",
    "SELECT o_orderkey, 'ANOM_' || CASE WHEN o_orderkey + 1 < 10000 THEN lpad((o_orderkey + 1)::VARCHAR, 4, '0') "
    "ELSE (o_orderkey + 1)::VARCHAR END AS anomaly, 'STOCKOUT_' || o_orderstatus || '_' || o_orderpriority || '_' || "
    "strftime(o_orderdate, '%Y-%m-%d') AS stockout FROM orders",
)
def i7(t: Tables) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey",
        ids.anomaly_id(F.col("o_orderkey")).alias("anomaly"),
        ids.stockout_id(F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderdate")).alias("stockout"),
    )


@query(
    "i8_descriptions",
    f"""SELECT a.id, CASE a.anomaly_type
  WHEN 'stockout_risk' THEN 'Only ' || a.shelf_qty::DOUBLE || ' units left on the shelf against an expected demand of '
    || printf('%.1f', {r('d.rolling_mean', 1)}) || '. Restock.'
  WHEN 'demand_spike' THEN a.qty_sold || ' units sold, z-score ' || printf('%.2f', {r('d.z_score', 2)})
    || ' over a rolling mean of ' || printf('%.1f', {r('d.rolling_mean', 1)}) || '.'
  ELSE 'Shelf reading stays at ' || a.shelf_qty::DOUBLE || ' although ' || a.qty_sold || ' units sold. Check the sensor.' END AS description
FROM anomalies a JOIN demand d ON d.store_id = a.store_id AND d.sku = a.sku AND d.date = a.date""",
)
def i8(t: Tables) -> DataFrame:
    return t.anomalies.select("id", "description")


@query(
    "i9_format_inr",
    """SELECT o_orderkey, CASE WHEN cents >= 10000000 THEN '₹' || printf('%.2f', cents / 10000000) || ' Cr'
  WHEN cents >= 100000 THEN '₹' || printf('%.2f', cents / 100000) || ' Lakhs'
  ELSE '₹' || format('{:,}', round_even(cents, 0)::BIGINT) END AS inr
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) % 100000
  ELSE floor(o_totalprice / 1000) * 100000 END AS cents FROM orders)""",
)
def i9(t: Tables) -> DataFrame:
    total = F.col("o_totalprice")
    amount = F.when(F.col("o_orderkey") % 3 == 0, F.floor(total) % 100000).otherwise(
        F.floor(total / 1000) * 100000
    ).cast("double")
    return t.table("orders").select("o_orderkey", money.format_inr(amount).alias("inr"))


@query(
    "i10_calendar",
    "SELECT o_orderkey, (isodow(o_orderdate) - 1)::INTEGER AS dayofweek, "
    "(isodow(o_orderdate) >= 6)::INTEGER AS is_weekend, month(o_orderdate)::INTEGER AS month, "
    "day(o_orderdate)::INTEGER AS day FROM orders",
)
def i10(t: Tables) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return features.with_calendar(orders).drop("date")


@query(
    "i11_date_arithmetic",
    "SELECT event_id, (ts::DATE + 28)::DATE AS later, (ts::DATE - DATE '2024-01-01')::INTEGER AS days FROM events",
)
def i11(t: Tables) -> DataFrame:
    day = F.to_date("ts")
    first = F.lit("2024-01-01").cast("date")
    return t.table("events").select(
        "event_id", F.date_add(day, 28).alias("later"), F.datediff(day, first).alias("days")
    )


@query(
    "i12_lenient_parse",
    "SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE value::VARCHAR END AS DOUBLE) AS number, "
    "TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'no date' ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS day FROM events",
)
def i12(t: Tables) -> DataFrame:
    number = F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("value").cast("string"))
    day = F.when(F.col("event_id") % 5 == 0, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return t.table("events").select(
        "event_id", dates.lenient_number(number).alias("number"),
        F.to_date(dates.lenient_timestamp(day)).alias("day"),
    )


@query(
    "i13_clamps",
    "SELECT c_custkey, greatest(c_acctbal, 0.0) AS floored, least(greatest(c_acctbal / 1000, 0.0), 1.0) AS clipped, "
    "sqrt(abs(c_acctbal)) AS root, ((c_custkey - 700) % 7 + 7) % 7 AS slot FROM customer",
)
def i13(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.table("customer").select(
        "c_custkey",
        at_least_zero(balance).alias("floored"),
        unit_interval(balance / 1000).alias("clipped"),
        F.sqrt(F.abs(balance)).alias("root"),
        F.pmod(F.col("c_custkey") - 700, F.lit(7)).alias("slot"),
    )


@query(
    "i14_round_even",
    ", ".join([f"SELECT l_orderkey, l_linenumber, {r('l_extendedprice / 8', 2)} AS a", r("l_discount * 5", 1) + " AS b"])
    + " FROM lineitem",
)
def i14(t: Tables) -> DataFrame:
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        round_even(F.col("l_extendedprice") / 8, 2).alias("a"),
        round_even(F.col("l_discount") * 5, 1).alias("b"),
    )


@query(
    "i15_json",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def i15(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "k long")
    return t.table("events").select("event_id", parsed["k"].alias("k"))


@query(
    "i16_missing_cells",
    "SELECT store_id, sku, ts, coalesce(qty_sold, 0)::INTEGER AS qty_sold, coalesce(price::DOUBLE, 10.0) AS price, "
    "qty_sold IS NOT NULL AND price IS NOT NULL AS complete FROM sales_raw",
)
def i16(t: Tables) -> DataFrame:
    return t.sales.select(
        "store_id", "sku", "ts",
        F.coalesce("qty_sold", F.lit(0)).alias("qty_sold"),
        F.coalesce(F.col("price").cast("double"), F.lit(fill.DEFAULT_PRICE)).alias("price"),
        (F.col("qty_sold").isNotNull() & F.col("price").isNotNull()).alias("complete"),
    )


HISTORY_SQL = """SELECT store_id, sku, list(qty_sold::DOUBLE ORDER BY date) AS h FROM (SELECT *,
  row_number() OVER (PARTITION BY store_id, sku ORDER BY date DESC) AS k FROM curated) WHERE k <= 28 GROUP BY ALL"""
TAILS = [*[f"qty_lag_{k}" for k in features.LAGS], *ROLLING_NAMES]


@query(
    "i17_history_features",
    "SELECT store_id, sku, "
    + ", ".join(f"h[{29 - k}] AS qty_lag_{k}" for k in features.LAGS)
    + ", "
    + ", ".join(
        f"{r(f'list_avg(h[{29 - w}:28])', 4)} AS rolling_mean_{w}, "
        f"{r(f'list_stddev_pop(h[{29 - w}:28])', 4)} AS rolling_std_{w}"
        for w in features.WINDOWS
    )
    + f" FROM ({HISTORY_SQL})",
)
def i17(t: Tables) -> DataFrame:
    state = features.recent_history(t.curated)
    out = forecast.with_history_features(state, F.lit("2001-11-05").cast("date"))
    return rounded(out.select(*SERIES, *TAILS), 4, *ROLLING_NAMES)


# --- K: models and statistics ---------------------------------------------------------


@query(
    "k1_features",
    f"""SELECT store_id, sku, date, dense_rank() OVER (ORDER BY store_id) - 1 AS store_encoded,
  dense_rank() OVER (ORDER BY sku) - 1 AS sku_encoded, (isodow(date) - 1)::INTEGER AS dayofweek,
  (isodow(date) >= 6)::INTEGER AS is_weekend, month(date)::INTEGER AS month, day(date)::INTEGER AS day,
  avg_shelf_qty, sentiment_score, {LAG_SQL}, {ROLL_SQL} FROM (SELECT *, {ROLLED} FROM curated)""",
)
def k1(t: Tables) -> DataFrame:
    out = features.build_features(t.curated).select(*KEYS, *features.FEATURES)
    out = out.withColumns({c: F.col(c).cast("long") for c in ("store_encoded", "sku_encoded")})
    return rounded(out, 4, *ROLLING_NAMES)


@query("k2_model_predictions")
def k2(t: Tables) -> DataFrame:
    model, columns, valid = t.model
    return forecast.predict(model, valid, columns).select(*KEYS, "qty_sold", "prediction")


@query("k3_validation_errors")
def k3(t: Tables) -> DataFrame:
    model, columns, valid = t.model
    scored = forecast.predict(model, valid, columns)
    return evaluate.error_metrics(scored, "qty_sold", {"validation": "prediction"})


@query("k4_recursive_forecast")
def k4(t: Tables) -> DataFrame:
    model, columns, _ = t.model
    sigma = k3(t).first()["validation_rmse"]
    return forecast.recursive_forecast(model, t.features, columns, sigma)


@query(
    "k5_interval",
    f"SELECT l_orderkey, l_linenumber, l_quantity, "
    f"greatest({r('l_quantity - 1.28::DOUBLE * (l_tax * 100)', 1)}, 0.0) AS lower_ci, "
    f"greatest({r('l_quantity + 1.28::DOUBLE * (l_tax * 100)', 1)}, 0.0) AS upper_ci FROM lineitem",
)
def k5(t: Tables) -> DataFrame:
    # Any quantity with any deviation will do to check the interval rule.
    lower, upper = interval_bounds(F.col("l_quantity"), F.col("l_tax") * 100)
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", lower.alias("lower_ci"), upper.alias("upper_ci")
    )


ENRICHED_SQL = f"""SELECT c.date, c.qty_sold, c.revenue, c.avg_shelf_qty, c.sentiment_score,
  {r('g.graph_co_stock_freq', 6)} AS graph_co_stock_freq, g.graph_substitute_available AS graph_substitute_available
  FROM curated c JOIN ({graph_sql('neighbours')}) g ON g.store_id = c.store_id AND g.sku = c.sku AND g.date = c.date"""


def ks_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, date > (SELECT max(date) - 28 FROM curated) AS cur FROM enriched"
        for c in drift.MONITORED
    )
    long = f"WITH enriched AS ({ENRICHED_SQL}) {long}"
    return f"""SELECT feature, n_ref AS ref_rows, n_cur AS cur_rows, {r("max(abs(cr / n_ref - cc / n_cur))", 6)} AS statistic
FROM (SELECT feature, value, sum(ref) OVER w AS cr, sum(cur) OVER w AS cc,
    (sum(ref) OVER (PARTITION BY feature))::BIGINT AS n_ref, (sum(cur) OVER (PARTITION BY feature))::BIGINT AS n_cur
  FROM (SELECT feature, value, count_if(NOT cur) AS ref, count_if(cur) AS cur FROM ({long}) GROUP BY ALL)
  WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY ALL"""


P_SQL = """CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(2.0 * list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) END"""
LAMBDA_SQL = f"""SELECT *, (nn + 0.12 + 0.11 / nn) * statistic AS lam FROM (SELECT *,
  sqrt(ref_rows * cur_rows / (ref_rows + cur_rows)) AS nn FROM (
    {ks_sql().replace(r("max(abs(cr / n_ref - cc / n_cur))", 6), "max(abs(cr / n_ref - cc / n_cur))")}))"""


@query("f14_ecdf_gap", ks_sql())
def f14(t: Tables) -> DataFrame:
    reference, current = features.split_holdout(t.enriched)
    counts = drift.value_counts(reference, current, drift.MONITORED)
    return rounded(drift.largest_gap(counts, drift.cut_points(t.enriched, drift.MONITORED)), 6, "statistic")


@query(
    "k6_feature_drift",
    f"SELECT feature, {r('statistic', 6)} AS statistic, {r(P_SQL, 6)} AS p_value, {P_SQL} < 0.05 AS drifted "
    f"FROM ({LAMBDA_SQL})",
)
def k6(t: Tables) -> DataFrame:
    out = drift.drift_report(t.enriched)
    return rounded(out.select("feature", "statistic", "p_value", "drifted"), 6, "statistic", "p_value")


@query(
    "k7_drift_verdict",
    f"""SELECT n AS total_columns, d AS number_of_drifted_columns, d::DOUBLE / n AS share_of_drifted_columns,
  CASE WHEN d::DOUBLE / n > 0.5 THEN 'FAIL' WHEN d::DOUBLE / n > 0.2 THEN 'WARN' ELSE 'PASS' END AS verdict
FROM (SELECT count(*) AS n, count(*) FILTER ({P_SQL} < 0.05) AS d FROM ({LAMBDA_SQL}))""",
)
def k7(t: Tables) -> DataFrame:
    return drift.drift_summary(drift.drift_report(t.enriched)).drop("description")


@query("k8_seasonal_baseline")
def k8(t: Tables) -> DataFrame:
    return baseline.baseline_forecast(t.curated)


@query("k9_mean_baseline", "SELECT * FROM mean_forecast")
def k9(t: Tables) -> DataFrame:
    return baseline.mean_forecast(t.curated)


FOUND = f"{PAGE}, acknowledged"


@query("k10_anomalies", f"SELECT {FOUND} FROM anomalies")
def k10(t: Tables) -> DataFrame:
    return an.detect_anomalies(t.curated).drop("description")


@query("k11_backtest")
def k11(t: Tables) -> DataFrame:
    return evaluate.backtest(t.curated, max_rows=TRAIN_ROWS).by_sku


@query("k12_review_scores", f"SELECT sku, review_text, {r('score', 6)} AS score FROM review_scores")
def k12(t: Tables) -> DataFrame:
    return rounded(sentiment.score_reviews(t.reviews, sample_scorer), 6, "score")


STOCKOUT_SQL = """SELECT 'STOCKOUT_' || store_id || '_' || sku || '_' || strftime(date, '%Y-%m-%d') AS id,
  store_id, sku, date, shelf AS shelf_qty, shelf AS stock_level FROM (
  SELECT store_id, sku, max(date) AS date, arg_max(kind, date) AS kind, arg_max(avg_shelf_qty, date) AS shelf FROM
    (SELECT c.store_id, c.sku, c.date, c.avg_shelf_qty, a.anomaly_type AS kind FROM curated c
      LEFT JOIN anomalies a ON a.store_id = c.store_id AND a.sku = c.sku AND a.date = c.date) GROUP BY ALL)
WHERE coalesce(kind, '') NOT IN ('demand_spike', 'sensor_mismatch')
  AND (coalesce(kind, '') = 'stockout_risk' OR shelf <= 0)"""


@query("k13_active_stockouts", STOCKOUT_SQL)
def k13(t: Tables) -> DataFrame:
    return an.active_stockouts(with_found(t)).drop("description")


# --- L: graph ---------------------------------------------------------------------------


@query("l1_products", "SELECT * FROM products")
def l1(t: Tables) -> DataFrame:
    return graph.products(t.curated, "#")


@query("l2_stores", "SELECT * FROM stores")
def l2(t: Tables) -> DataFrame:
    return t.stores


@query(
    "l3_suppliers_supply",
    f"SELECT supplier_id, supplier_name, lead_time_days, count(sku) AS products FROM suppliers LEFT JOIN ({SUPPLY_SQL}) "
    "USING (supplier_id) GROUP BY ALL",
)
def l3(t: Tables) -> DataFrame:
    supply = graph.supplied_by(t.products, t.suppliers)
    return t.suppliers.join(supply, "supplier_id", "left").groupBy(*t.suppliers.columns).agg(
        F.count("sku").alias("products")
    )


@query(
    "l4_sold_at",
    f"SELECT store_id, sku, {r('avg(qty_sold)', 6)} AS avg_daily_qty, {r('sum(revenue)', 2)} AS total_revenue, "
    "true AS active FROM curated GROUP BY store_id, sku",
)
def l4(t: Tables) -> DataFrame:
    return rounded(rounded(graph.sold_at(t.curated), 2, "total_revenue"), 6, "avg_daily_qty")


@query("l5_supplied_by", SUPPLY_SQL)
def l5(t: Tables) -> DataFrame:
    return graph.supplied_by(t.products, t.suppliers)


@query("l6_substitute_edges", f"SELECT {SUBS} FROM substitutes")
def l6(t: Tables) -> DataFrame:
    return rounded(graph.substitutes(t.products), 6, "similarity_score")


@query(
    "l7_unique_nodes",
    "SELECT 'product' AS node, (SELECT count(*) FROM products) AS keys, 0::BIGINT AS duplicate_keys UNION ALL "
    "SELECT 'store', (SELECT count(*) FROM stores), 0 UNION ALL SELECT 'line', (SELECT count(DISTINCT l_orderkey) "
    "FROM lineitem), (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1))",
)
def l7(t: Tables) -> DataFrame:
    nodes = [
        ("product", t.products, "sku"),
        ("store", t.stores, "store_id"),
        ("line", t.table("lineitem"), "l_orderkey"),
    ]
    return graph.unique_node_report(nodes)


@query("l8_idempotent_load", "SELECT * FROM products")
def l8(t: Tables) -> DataFrame:
    once = upsert.upsert(t.products, t.products, ["sku"])
    return upsert.upsert(once, t.products, ["sku"])


@query("l8_bucket_merge", J16_SQL)
def l8_merge(t: Tables) -> DataFrame:
    """The upsert into a stored table, twice: once whole, once in the buckets of every tenth key only."""
    table = versions.VersionedTable(stage_path(t.spark, "orders-table"), ("o_orderkey",), 32)
    old, changed = order_changes(t)
    table.merge(old.filter("o_orderkey IS NOT NULL"))
    # Rows without a key are no rows to merge by it: they come as they are, all of them.
    base, _ = table.record.read(t.spark)
    bare = old.filter("o_orderkey IS NULL")
    parts = table.touched(bare)
    table.replace(table.read(t.spark, base, parts).unionByName(bare), parts, base)
    table.merge(changed, "version")
    table.merge(changed.filter("o_orderkey % 30 = 0"), "version")
    return table.read(t.spark)


@query(
    "l9_point_in_time",
    f"SELECT store_id, sku, date, {r('graph_co_stock_freq', 6)} AS graph_co_stock_freq, "
    f"graph_substitute_available::DOUBLE AS graph_substitute_available FROM ({graph_sql('neighbours', CUTOFF)})",
)
def l9(t: Tables) -> DataFrame:
    out = graph.point_in_time_features(
        t.curated, t.neighbours, cutoff=F.lit(CUTOFF).cast("date")
    )
    columns = ["graph_co_stock_freq", "graph_substitute_available"]
    return rounded(out.select(*KEYS, *columns), 6, "graph_co_stock_freq")


# --- M: quality and read queries ------------------------------------------------------------


def gate_sql() -> str:
    parts = ["SELECT 'min_record_threshold' AS \"check\", '*' AS \"column\", count(*)::DOUBLE AS value, count(*) > 0 AS passed FROM curated"]
    for f in contracts.CURATED.names:
        parts.append(f"SELECT 'schema_completeness', '{f}', 1.0::DOUBLE, true")
    columns = [*contracts.CURATED.names, "avg_price"]
    for c in columns:
        rate = f"avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0 END)"
        parts.append(f"SELECT 'null_rate_tolerance', '{c}', {rate}, {rate} <= 0.05 FROM curated")
    for c in quality.NON_NEGATIVE:
        parts.append(f"SELECT 'non_negative_bounds', '{c}', count_if({c} < 0)::DOUBLE, count_if({c} < 0) = 0 FROM curated")
    return " UNION ALL ".join(parts)


@query("m1_quality_gate", gate_sql())
def m1(t: Tables) -> DataFrame:
    return quality.quality_gate(t.curated)


@query(
    "m1_quality_verdict",
    f"SELECT bool_and(passed) AS passed, count(*) FILTER (NOT passed) AS failed_checks FROM ({gate_sql()})",
)
def m1b(t: Tables) -> DataFrame:
    return quality.quality_verdict(quality.quality_report(t.curated)).drop("violations")


@query(
    "m2_list_anomalies",
    f"SELECT {PAGE} FROM ({ACKED_SQL}) WHERE acked AND sku = 'Brand#3' ORDER BY length(id), id LIMIT 100",
)
def m2(t: Tables) -> DataFrame:
    state = an.with_acknowledgements(t.anomalies, t.acks)
    return an.list_anomalies(state, status="acknowledged", sku="Brand#3")[1].select(*PAGE_COLUMNS)


@query("m3_acknowledge", f"SELECT id, acked AS acknowledged FROM ({ACKED_SQL})")
def m3(t: Tables) -> DataFrame:
    return an.acknowledge(t.anomalies, t.acks).select("id", "acknowledged")


@query(
    "m4_anomaly_stats",
    "SELECT (SELECT count(*) FROM anomalies) AS total, (SELECT count(*) FROM anomalies WHERE NOT acknowledged) "
    "AS open_count, (SELECT count(*) FROM anomalies WHERE acknowledged) AS acknowledged_count, "
    "field, value, rows FROM (SELECT 'anomaly_type' AS field, anomaly_type AS value, count(*) AS rows FROM anomalies "
    "GROUP BY ALL UNION ALL SELECT 'severity', severity, count(*) FROM anomalies GROUP BY ALL)",
)
def m4(t: Tables) -> DataFrame:
    stats = an.anomaly_stats(t.anomalies)
    totals = ["total", "open_count", "acknowledged_count"]
    by_type = stats.select(*totals, F.lit("anomaly_type").alias("field"), F.explode("by_type").alias("value", "rows"))
    by_severity = stats.select(*totals, F.lit("severity").alias("field"), F.explode("by_severity").alias("value", "rows"))
    return by_type.unionByName(by_severity)


@query("m5_serve_forecast", SERVED)
def m5(t: Tables) -> DataFrame:
    table = forecast.first_available(None, t.forecasts)
    return forecast.serve_forecast(table, "AMERICA", "Brand#10", 10)


@query("m6_stores", "SELECT DISTINCT store_id FROM curated")
def m6(t: Tables) -> DataFrame:
    return reports.members(t.curated, "store_id")


@query(
    "m7_refresh",
    "SELECT 'completed' AS status, (SELECT count(*) FROM sales_raw) AS sales_records_ingested, "
    "(SELECT count(*) FROM iot_raw) AS iot_records_ingested, (SELECT count(*) FROM curated) AS curated_records",
)
def m7(t: Tables) -> DataFrame:
    from aislecast.plans.pipeline import refresh

    path = stage_path(t.spark, "refresh")
    database = "refresh_" + path[-12:]
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{path}/db'")
    return refresh(t.spark, t.sales, t.iot, path, database, t.sentiment)


@query(
    "m8_trend",
    f"""SELECT date, 'actual' AS kind, qty_sold, NULL::DOUBLE AS forecast_qty, NULL::DOUBLE AS lower_ci,
  NULL::DOUBLE AS upper_ci FROM (SELECT date, sum(qty_sold)::BIGINT AS qty_sold FROM curated GROUP BY date
    ORDER BY date DESC LIMIT 60)
UNION ALL SELECT date, 'forecast', NULL, {FORECAST_SUMS} FROM mean_forecast GROUP BY date""",
)
def m8(t: Tables) -> DataFrame:
    return rounded(reports.trend(t.curated, t.forecasts), 1, "forecast_qty", "lower_ci", "upper_ci")


@query(
    "m8_recent_days",
    "SELECT store_id, sku, date, qty_sold, avg_shelf_qty FROM curated "
    "WHERE date > (SELECT max(date) - 45 FROM curated)",
)
def m8b(t: Tables) -> DataFrame:
    return reports.recent_days(t.curated, 45).select(*KEYS, "qty_sold", "avg_shelf_qty")


@query("m8_restock_list", f"SELECT * FROM ({STOCKOUT_SQL}) ORDER BY store_id, sku LIMIT 5")
def m8c(t: Tables) -> DataFrame:
    return reports.restock_list(with_found(t), 5).drop("description")


@query(
    "m9_upload_profile",
    f"""SELECT count(*) AS total_rows, count(DISTINCT store_id) AS stores_count, count(DISTINCT sku) AS skus_count,
  min(date) AS date_start, max(date) AS date_end, (max(date) - min(date) + 1)::INTEGER AS history_days FROM (
  SELECT s.store_id, k.sku, d.date FROM (SELECT DISTINCT store_id FROM up) s, (SELECT DISTINCT sku FROM up) k,
    (SELECT unnest(generate_series((SELECT min(date) FROM up), (SELECT max(date) FROM up), INTERVAL 1 DAY))::DATE
      AS date) d)""".replace("FROM up)", f"FROM ({NORMALIZED_SQL}))"),
)
def m9(t: Tables) -> DataFrame:
    from aislecast.plans.pipeline import run_upload

    return run_upload(export(t), max_rows=TRAIN_ROWS).profile


# --- O: documented extras -------------------------------------------------------------------


@query(
    "o1_weekly_trend",
    f"SELECT date_trunc('week', date)::DATE AS period, sum(qty_sold)::BIGINT AS qty_sold, {r('sum(revenue)', 2)} "
    "AS revenue FROM curated GROUP BY 1",
)
def o1(t: Tables) -> DataFrame:
    return rounded(reports.trend_by(t.curated, "week"), 2, "revenue")


@query(
    "o1_monthly_trend",
    f"SELECT date_trunc('month', date)::DATE AS period, sum(qty_sold)::BIGINT AS qty_sold, {r('sum(revenue)', 2)} "
    "AS revenue FROM curated GROUP BY 1",
)
def o1b(t: Tables) -> DataFrame:
    return rounded(reports.trend_by(t.curated, "month"), 2, "revenue")


@query("o2_dedupe_sales", "SELECT store_id, sku, date, qty_sold, revenue, avg_price FROM once_curated")
def o2(t: Tables) -> DataFrame:
    """Online sales arrive twice; curating drops what is repeated."""
    twice = t.sales.unionByName(t.sales.filter("channel = 'online'"))
    return curate.curate(twice, dedupe=True).select(*KEYS, "qty_sold", "revenue", "avg_price")


@query(
    "o3_co_stocked_pairs",
    """SELECT a.sku AS sku_a, b.sku AS sku_b, count(*) AS weeks, count(DISTINCT a.store_id) AS stores FROM tops a JOIN tops b
  ON a.store_id = b.store_id AND a.week = b.week AND a.sku < b.sku GROUP BY ALL""".replace(
        "tops",
        """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id, week ORDER BY qty DESC, sku) AS k FROM
    (SELECT store_id, date_trunc('week', date) AS week, sku, sum(qty_sold) AS qty FROM daily GROUP BY ALL)
    WHERE qty > 0) WHERE k <= 5)""",
    ),
)
def o3(t: Tables) -> DataFrame:
    return graph.top_selling_pairs(curate.daily_sales_filled(t.sales), 5)


@query(
    "o4_category_demand",
    "SELECT p.category, sum(c.qty_sold)::BIGINT AS qty_sold FROM curated c JOIN products p USING (sku) GROUP BY ALL",
)
def o4(t: Tables) -> DataFrame:
    return reports.demand_by_category(t.curated, "#")


@query(
    "o4_stock_status",
    """SELECT CASE WHEN shelf <= 2 THEN 'Stockout risk' WHEN shelf < 5 THEN 'Low stock' ELSE 'In stock' END AS status,
  count(*) AS series FROM (SELECT store_id, sku, arg_max(avg_shelf_qty, date) AS shelf FROM curated GROUP BY ALL)
  GROUP BY ALL""",
)
def o4b(t: Tables) -> DataFrame:
    return reports.stock_status(t.curated)


@query(
    "o4_products_at_risk",
    f"""SELECT store_id, sku, shelf, {r('daily_demand', 4)} AS daily_demand, {r('risk', 2)} AS daily_revenue_at_risk,
  {r('shelf / daily_demand', 4)} AS days_of_cover FROM (SELECT store_id, sku, arg_max(avg_shelf_qty, date) AS shelf,
    avg(qty_sold) AS daily_demand, avg(revenue) AS risk FROM curated WHERE date > (SELECT max(date) - 28 FROM curated)
    GROUP BY ALL) WHERE daily_demand > 0 ORDER BY shelf / daily_demand, store_id, sku LIMIT 10""",
)
def o4c(t: Tables) -> DataFrame:
    out = reports.products_at_risk(t.curated)
    return rounded(rounded(out, 4, "daily_demand", "days_of_cover"), 2, "daily_revenue_at_risk")


@query(
    "o5_inventory_levels",
    f"SELECT store_id, sku, {r('avg(avg_shelf_qty)', 4)} AS avg_shelf_qty, avg(avg_shelf_qty) < 5 AS is_low "
    "FROM curated GROUP BY store_id, sku",
)
def o5(t: Tables) -> DataFrame:
    return rounded(reports.inventory_levels(t.curated), 4, "avg_shelf_qty")


REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "o5_inventory_heatmap",
    "SELECT sku, "
    + ", ".join(f"""{r(f"avg(avg_shelf_qty) FILTER (store_id = '{s}')", 4)} AS "{s}" """ for s in REGION_NAMES)
    + " FROM curated GROUP BY sku",
)
def o5b(t: Tables) -> DataFrame:
    out = reports.inventory_heatmap(t.curated)
    return rounded(out, 4, *(c for c in out.columns if c != "sku"))


@query(
    "o6_detection_precision",
    """SELECT anomaly_type, count(*) AS detections, count(*) FILTER (hit) AS true_detections,
  count(*) FILTER (hit) * 100.0::DOUBLE / count(*) AS precision_pct FROM (SELECT a.anomaly_type, EXISTS (SELECT 1 FROM truth w
    WHERE w.store_id = a.store_id AND w.sku = a.sku AND w.type = a.anomaly_type
    AND a.date BETWEEN w.start_date AND w.end_date) AS hit FROM anomalies a
  WHERE a.anomaly_type IN (SELECT type FROM truth)) GROUP BY ALL""",
)
def o6(t: Tables) -> DataFrame:
    return an.detection_precision(t.anomalies, t.truth)


@query(
    "o7_latest_forecast",
    "SELECT store_id, sku, date, forecast_qty, lower_ci, upper_ci, model_version FROM mean_forecast "
    "WHERE date = (SELECT max(date) FROM mean_forecast)",
)
def o7(t: Tables) -> DataFrame:
    return forecast.latest_forecast(t.forecasts)


# --- S: streaming ----------------------------------------------------------------------------

EVENTS = contracts.T.StructType(
    [
        contracts.T.StructField("event_id", contracts.T.LongType()),
        contracts.T.StructField("ts", contracts.T.StringType()),
        contracts.T.StructField("event_type", contracts.T.StringType()),
        contracts.T.StructField("value", contracts.T.DoubleType()),
    ]
)


@query(
    "s1_stream_landing",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, ts::DATE AS date FROM events",
)
def s1(t: Tables) -> DataFrame:
    """All events replayed twice through file streams; every row lands once."""
    folder = stage_path(t.spark, "stream")
    events = t.table("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type", "value"
    )
    land = landing.Landing(f"{folder}/zone", {"events": EVENTS})
    for _ in range(2):
        writers.write_buffer(events, f"{folder}/buffer", "events")
        source = readers.stream_buffer(
            t.spark, f"{folder}/buffer/events", "*.json", EVENTS, arrays=False, max_files=1000
        )
        landing.drain(source, land.one("events"), f"{folder}/checkpoint")
    return land.read(t.spark, "events")


POS_SQL = """SELECT DISTINCT store_id, sku, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  coalesce(qty_sold, 0)::INTEGER AS qty_sold, coalesce(price::DOUBLE, 0.0) AS price,
  coalesce(channel, 'in-store') AS channel FROM sales_raw"""


@query(
    "s2_routed_landing",
    f"SELECT 'sales_events' AS stream, count(*) AS landed, count(DISTINCT ts[1:10]) AS partitions FROM ({POS_SQL}) "
    "UNION ALL SELECT 'iot_stock_events', count(*), count(DISTINCT day) FROM (SELECT DISTINCT store_id, sku, ts, "
    "ts::DATE AS day, greatest(0, 25 - coalesce(qty_sold, 0)) AS shelf_qty FROM sales_raw)",
)
def s2(t: Tables) -> DataFrame:
    """Sales replayed as both event kinds, routed by topic in one batch."""
    folder = stage_path(t.spark, "routed")
    land = landing.Landing(folder)
    pos = writers.keyed_json(curate.replay_sales(t.sales)).withColumn("topic", F.lit("pos-events"))
    iot = writers.keyed_json(curate.replay_shelf(t.sales)).withColumn("topic", F.lit("iot-stock-events"))
    land.routed()(pos.unionByName(iot), 0)
    return quality.landing_counts({s: land.read(t.spark, s) for s in landing.SCHEMAS})


EVENT_PART = "floor(event_id * 8 / (SELECT max(event_id) + 1 FROM events))"


def array_files(t: Tables) -> tuple[landing.Landing, str]:
    """Events in files of one JSON array each, landed with at most three files a batch, then drained again."""
    folder = stage_path(t.spark, "arrays")
    events = event_rows(t)
    past = events.agg((F.max("event_id") + 1).alias("m")).scalar()
    (
        events.groupBy(F.floor(F.col("event_id") * 8 / past))
        .agg(F.to_json(F.collect_list(F.struct(*events.columns))).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(f"{folder}/buffer/events")
    )
    land = landing.Landing(f"{folder}/zone", {"events": EVENTS})
    for _ in range(2):  # the second run finds nothing new and stops
        source = readers.stream_buffer(t.spark, f"{folder}/buffer/events", "*.txt", EVENTS, max_files=3)
        landing.drain(source, land.one("events"), f"{folder}/checkpoint")
    return land, land.path("events")


@query(
    "a7_buffer_arrays",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, ts::DATE AS date FROM events",
)
def a7(t: Tables) -> DataFrame:
    return array_files(t)[0].read(t.spark, "events")


@query(
    "g5_batch_cap",
    f"SELECT ceil(count(DISTINCT {EVENT_PART}) / 3.0)::BIGINT AS batches, count(*) AS rows FROM events",
)
def g5(t: Tables) -> DataFrame:
    """The cap binds: there are as many batches as files by threes."""
    landed = t.spark.read.parquet(array_files(t)[1])
    return landed.agg(F.countDistinct("batch").alias("batches"), F.count(F.lit(1)).alias("rows"))


@query(
    "s5_idle_stop",
    "SELECT false AS active, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events",
)
def s5(t: Tables) -> DataFrame:
    """A stream that found nothing more has ended and landed every row once."""
    landed = array_files(t)[0].read(t.spark, "events")
    active = F.lit(len(t.spark.streams.active) > 0)
    return landed.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).withColumn("active", active)


@query(
    "s7_quarantine",
    """SELECT event_id, event_id % 10 = 0 AS aside, CASE WHEN event_id % 10 = 0
  THEN strftime(ts, '%d/%m/%Y %H:%M') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts FROM events WHERE event_id % 25 <> 3
UNION ALL SELECT event_id, true, NULL FROM events WHERE event_id % 25 = 3""",
)
def s7_quarantine(t: Tables) -> DataFrame:
    """Broken records and events without a day are kept aside; nothing is lost."""
    land = landing.Landing(stage_path(t.spark, "aside"), {"events": EVENTS})
    key = F.col("event_id")
    other = F.date_format(F.col("ts").cast("timestamp"), "dd/MM/yyyy HH:mm")
    events = event_rows(t).withColumn("ts", F.when(key % 10 == 0, other).otherwise(F.col("ts")))
    whole = F.to_json(F.struct(*events.columns))
    broken = F.concat(F.lit("{"), key.cast("string"))
    messages = events.select(F.when(key % 25 == 3, broken).otherwise(whole).alias("value"))
    land.land(readers.parse_events(messages, EVENTS), "events", 0)
    landed = land.read(t.spark, "events").select(key, F.lit(False).alias("aside"), "ts")
    kept = land.quarantined(t.spark, "events").select(
        F.coalesce(F.get_json_object("value", "$.event_id"), F.substring("value", 2, 20)).cast("long").alias("event_id"),
        F.lit(True).alias("aside"),
        F.get_json_object("value", "$.ts").alias("ts"),
    )
    return landed.unionByName(kept)


def event_rows(t: Tables) -> DataFrame:
    return t.table("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type", "value"
    )


@query(
    "s3_late_events",
    "SELECT ts::DATE AS date, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1",
)
def s3(t: Tables) -> DataFrame:
    """Even ids land first, all ids after them: each day takes its late rows."""
    land = landing.Landing(stage_path(t.spark, "late"), {"events": EVENTS})
    events = event_rows(t)
    land.land(events.filter("event_id % 2 = 0"), "events", 0)
    land.land(events, "events", 1)
    return land.read(t.spark, "events").groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")
    )


@query(
    "s2_compacted_zone",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, ts::DATE AS date FROM events",
)
def s2_compacted(t: Tables) -> DataFrame:
    """Three small batches, rewritten as one folder; then everything comes again and finds itself landed."""
    land = landing.Landing(stage_path(t.spark, "compacted"), {"events": EVENTS}, parts=2)
    events = event_rows(t)
    for k in range(3):
        land.land(events.filter(F.col("event_id") % 3 == k), "events", k)
    land.compact(t.spark, "events", 1 << 40)
    land.expire(t.spark, "events")
    land.land(events, "events", 3)
    return land.read(t.spark, "events")


@query(
    "s3_bounded_lateness",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, CASE WHEN event_id % 2 = 0
  AND date_trunc('second', ts) < (SELECT date_trunc('second', max(ts)) FROM events WHERE event_id % 2 = 1) - INTERVAL 7 DAY
  THEN 'late' ELSE 'landed' END AS state FROM events""",
)
def s3_bounded(t: Tables) -> DataFrame:
    """Odd ids first, then even ones: those more than 7 days behind are kept aside, none is lost."""
    land = landing.Landing(stage_path(t.spark, "bounded"), {"events": EVENTS}, lateness="7 days")
    events = event_rows(t)
    land.land(events.filter("event_id % 2 = 1"), "events", 0)
    land.land(events.filter("event_id % 2 = 0"), "events", 1)
    aside = land.quarantined(t.spark, "events")
    value = F.from_json("value", EVENTS)
    late = aside.select(value.alias("e"), F.col("reason").alias("state")).select("e.*", "state")
    return land.read(t.spark, "events").drop("date").withColumn("state", F.lit("landed")).unionByName(late)


@query(
    "s4_repeated_batch",
    "SELECT event_type, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1",
)
def s4(t: Tables) -> DataFrame:
    """A batch that runs again, as after a lost driver, lands the same rows."""
    land = landing.Landing(stage_path(t.spark, "repeated"), {"events": EVENTS})
    for _ in range(2):
        land.land(event_rows(t), "events", 0)
    return land.read(t.spark, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")
    )


@query(
    "s6_replay",
    """SELECT 'pos' AS kind, store_id AS key, store_id, sku, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, coalesce(qty_sold, 0)::INTEGER AS qty_sold,
  coalesce(price::DOUBLE, 0.0) AS price, coalesce(channel, 'in-store') AS channel, NULL::INTEGER AS shelf_qty, NULL AS sensor_id FROM sales_raw
UNION ALL SELECT 'iot', store_id, store_id, sku, strftime(ts, '%Y-%m-%d %H:%M:%S'), NULL, NULL, NULL,
  greatest(0, 25 - coalesce(qty_sold, 0))::INTEGER, 'SNSR_' || store_id || '_' || sku FROM sales_raw""",
)
def s6(t: Tables) -> DataFrame:
    """Both event kinds of every sale as keyed messages, read back from their JSON."""

    def sent(events: DataFrame, schema, kind: str) -> DataFrame:
        messages = writers.keyed_json(events)
        return messages.select(F.lit(kind).alias("kind"), "key", F.from_json("value", schema).alias("e")).select("kind", "key", "e.*")

    pos = sent(curate.replay_sales(t.sales), contracts.POS_EVENT, "pos")
    return pos.unionByName(sent(curate.replay_shelf(t.sales), contracts.SHELF_EVENT, "iot"), allowMissingColumns=True)


@query(
    "s7_event_contract",
    "SELECT event_id % 10 = 0 AS corrupt, count(*) AS rows FROM events GROUP BY 1",
)
def s7(t: Tables) -> DataFrame:
    """Every tenth message has a text where a number belongs."""
    bad = F.col("event_id") % 10 == 0
    value = F.when(bad, F.lit('{"event_id": "ten"}')).otherwise(
        F.to_json(F.struct("event_id", "event_type", "value"))
    )
    parsed = readers.parse_events(t.table("events").select(value.alias("value")), EVENTS)
    return parsed.groupBy(F.col("_corrupt_record").isNotNull().alias("corrupt")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "s8_refresh_days",
    f"""SELECT store_id, sku, date, qty_sold * CASE WHEN month(date) = 6 THEN 2 ELSE 1 END AS qty_sold,
  {r('revenue * CASE WHEN month(date) = 6 THEN 2 ELSE 1 END', 2)} AS revenue FROM daily
WHERE month(date) IN (5, 6, 7) AND NOT (month(date) = 6 AND (day(date) BETWEEN 10 AND 12 OR day(date) = 20))""",
)
def s8(t: Tables) -> DataFrame:
    """Into a filled table: June doubles, loses three days, and one keeps rows that all lost their quantity.

    July changes too, but is not refreshed.
    """
    path = stage_path(t.spark, "daily-by-date")
    month, day = F.month("date"), F.dayofmonth("date")
    priced = stage(dates.with_event_date(fill.fill_prices(curate.drop_unsold(t.sales))).filter(month.isin(5, 6, 7)), "priced")
    days = [row["date"] for row in priced.select("date").distinct().collect()]
    landing.refresh_days(curate.daily_sales, priced, days, path)
    changed = priced.withColumn("qty_sold", F.col("qty_sold") * F.when(month == 6, 2).when(month == 7, 3).otherwise(1))
    changed = changed.filter(~((month == 6) & day.between(10, 12)))
    changed = changed.withColumn("qty_sold", F.when(~((month == 6) & (day == 20)), F.col("qty_sold")))
    sold = lambda raw: curate.daily_sales(curate.drop_unsold(raw))
    landing.refresh_days(sold, changed, [d for d in days if d.month == 6], path)
    return rounded(t.spark.read.parquet(path).select(*KEYS, "qty_sold", "revenue"), 2, "revenue")


@query(
    "s8_dense_refresh",
    "SELECT store_id, sku, date, qty_sold, revenue, avg_price, avg_shelf_qty FROM late_curated",
)
def s8_dense(t: Tables) -> DataFrame:
    """The stored dense table after late, changed and emptied days: only the touched spans are made anew."""
    old = stage(curate.daily_sales_filled(t.sales), "daily-sales")
    shelf = stage(curate.daily_shelf(t.iot), "daily-shelf")
    table = repair.dense_table(stage_path(t.spark, "dense-table"), 4)
    table.write(curate.densify(old, shelf))
    day, month, late = F.dayofmonth("date"), F.month("date"), F.lit("1997-02-03").cast("date")
    twice = F.when((month == 3) & (day == 5), 2).otherwise(1)
    last = old.agg(F.max("date").alias("d")).scalar()
    new = old.filter((F.col("date") < last) & ~((month == 6) & day.between(10, 12)))
    new = new.withColumns({c: F.col(c) * twice for c in ("qty_sold", "revenue", "avg_price")})
    there = old.filter((F.col("store_id") == "ASIA") & (F.col("date") == late)).select("sku")
    more = old.select("sku").distinct().join(there, "sku", "left_anti").select(
        F.lit("ASIA").alias("store_id"), "sku", late.alias("date"), F.lit(5).cast("long").alias("qty_sold"),
        F.lit(50.0).alias("revenue"), F.lit(7.5).alias("avg_price"),
    )
    new = stage(new.unionByName(more), "daily-sales")
    repair.repair_dense(table, old, new, shelf, shelf)
    return table.read(t.spark).select(*KEYS, "qty_sold", "revenue", "avg_price", "avg_shelf_qty")
