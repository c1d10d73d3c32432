"""SQL building blocks: the tables of the registered queries, as named CTEs."""

from __future__ import annotations

import re

from aislecast.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from aislecast.operators.graph import CATEGORIES, REGIONS, SUPPLIERS
from aislecast.sources.views import TEST_NEGATIVE, TEST_POSITIVE


def r(expr: str, digits: int) -> str:
    """Round half to even by scaling, as the Spark side does."""
    scale = float(10**digits)
    return f"(round_even(({expr})::DOUBLE * {scale}::DOUBLE, 0) / {scale}::DOUBLE)"


def words(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def lexicon(positive, negative) -> str:
    pos = f"len(list_intersect(toks, {words(positive)}))"
    neg = f"len(list_intersect(toks, {words(negative)}))"
    return f"CASE WHEN {pos} + {neg} > 0 THEN ({pos} - {neg})::DOUBLE / ({pos} + {neg}) ELSE 0.0 END"


def suffix_name(column: str, names, default: str, delimiter: str) -> str:
    n = len(names)
    number = f"TRY_CAST(list_extract(string_split({column}, '{delimiter}'), -1) AS INTEGER)"
    return (
        f"CASE WHEN contains({column}, '{delimiter}') AND {number} IS NOT NULL "
        f"THEN list_extract({words(names)}, 1 + (({number} % {n}) + {n}) % {n}) ELSE '{default}' END"
    )


SERIES_WINDOW = "PARTITION BY store_id, sku ORDER BY date"


def rolling(window: int) -> str:
    """Observations, sum and sum of squares of the rows before."""
    frame = f"({SERIES_WINDOW} ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)"
    q = "qty_sold::HUGEINT"
    return (
        f"count(*) OVER {frame} ::DOUBLE AS n{window}, "
        f"coalesce(sum({q}) OVER {frame}, 0) AS s{window}, "
        f"coalesce(sum({q} * {q}) OVER {frame}, 0) AS q{window}"
    )


def std(window: int) -> str:
    n, s, q = f"n{window}", f"s{window}", f"q{window}"
    return f"sqrt(({n}::HUGEINT * {q} - {s} * {s})::DOUBLE / ({n} * ({n} - 1)))"


LINES = """
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey"""

CTES: dict[str, str] = {
    "sales_raw": f"""
  SELECT r_name AS store_id, p_brand AS sku, l_shipdate AS ts,
    CASE WHEN l_orderkey % 200 <> 0 THEN l_quantity::INTEGER END AS qty_sold,
    CASE WHEN l_orderkey % 200 <> 1
      THEN {r("l_extendedprice / l_quantity", 2)}::DECIMAL(18, 2) END AS price,
    CASE WHEN l_linestatus = 'O' THEN 'online' ELSE 'in-store' END AS channel {LINES}""",
    "iot_raw": f"""
  SELECT r_name AS store_id, p_brand AS sku, l_shipdate AS ts,
    ((l_orderkey * 7 + l_linenumber * 3) % 41)::INTEGER AS shelf_qty,
    'SNSR_' || r_name || '_' || p_brand AS sensor_id {LINES}""",
    "reviews": """
  SELECT regexp_replace(source, '^src', 'Brand#') AS sku, text AS review_text FROM documents""",
    "review_tokens": f"""
  SELECT sku, review_text, list_distinct(regexp_split_to_array(lower(review_text), '{SPACES}')) AS toks
  FROM reviews""",
    "review_scores": f"""
  SELECT sku, review_text,
    CASE WHEN regexp_matches(review_text, '[^{SPACES[1:-2]}]')
      THEN {lexicon(TEST_POSITIVE, TEST_NEGATIVE)} END AS score
  FROM review_tokens""",
    "default_scores": f"""
  SELECT sku, review_text,
    CASE WHEN regexp_matches(review_text, '[^{SPACES[1:-2]}]')
      THEN {lexicon(POSITIVE_WORDS, NEGATIVE_WORDS)} END AS score
  FROM review_tokens""",
    "sentiment": f"""
  SELECT sku, coalesce({r("avg(score)", 4)}, 0.0) AS sentiment_score FROM review_scores GROUP BY sku""",
    "truth": """
  SELECT * FROM (VALUES
    ('AFRICA', 'Brand#1', DATE '1996-03-01', DATE '1996-06-30', 'stockout_risk'),
    ('ASIA', 'Brand#7', DATE '1998-01-01', DATE '1998-12-31', 'demand_spike'),
    ('EUROPE', 'Brand#13', DATE '2000-05-05', DATE '2000-05-06', 'sensor_mismatch'))
    AS t(store_id, sku, start_date, end_date, type)""",
    "filled": """
  SELECT store_id, sku, ts, qty_sold, channel,
    coalesce(
      last_value(price IGNORE NULLS) OVER (PARTITION BY sku ORDER BY ts, price NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(price IGNORE NULLS) OVER (PARTITION BY sku ORDER BY ts, price NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      10.0::DECIMAL(18, 2))::DECIMAL(18, 2) AS price
  FROM sales_raw WHERE qty_sold IS NOT NULL""",
    "daily": """
  SELECT store_id, sku, ts::DATE AS date, sum(qty_sold)::BIGINT AS qty_sold,
    sum(qty_sold * price)::DOUBLE AS revenue, sum(price)::DOUBLE / count(*) AS avg_price
  FROM filled GROUP BY ALL""",
    "shelf": f"""
  SELECT store_id, sku, ts::DATE AS date, {r("avg(shelf_qty)", 2)} AS avg_shelf_qty
  FROM iot_raw GROUP BY ALL""",
    "grid": """
  SELECT s.store_id, k.sku, d.date FROM (SELECT DISTINCT store_id FROM daily) s
  CROSS JOIN (SELECT DISTINCT sku FROM daily) k
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(date) FROM daily),
    (SELECT max(date) FROM daily), INTERVAL 1 DAY))::DATE AS date) d""",
    "merged": """
  SELECT g.store_id, g.sku, g.date, d.qty_sold, d.revenue, d.avg_price, s.avg_shelf_qty
  FROM grid g LEFT JOIN daily d USING (store_id, sku, date)
  LEFT JOIN shelf s USING (store_id, sku, date)""",
    "curated": f"""
  SELECT m.store_id, m.sku, m.date, coalesce(m.qty_sold, 0)::BIGINT AS qty_sold,
    {r("coalesce(m.revenue, 0.0)", 2)} AS revenue,
    {r('''coalesce(
      last_value(m.avg_price IGNORE NULLS) OVER (PARTITION BY m.sku ORDER BY m.store_id, m.date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(m.avg_price IGNORE NULLS) OVER (PARTITION BY m.sku ORDER BY m.store_id, m.date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 10.0)''', 2)} AS avg_price,
    {r("coalesce(m.avg_shelf_qty, 20.0)", 2)} AS avg_shelf_qty,
    coalesce(t.sentiment_score, 0.0) AS sentiment_score,
    false AS graph_co_stock_flag, false AS graph_substitute_available
  FROM merged m LEFT JOIN sentiment t ON m.sku = t.sku""",
    "moments": f"""
  SELECT store_id, sku, date, qty_sold, avg_shelf_qty, {rolling(14)} FROM curated""",
    "demand": f"""
  SELECT *, (qty_sold - rolling_mean) / rolling_std AS z_score FROM (
    SELECT store_id, sku, date, qty_sold, avg_shelf_qty,
      CASE WHEN n14 >= 3 THEN s14 / n14 ELSE (SELECT avg(qty_sold) FROM curated) END AS rolling_mean,
      CASE WHEN n14 >= 3 AND {std(14)} > 0 THEN {std(14)} ELSE 1.0 END AS rolling_std
    FROM moments)""",
    "anomalies": f"""
  SELECT 'ANOM_' || CASE WHEN rn < 10000 THEN lpad(rn::VARCHAR, 4, '0') ELSE rn::VARCHAR END AS id,
    store_id, sku, date,
    strftime(date, '%Y-%m-%d') || CASE kind WHEN 1 THEN ' 10:00:00' WHEN 2 THEN ' 14:30:00'
      ELSE ' 18:00:00' END AS ts,
    CASE kind WHEN 1 THEN 'stockout_risk' WHEN 2 THEN 'demand_spike' ELSE 'sensor_mismatch' END
      AS anomaly_type,
    CASE kind WHEN 1 THEN CASE WHEN avg_shelf_qty = 0 THEN 'high' ELSE 'medium' END
      WHEN 2 THEN CASE WHEN z_score >= 4 THEN 'high' ELSE 'medium' END ELSE 'low' END AS severity,
    CASE kind WHEN 1 THEN {r("(5.0 - avg_shelf_qty) / 5.0 + greatest(0.0, rolling_mean / 5.0)", 2)}
      WHEN 2 THEN {r("z_score", 2)} ELSE {r("qty_sold / avg_shelf_qty", 2)} END AS score,
    avg_shelf_qty AS shelf_qty, qty_sold, false AS acknowledged
  FROM (SELECT *, row_number() OVER (ORDER BY store_id, sku, date) AS rn FROM (
    SELECT *, CASE WHEN avg_shelf_qty <= 2.0 THEN 1 WHEN z_score >= 3.0 AND qty_sold >= 15 THEN 2
      WHEN qty_sold >= 20 AND avg_shelf_qty >= 35.0 THEN 3 END AS kind FROM demand)
    WHERE kind IS NOT NULL)""",
    "products": f"""
  SELECT sku, {suffix_name("sku", CATEGORIES, "General", "#")} AS category,
    CASE WHEN avg_price < 10 THEN 'Budget' WHEN avg_price < 25 THEN 'Mid-Tier' ELSE 'Premium' END
      AS price_band, avg_price
  FROM (SELECT sku, {r('''CASE WHEN sum(qty_sold) > 0
      THEN sum(revenue::DECIMAL(18, 2))::DOUBLE / sum(qty_sold) ELSE 15.0 END''', 2)} AS avg_price
    FROM curated GROUP BY sku)""",
    "stores": f"""
  SELECT store_id, {suffix_name("store_id", REGIONS, "Central", "_")} AS region,
    CASE WHEN (row_number() OVER (ORDER BY store_id) - 1) % 2 = 0 THEN 'Supercenter'
      ELSE 'Express' END AS format
  FROM (SELECT DISTINCT store_id FROM curated)""",
    "suppliers": "\n  SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}', {c})" for a, b, c in SUPPLIERS)
    + ") AS t(supplier_id, supplier_name, lead_time_days)",
    "substitutes": """
  SELECT a.sku AS src, b.sku AS dst, a.category,
    CASE WHEN a.avg_price <> 0 THEN 1.0 - abs(a.avg_price - b.avg_price) / a.avg_price END
      AS similarity_score
  FROM products a JOIN products b ON a.sku < b.sku AND a.category = b.category
    AND abs(a.avg_price - b.avg_price) <= 0.35::DOUBLE * a.avg_price""",
    "neighbours": """
  SELECT src, dst FROM substitutes UNION SELECT dst, src FROM substitutes""",
    "category_peers": """
  SELECT a.sku AS src, b.sku AS dst FROM products a JOIN products b
    ON a.category = b.category AND a.sku <> b.sku""",
    "prev_shelf": """
  SELECT store_id, sku, date,
    coalesce(lag(avg_shelf_qty) OVER (PARTITION BY store_id, sku ORDER BY date), 0.0) AS prev
  FROM curated""",
    "mean_forecast": f"""
  SELECT store_id, sku, (last_date + i)::DATE AS date, fq AS forecast_qty,
    greatest({r("fq - 1.28::DOUBLE * 2.5::DOUBLE", 1)}, 0.0) AS lower_ci,
    greatest({r("fq + 1.28::DOUBLE * 2.5::DOUBLE", 1)}, 0.0) AS upper_ci,
    'baseline_mean_v1' AS model_version
  FROM (SELECT store_id, sku, max(date) AS last_date, {r("greatest(avg(qty_sold), 0.0)", 1)} AS fq
    FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sku ORDER BY date DESC) AS k
      FROM curated) WHERE k <= 7 GROUP BY store_id, sku),
    (SELECT unnest(range(1, 15))::INTEGER AS i)""",
    "naive": """
  SELECT store_id, sku, date, qty_sold, lag7::DOUBLE AS baseline_pred, s7 / n7 AS champion_pred
  FROM (SELECT store_id, sku, date, qty_sold,
      lag(qty_sold, 7) OVER (PARTITION BY store_id, sku ORDER BY date) AS lag7,
      count(*) OVER w AS n7, sum(qty_sold::DOUBLE) OVER w AS s7
    FROM curated WINDOW w AS (PARTITION BY store_id, sku ORDER BY date
      ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  WHERE lag7 IS NOT NULL AND date > (SELECT max(date) - 28 FROM curated)""",
}

# The roll-up after late and emptied days, and the dense table of it.
CTES["late_daily"] = """
  SELECT store_id, sku, date, qty_sold * f AS qty_sold, revenue * f AS revenue, avg_price * f AS avg_price FROM (
    SELECT *, CASE WHEN month(date) = 3 AND day(date) = 5 THEN 2 ELSE 1 END AS f FROM daily
    WHERE date < (SELECT max(date) FROM daily) AND NOT (month(date) = 6 AND day(date) BETWEEN 10 AND 12))
  UNION ALL SELECT 'ASIA', sku, DATE '1997-02-03', 5, 50.0, 7.5 FROM (SELECT DISTINCT sku FROM daily
    WHERE sku NOT IN (SELECT sku FROM daily WHERE store_id = 'ASIA' AND date = DATE '1997-02-03'))"""
CTES |= {f"late_{name}": re.sub(r"\b(daily|grid|merged)\b", r"late_\1", CTES[name]) for name in ("grid", "merged", "curated")}

# The dense table of sales without repeated rows, and without shelf and reviews.
_ONCE = ("filled", "daily", "grid", "merged", "curated")
CTES["once_sales_raw"] = "SELECT DISTINCT * FROM sales_raw"
CTES |= {f"once_{name}": re.sub(r"\b(sales_raw|filled|daily|grid|merged)\b", r"once_\1", CTES[name]) for name in _ONCE}

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def needed(body: str) -> list[str]:
    """The CTEs a statement uses, directly or through others, in order."""
    todo, seen = [body], set()
    while todo:
        for name in set(_NAMES.findall(todo.pop())) - seen:
            seen.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in seen]


def sql(body: str) -> str:
    parts = [f"{name} AS ({CTES[name]})" for name in needed(body)]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
