"""Any sales export -> the sales schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislecast.functions.dates import (
    DATE_FORMATS,
    lenient_number,
    lenient_timestamp,
    present,
)


@dataclass(frozen=True)
class Role:
    """How a column is recognised: whole names, then parts of names, then its place."""

    names: tuple[str, ...]
    parts: tuple[str, ...]
    place: int | None = None


# The names and name parts per role.
ROLES = {
    "date": Role(
        ("date", "dt", "timestamp", "ts"),
        ("date", "time", "sold", "day", "created", "order", "timestamp", "ts"),
        0,
    ),
    "sku": Role(
        ("sku", "product_id", "product", "item_id", "item", "code"),
        ("sku", "item", "product", "desc", "code", "name", "title"),
        1,
    ),
    "qty": Role(
        ("qty_sold", "units_sold", "quantity_sold", "qty", "sales"),
        ("qty", "quant", "unit", "vol", "sold", "count", "sales"),
        2,
    ),
    "price": Role(
        ("price", "unit_price", "avg_price", "rate", "cost", "price_inr"),
        ("price", "rate", "cost", "amount", "rev", "total", "val", "inr"),
    ),
    "revenue": Role(
        ("revenue", "total_revenue", "revenue_inr", "gross_revenue", "turnover"),
        ("revenue", "turnover"),
    ),
    "store": Role(
        ("store_id", "store", "location_id", "branch_id"),
        ("store", "branch", "loc", "outlet", "shop", "city"),
    ),
}

BAD_PRICE = 150.0
NO_PRICE = 185.0
NO_STORE = "STORE_001"
CHANNEL = "in_store"
MIN_HISTORY_DAYS = 35


def infer_roles(columns: Sequence[str]) -> dict[str, str | None]:
    """The column that plays each role, judged by the header alone."""
    plain = {c: c.strip().lower() for c in columns}
    found: dict[str, str | None] = {}
    for role, rule in ROLES.items():
        whole = [c for c, low in plain.items() if low in rule.names]
        partial = [c for c, low in plain.items() if any(p in low for p in rule.parts)]
        by_place = []
        if rule.place is not None:
            by_place = [columns[rule.place if rule.place < len(columns) else 0]]
        found[role] = next(iter(whole + partial + by_place), None)
    return found


def normalize_export(
    raw: DataFrame,
    roles: dict[str, str | None] | None = None,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Coerce an export: bad quantities are 0, bad prices a default, bad dates go."""
    role = roles or infer_roles(raw.columns)

    def column(name: str):
        return F.col(f"`{role[name]}`")

    ts = lenient_timestamp(column("date"), date_formats)
    qty = F.coalesce(lenient_number(column("qty")).try_cast("int"), F.lit(0))
    price = (
        F.coalesce(lenient_number(column("price")), F.lit(BAD_PRICE))
        if role["price"]
        else F.lit(NO_PRICE)
    )
    stated = lenient_number(column("revenue")) if role["revenue"] else F.lit(None).cast("double")
    shaped = (
        raw.select(
            F.to_date(ts).alias("date"),
            ts.alias("ts"),
            column("sku").cast("string").alias("sku"),
            qty.alias("qty_sold"),
            price.alias("price"),
            stated.alias("_stated"),
            (column("store").cast("string") if role["store"] else F.lit(NO_STORE)).alias("store_id"),
            F.lit(CHANNEL).alias("channel"),
        )
        .withColumn("revenue", F.coalesce("_stated", F.col("qty_sold") * F.col("price")))
        .drop("_stated")
    )
    return present(shaped, "date", "sku")


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, stores, products, first and last day, days of history."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("store_id").alias("stores_count"),
        F.countDistinct("sku").alias("skus_count"),
        F.min("date").alias("date_start"),
        F.max("date").alias("date_end"),
        (F.datediff(F.max("date"), F.min("date")) + 1).alias("history_days"),
    )


def history_verdict(df: DataFrame, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    """Days of history and whether they suffice for the longest lag."""
    days = df.agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("history_days"))
    return days.withColumn("accepted", F.coalesce(F.col("history_days") >= min_days, F.lit(False)))


class HistoryTooShort(ValueError):
    """Not enough days to build the features."""


def require_history(df: DataFrame, min_days: int = MIN_HISTORY_DAYS) -> DataFrame:
    verdict = history_verdict(df, min_days).first()
    if not verdict["accepted"]:
        raise HistoryTooShort(f"{verdict['history_days']} days of history, {min_days} needed")
    return df
