"""Table contracts: schemas and the checks made against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SALES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("qty_sold", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("channel", T.StringType()),
    ]
)

SHELF = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("shelf_qty", T.IntegerType()),
        T.StructField("sensor_id", T.StringType()),
    ]
)

REVIEWS = T.StructType(
    [T.StructField("sku", T.StringType()), T.StructField("review_text", T.StringType())]
)

TRUTH = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("type", T.StringType()),
    ]
)

# Events as they travel on the stream: the time stays text until it is landed.
POS_EVENT = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("qty_sold", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("channel", T.StringType()),
    ]
)

SHELF_EVENT = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("shelf_qty", T.IntegerType()),
        T.StructField("sensor_id", T.StringType()),
    ]
)

CURATED = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("qty_sold", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("avg_shelf_qty", T.DoubleType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("graph_co_stock_flag", T.BooleanType()),
        T.StructField("graph_substitute_available", T.BooleanType()),
    ]
)

FORECAST = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("forecast_qty", T.DoubleType()),
        T.StructField("lower_ci", T.DoubleType()),
        T.StructField("upper_ci", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)


class ContractError(ValueError):
    """A table does not meet its contract."""


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    present = set(df.columns)
    return [f.name for f in schema if f.name not in present]


def mistyped_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    types = {f.name: f.dataType for f in df.schema}
    return [f.name for f in schema if f.name in types and types[f.name] != f.dataType]


def require_columns(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Raise unless every contracted column is there. Reads only the schema."""
    missing = missing_columns(df, schema)
    if missing:
        raise ContractError(f"{table} lacks the columns {missing}")
    return df
