"""Model features of the dense table, and the time splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislecast.functions.dates import is_weekend, present, weekday
from aislecast.operators.curate import SERIES
from aislecast.operators.ordering import dense_index, global_position

# Lag steps and window lengths in days.
LAGS = (1, 2, 7, 14, 21, 28)
WINDOWS = (7, 14, 28)

# The model's inputs.
FEATURES = [
    "store_encoded", "sku_encoded", "dayofweek", "is_weekend", "month", "day",
    "avg_shelf_qty", "sentiment_score",
    *[f"qty_lag_{k}" for k in LAGS],
    *[f"rolling_{stat}_{w}" for w in WINDOWS for stat in ("mean", "std")],
]
GRAPH_FEATURES = ["graph_co_stock_freq", "graph_substitute_available"]


def with_calendar(df: DataFrame) -> DataFrame:
    date = F.col("date")
    return df.withColumns(
        {
            "dayofweek": weekday(date),
            "is_weekend": is_weekend(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
        }
    )


def with_lags(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    by_day = Window.partitionBy(*SERIES).orderBy("date")
    return df.withColumns({f"qty_lag_{k}": F.lag("qty_sold", k).over(by_day) for k in lags})


def rolling_moments(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Per window: observations, sum and sum of squares of the rows before.

    Running totals make every window a difference of two lagged values, so
    the cost per row does not grow with the window length. The totals are
    decimals, so differences are exact however large the values are; quantities
    that are no whole numbers count with three places. One sort by series and
    day serves all windows.
    """
    by_day = Window.partitionBy(*SERIES).orderBy("date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = isinstance(df.schema["qty_sold"].dataType, T.IntegralType)
    qty = F.col("qty_sold").cast("decimal(18,0)" if whole else "decimal(15,3)")
    totals = df.withColumns(
        {
            "_sum": F.sum(qty).over(so_far),
            "_squares": F.sum(qty * qty).over(so_far),
            "_row": F.row_number().over(by_day),
        }
    )

    def total_before(col: str, back: int) -> Column:
        return F.coalesce(F.lag(col, back).over(by_day), F.lit(0))

    return totals.withColumns(
        {
            f"_{name}_{w}": col
            for w in windows
            for name, col in (
                ("n", F.least(F.col("_row") - 1, F.lit(w)).cast("double")),
                ("s", total_before("_sum", 1) - total_before("_sum", w + 1)),
                ("q", total_before("_squares", 1) - total_before("_squares", w + 1)),
            )
        }
    ).drop("_sum", "_squares", "_row")


def rolling_mean(window: int, min_rows: int = 1) -> Column:
    n, s = F.col(f"_n_{window}"), F.col(f"_s_{window}")
    return F.when(n >= min_rows, s.cast("double") / n)


def rolling_std(window: int, min_rows: int = 1) -> Column:
    """Sample standard deviation; NULL below two rows."""
    n, s, q = (F.col(f"_{c}_{window}") for c in "nsq")
    spread = (n.cast("decimal(10,0)") * q - s * s).cast("double")
    return F.when(n >= max(min_rows, 2), F.sqrt(spread / (n * (n - 1))))


def with_rolling(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    moments = rolling_moments(df, windows)
    cols = {}
    for w in windows:
        cols[f"rolling_mean_{w}"] = rolling_mean(w)
        cols[f"rolling_std_{w}"] = F.coalesce(rolling_std(w), F.lit(0.0))
    return moments.withColumns(cols).select(*df.columns, *cols)


def with_codes(df: DataFrame) -> DataFrame:
    """Store and product as their rank among the sorted distinct values.

    The codes meet on the list of series, and dense rows are joined with that
    alone: by the keys they are stored by, not by one hot store or product.
    """
    series = df.select(*SERIES).distinct()
    codes = series.join(dense_index(series, "store_id", "store_encoded"), "store_id").join(
        dense_index(series, "sku", "sku_encoded"), "sku"
    )
    return df.join(codes, SERIES)


def build_features(curated: DataFrame) -> DataFrame:
    """Calendar, lags, rolling statistics and codes, from one sorted pass."""
    return with_codes(with_rolling(with_lags(with_calendar(curated))))


def feature_columns(df: DataFrame, graph: bool = False) -> list[str]:
    """The model's inputs; graph features only on request and if present."""
    extra = [c for c in GRAPH_FEATURES if graph and c in df.columns]
    return FEATURES + extra


def complete_rows(features: DataFrame, columns: Sequence[str], min_rows: int = 0) -> DataFrame:
    """Rows with every feature; raises if fewer than ``min_rows`` remain."""
    rows = present(features, *columns)
    if min_rows and rows.limit(min_rows).count() < min_rows:
        raise ValueError(f"fewer than {min_rows} complete rows to train on")
    return rows


def holdout_start(df: DataFrame, days: int = 28) -> Column:
    """Last training day, as a scalar."""
    return df.agg(F.date_sub(F.max("date"), days).alias("d")).scalar()


def split_holdout(df: DataFrame, days: int = 28) -> tuple[DataFrame, DataFrame]:
    """Rows up to the last training day, and the rows after it."""
    split = holdout_start(df, days)
    return df.filter(F.col("date") <= split), df.filter(F.col("date") > split)


def split_by_date_quantile(df: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Split at the exact date quantile, for histories shorter than the holdout."""
    day = F.unix_date("date")
    cut = df.agg(F.percentile(day, share).alias("q")).scalar()
    return df.filter(day <= cut), df.filter(day > cut)


def split_by_position(df: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The first share of the rows in (store, product, day) order, and the rest."""
    placed = global_position(df, out="_position")
    cut = df.agg(F.floor(F.count(F.lit(1)) * share).alias("n")).scalar()
    return (
        placed.filter(F.col("_position") < cut).drop("_position"),
        placed.filter(F.col("_position") >= cut).drop("_position"),
    )


def latest_rows(df: DataFrame, order: str = "date") -> DataFrame:
    """The last row of each series."""
    row = F.struct(*[c for c in df.columns if c not in SERIES])
    return df.groupBy(*SERIES).agg(F.max_by(row, order).alias("_last")).select(*SERIES, "_last.*")


def recent_history(df: DataFrame, length: int = 28) -> DataFrame:
    """The last quantities of each series, oldest first, as one array.

    A series shorter than the array is padded in front with its last value.
    The rank is limited inside the window, so no more than ``length`` rows per
    series are ever gathered.
    """
    newest = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    recent = (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= length)
        .groupBy(*SERIES)
        .agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("date", "qty_sold"))),
                lambda x: x["qty_sold"].cast("double"),
            ).alias("_qty")
        )
    )
    pad = F.array_repeat(F.element_at("_qty", -1), F.lit(length) - F.size("_qty"))
    return recent.select(*SERIES, F.concat(pad, "_qty").alias("history"))
