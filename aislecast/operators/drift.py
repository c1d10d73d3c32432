"""Feature drift: two-sample Kolmogorov-Smirnov test per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.operators.features import split_holdout

MONITORED = (
    "qty_sold", "revenue", "avg_shelf_qty", "sentiment_score",
    "graph_co_stock_freq", "graph_substitute_available",
)
CUTS = 255


def monitored_columns(df: DataFrame, wanted: Sequence[str] = MONITORED) -> list[str]:
    return [c for c in wanted if c in df.columns]


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per feature and value on either side, values that are missing left out."""

    def long(df: DataFrame, is_current: bool) -> DataFrame:
        values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return values.unpivot([], list(columns), "feature", "value").withColumn(
            "_current", F.lit(is_current)
        )

    return (
        long(reference, False)
        .unionByName(long(current, True))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(
            F.count_if(~F.col("_current")).alias("ref"),
            F.count_if(F.col("_current")).alias("cur"),
        )
    )


def cut_points(df: DataFrame, columns: Sequence[str], cuts: int = CUTS) -> dict[str, list[float]]:
    """Approximate quantiles per feature: a fixed number of values each.

    They only split the work. Any cut points give the same test result.
    """
    shares = [i / (cuts + 1) for i in range(1, cuts + 1)]
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, 2000).alias(c) for c in columns]
    ).first()
    return {c: sorted(set(row[c] or [])) for c in columns}


def points_below(points: list[float], step: int = 16) -> Column:
    """How many of the sorted points lie below the value: first among every
    sixteenth point, then inside the step."""

    def below(listed: Column) -> Column:
        return F.size(F.filter(listed, lambda p: p < F.col("value")))

    coarse = points[step - 1 :: step]
    steps = below(F.lit(coarse)) if coarse else F.lit(0)
    return steps * step + below(F.slice(F.lit(points), steps * step + 1, step))


def largest_gap(counts: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """The largest distance of the two cumulative shares per feature.

    A running total over all values of a feature would be one task. Values are
    cut into ranges: totals of the ranges run over a few hundred rows, totals
    of the values run inside their range.
    """
    slot = F.lit(0)
    for feature, points in cuts.items():
        if points:
            slot = F.when(F.col("feature") == feature, points_below(points)).otherwise(slot)
    ranged = counts.withColumn("_range", slot)
    before = (
        Window.partitionBy("feature").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy("feature")
    starts = (
        ranged.groupBy("feature", "_range")
        .agg(F.sum("ref").alias("_ref"), F.sum("cur").alias("_cur"))
        .select(
            "feature",
            "_range",
            F.coalesce(F.sum("_ref").over(before), F.lit(0)).alias("_ref_before"),
            F.coalesce(F.sum("_cur").over(before), F.lit(0)).alias("_cur_before"),
            F.sum("_ref").over(whole).alias("ref_rows"),
            F.sum("_cur").over(whole).alias("cur_rows"),
        )
    )
    inside = (
        Window.partitionBy("feature", "_range")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    share_ref = F.try_divide(F.col("_ref_before") + F.sum("ref").over(inside), F.col("ref_rows"))
    share_cur = F.try_divide(F.col("_cur_before") + F.sum("cur").over(inside), F.col("cur_rows"))
    return (
        ranged.join(starts, ["feature", "_range"])
        .withColumn("_gap", F.abs(share_ref - share_cur))
        .groupBy("feature")
        .agg(
            F.first("ref_rows").alias("ref_rows"),
            F.first("cur_rows").alias("cur_rows"),
            F.max("_gap").alias("statistic"),
        )
    )


def p_value(statistic: Column, ref_rows: Column, cur_rows: Column) -> Column:
    """Asymptotic p-value; the series is one to machine precision below 0.2."""
    n = F.sqrt(ref_rows * cur_rows / (ref_rows + cur_rows))
    scaled = (n + 0.12 + F.lit(0.11) / n) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    return F.when(scaled < 0.2, 1.0).otherwise(
        F.least(F.greatest(series * 2.0, F.lit(0.0)), F.lit(1.0))
    )


def feature_drift(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = 0.05
) -> DataFrame:
    """Statistic, p-value and verdict per feature."""
    counts = value_counts(reference, current, columns)
    gaps = largest_gap(counts, cut_points(reference.select(*columns), columns))
    p = p_value(F.col("statistic"), F.col("ref_rows"), F.col("cur_rows"))
    return gaps.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < alpha)


def drift_summary(features: DataFrame, fail: float = 0.5, warn: float = 0.2) -> DataFrame:
    """One row: how many features moved, and the verdict."""
    share = F.col("share_of_drifted_columns")
    verdict = F.when(share > fail, "FAIL").when(share > warn, "WARN").otherwise("PASS")
    advice = (
        F.when(share > fail, "retrain the model")
        .when(share > warn, "recalibrate the model")
        .otherwise("distribution is stable")
    )
    return (
        features.agg(
            F.count(F.lit(1)).alias("total_columns"),
            F.count_if("drifted").alias("number_of_drifted_columns"),
        )
        .withColumn(
            "share_of_drifted_columns",
            F.coalesce(
                F.try_divide("number_of_drifted_columns", "total_columns"), F.lit(0.0)
            ),
        )
        .withColumn("verdict", verdict)
        .withColumn(
            "description",
            F.format_string(
                "%d of %d features moved (%.1f%%): %s.",
                "number_of_drifted_columns", "total_columns", share * 100, advice,
            ),
        )
    )


def drift_report(
    curated: DataFrame, holdout_days: int = 28, columns: Sequence[str] | None = None
) -> DataFrame:
    """Drift of the holdout window against the history before it."""
    reference, current = split_holdout(curated, holdout_days)
    return feature_drift(reference, current, columns or monitored_columns(curated))
