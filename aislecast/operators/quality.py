"""Quality gate of the curated table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislecast.contracts import CURATED, ContractError, missing_columns, mistyped_columns

NULL_TOLERANCE = 0.05
NON_NEGATIVE = ("qty_sold", "revenue")


def null_rates(df: DataFrame) -> DataFrame:
    """Share of missing values per column, from one pass, in long form."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return rates.unpivot([], df.columns, "column", "null_rate")


def quality_report(
    df: DataFrame,
    schema: T.StructType = CURATED,
    null_tolerance: float = NULL_TOLERANCE,
    non_negative: tuple[str, ...] = NON_NEGATIVE,
) -> DataFrame:
    """One row per check and column: check, column, value, passed.

    Everything is counted in a single pass. Column presence comes from the
    schema and needs no rows.
    """
    bounded = [c for c in non_negative if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"null:{c}") for c in df.columns],
        *[F.count_if(F.col(c) < 0).alias(f"negative:{c}") for c in bounded],
    )
    absent = set(missing_columns(df, schema))

    def check(name: str, column: str, value: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(column).alias("column"),
            F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"),
            F.coalesce(passed, F.lit(True)).alias("passed"),
        )

    checks = [check("min_record_threshold", "*", F.col("rows"), F.col("rows") > 0)]
    for field in schema:
        present = field.name not in absent
        checks.append(
            check("schema_completeness", field.name, F.lit(float(present)), F.lit(present))
        )
    for name in df.columns:
        rate = F.col(f"`null:{name}`")
        checks.append(check("null_rate_tolerance", name, rate, rate <= null_tolerance))
    for name in bounded:
        negatives = F.col(f"`negative:{name}`")
        checks.append(check("non_negative_bounds", name, negatives, negatives == 0))
    return counts.select(F.inline(F.array(*checks)))


def quality_verdict(report: DataFrame) -> DataFrame:
    """One row: all passed, and the failed checks by name."""
    failed = F.when(~F.col("passed"), F.concat_ws(":", "check", "column"))
    return report.agg(
        F.bool_and("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.array_sort(F.collect_list(failed)).alias("violations"),
    )


def as_json(report: DataFrame) -> DataFrame:
    """The report as one JSON document."""
    rows = F.array_sort(F.collect_list(F.struct("check", "column", "value", "passed")))
    return report.agg(
        F.to_json(F.struct(F.bool_and("passed").alias("passed"), rows.alias("checks"))).alias("json")
    )


def quality_gate(df: DataFrame, fail_on_error: bool = False, **rules) -> DataFrame:
    """The report; optionally an error instead of a failed report.

    With ``fail_on_error`` column types count as well.
    """
    report = quality_report(df, **rules)
    if fail_on_error:
        wrong = mistyped_columns(df, rules.get("schema", CURATED))
        failed = [f"{r['check']}:{r['column']}" for r in report.filter("not passed").collect()]
        if wrong or failed:
            raise ContractError(f"failed checks {failed}, wrong types {wrong}")
    return report


def landing_counts(streams: dict[str, DataFrame], date: str = "date") -> DataFrame:
    """Rows and days per landed stream."""
    parts = [
        df.groupBy(date)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.sum("_n").alias("landed"), F.count(F.col(date)).alias("partitions"))
        .select(F.lit(name).alias("stream"), "landed", "partitions")
        for name, df in streams.items()
    ]
    return reduce(DataFrame.unionByName, parts)
