"""Calendar parts, lenient parsing and event dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def weekday(date: Column) -> Column:
    """Monday is 0."""
    return F.weekday(date)


def is_weekend(date: Column) -> Column:
    return F.weekday(date).isin(5, 6).cast("int")


# Date layouts tried after ISO; month first where a date can be read both ways.
DATE_FORMATS = (
    "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "M-d-yyyy",
    "d-M-yyyy",
    "d MMM yyyy",
    "d-MMM-yyyy",
    "MMM d, yyyy",
    "yyyyMMdd",
)


def lenient_timestamp(col: Column, formats: Sequence[str] = ()) -> Column:
    """Parse, or NULL: never an error on bad text. ISO comes first."""
    text = F.trim(col.cast("string"))
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(col.try_cast("timestamp_ntz"), *others)


def lenient_number(col: Column) -> Column:
    """Parse, or NULL: also for the texts of NaN and the infinities."""
    number = F.trim(col.cast("string")).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def event_day(ts_text: Column, now: Column | None = None) -> Column:
    """Day part of an event time given as text; a missing time means now."""
    fallback = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd HH:mm:ss")
    return F.substring(F.coalesce(ts_text, fallback), 1, 10)


def with_event_date(df: DataFrame, ts: str = "ts", out: str = "date") -> DataFrame:
    """Add the calendar day of an event; text times are parsed first."""
    col = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.StringType):
        col = lenient_timestamp(col)
    return df.withColumn(out, F.to_date(col))


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with all the columns present. Plain null tests, unlike ``na.drop``,
    reach the parquet scan and are known to joins above."""
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df
