"""Last-wins merge of new rows into a table by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """New rows replace existing rows with the same key; running it twice
    changes nothing.

    Of several new rows of a key the last by ``order`` stays; without an order
    the greatest row, so reruns agree. NULL keys are equal to each other.
    """
    row = F.struct(*new.columns)
    last = (F.max_by(row, order) if order else F.max(row)).alias("_last")
    latest = new.groupBy(*keys).agg(last).select("_last.*")
    taken = latest.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return existing.join(taken, same, "left_anti").unionByName(latest, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty if the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
