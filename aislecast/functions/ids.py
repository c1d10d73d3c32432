"""Identifiers: numeric suffixes and templated ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def suffix_number(ident: Column, delimiter: str = "_") -> Column:
    """The integer after the last delimiter; NULL if there is none."""
    return F.when(
        F.contains(ident, F.lit(delimiter)),
        F.substring_index(ident, delimiter, -1).try_cast("int"),
    )


def name_by_suffix(ident: Column, names: Sequence[str], default: str, delimiter: str = "_") -> Column:
    """Pick a name by suffix modulo the list length, else the default."""
    slot = F.pmod(suffix_number(ident, delimiter), F.lit(len(names)))
    # A chain of equalities, because element_at with a missing index does not
    # reliably give a missing value for constant arrays.
    picked = F.when(slot.isNull(), F.lit(default))
    for i, name in enumerate(names):
        picked = picked.when(slot == i, F.lit(name))
    return picked


def sensor_id(store: Column, sku: Column) -> Column:
    return F.concat_ws("_", F.lit("SNSR"), store, sku)


def anomaly_id(position: Column) -> Column:
    """Ids count from 1 and have four digits or more."""
    return F.format_string("ANOM_%04d", position + 1)


def stockout_id(store: Column, sku: Column, date: Column) -> Column:
    return F.concat_ws("_", F.lit("STOCKOUT"), store, sku, F.date_format(date, "yyyy-MM-dd"))
