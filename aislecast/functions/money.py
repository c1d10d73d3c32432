"""Rupee amounts as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CRORE = 10_000_000
LAKH = 100_000


def format_inr(amount: Column) -> Column:
    sign = F.lit("₹")
    return (
        F.when(amount >= CRORE, F.concat(sign, F.format_string("%.2f Cr", amount / CRORE)))
        .when(amount >= LAKH, F.concat(sign, F.format_string("%.2f Lakhs", amount / LAKH)))
        .otherwise(F.concat(sign, F.format_number(F.rint(amount), 0)))
    )
