"""Rounding, number formatting and ordered statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(x: Column, digits: int) -> Column:
    """Half to even on the scaled double, as array libraries round."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def plain_number(x: Column) -> Column:
    """Whole numbers without a point, others with up to four decimals; null for null or NaN."""
    whole = F.abs(x - F.rint(x)) < 1e-9
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.4f", round_even(x, 4)), "0+$", ""), r"\.$", "")
    return F.when(x.isNull() | F.isnan(x), F.lit(None)).when(whole, F.rint(x).cast("bigint").cast("string")).otherwise(text)


def fixed4(x: Column) -> Column:
    """Four decimals, for report columns."""
    return F.format_string("%.4f", round_even(x, 4))
