"""Arithmetic that shows an overflow instead of wrapping around."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def product_or_null(left: Column, right: Column) -> Column:
    """Product of two 64-bit numbers, NULL where it does not fit."""
    return F.try_multiply(left.cast("bigint"), right.cast("bigint"))


def negated(number: Column) -> Column:
    """Negation in 64 bits, so that the smallest 32-bit number has one too."""
    return -number.cast("bigint")


def row_count() -> Column:
    """Aggregate: number of rows."""
    return F.count(F.lit(1))
