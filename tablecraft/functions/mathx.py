"""Arithmetic with floor division, divisor-signed remainder and missing instead of errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(a: Column, b: Column) -> Column:
    """Rounds towards minus infinity; division by zero is missing."""
    return F.floor(F.try_divide(a.cast("double"), b.cast("double")))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor; missing for a zero divisor."""
    return F.when(b != 0, a - b * floor_div(a, b))


def reciprocal(a: Column) -> Column:
    return F.try_divide(F.lit(1.0), a)


def exp2(a: Column) -> Column:
    return F.pow(F.lit(2.0), a)


def sigmoid(a: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-a))


def safe_log(a: Column) -> Column:
    """Natural logarithm, missing where it is undefined."""
    return F.when(a > 0, F.log(a))
