"""Dates: parsing mixed texts, offsets and features."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accepted layouts, tried in this order (month before day where unclear)
LAYOUTS = ["d MMMM, yyyy", "d MMMM yyyy", "MMMM d, yyyy", "yyyy-MMM-d", "yyyy-MM-dd", "MM-dd-yyyy",
           "MM/dd/yyyy", "yyyyMMdd"]


def parse_mixed(text: Column) -> Column:
    """Date of a text in one of several layouts, missing if none fits."""
    plain = F.regexp_replace(F.trim(text), r"(?i)(\d)(st|nd|rd|th)\b", "$1")
    plain = F.regexp_replace(plain, r"(?i)\s+of\s+", " ")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(x)) for x in LAYOUTS]).cast("date")


def weekday_name(when: Column) -> Column:
    return F.date_format(when, "EEEE")


def in_days(when: Column, first: str, last: str) -> Column:
    """From the start of the first to the end of the last day; pushes down as a plain range."""
    return (when >= F.lit(first).cast("timestamp_ntz")) & (
        when < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))


def in_year(when: Column, year: int) -> Column:
    return in_days(when, f"{year}-01-01", f"{year}-12-31")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a value that wraps around."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)
