"""Joins on keys of which a few may hold much of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in this many of all rows is hot, so there are fewer hot keys than that.
SHARE = 1000


def join_sized(rows: DataFrame, side: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of rows with a side of one row per key that knows how many rows each key has (column ``size``).

    The hot keys, fewer than ``SHARE`` whatever the table, are broadcast, so their rows stay where they are; the
    others are shuffled, and none of them makes a task large. Null keys match nothing.
    """
    total = side.agg(F.sum(size)).first()[0] or 0
    hot = side.where(F.col(size) * SHARE > total)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(side.where(F.col(size) * SHARE <= total), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)
