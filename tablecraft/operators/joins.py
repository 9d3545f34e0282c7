"""Joins and key alignment with the null, suffix and fill rules of dataframes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.groups import SIZE, join_back
from tablecraft.plans.lineage import materialize


def join_natural(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two tables share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared, how)


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key."""
    other = right.select(*[F.col(c).alias(f"_right_{c}" if c in on else c) for c in right.columns])
    match = reduce(lambda a, b: a & b, [left[c].eqNullSafe(other[f"_right_{c}"]) for c in on])
    joined = left.join(other, match, how)
    keys = [F.coalesce(F.col(c), F.col(f"_right_{c}")).alias(c) for c in on]
    rest = [c for c in left.columns if c not in on] + [c for c in right.columns if c not in on]
    return joined.select(*keys, *rest)


def join_suffixes(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Equi-join; columns named alike on both sides get a suffix."""
    clash = {c for c in left.columns if c in right.columns and c not in on}
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return a.join(b, on, how)


def align_binary(left: DataFrame, right: DataFrame, on: list[str], left_value: str, right_value: str,
                 op: Callable[[Column, Column], Column], name: str,
                 fill: Column | float | None = None) -> DataFrame:
    """Arithmetic over the union of keys; missing if a side lacks the key, unless filled.

    With ``fill`` one missing side takes that value; both missing stays NULL.
    """
    both = join_null_safe(left.select(*on, F.col(left_value).alias("_a")),
                          right.select(*on, F.col(right_value).alias("_b")), on, "full_outer")
    a, b = F.col("_a"), F.col("_b")
    result = op(a, b)
    if fill is not None:
        value = fill if isinstance(fill, Column) else F.lit(fill)
        result = F.when(a.isNotNull() | b.isNotNull(), op(F.coalesce(a, value), F.coalesce(b, value)))
    return both.select(*on, result.alias(name))


def subtract_row(df: DataFrame, reference: DataFrame, columns: list[str]) -> DataFrame:
    """Subtract a one-row table from each row by column name; a name it lacks gives NULL."""
    known = [c for c in columns if c in reference.columns]
    row = reference.select(F.struct(*known)).scalar()
    out = df.withColumn("_row", row)
    return out.select(*[c for c in df.columns if c not in columns],
                      *[(F.col(c) - F.col(f"_row.{c}") if c in known
                         else F.lit(None).cast("double")).alias(c) for c in columns])


def pair_equality(left: DataFrame, right: DataFrame, on: str, name: str = "matches") -> DataFrame:
    """Number of rows on the right with an equal value, per row on the left (NULL matches none).

    The row sums of the all-pairs equality matrix, without listing its pairs.
    """
    counts = right.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias(name))
    sizes = left.groupBy(on).agg(F.count(F.lit(1)).alias(SIZE))
    return join_back(left, materialize(sizes.join(counts, on)), [on]).fillna(0, [name])
