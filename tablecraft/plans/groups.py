"""Group statistics next to rows, safe when one group holds much of the table.

A window over the key would send a whole group to one task. Here the statistics
are aggregated first (Spark combines on the map side), then joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 500_000
SIZE = "_group_rows"


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """True when the frame has at most ``rows`` rows; stops counting just above."""
    return df.limit(rows + 1).count() <= rows


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows in the biggest group (a partial count per key, no row is moved whole)."""
    if not keys:
        return df.count()
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def join_back(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Put the columns of ``stats`` (one row per key, ``SIZE`` left out) beside each row.

    One join on null-safe keys: adaptive execution broadcasts the statistics if their bytes allow it, and
    else splits the partitions that a large group makes large.
    """
    extra = [c for c in stats.columns if c not in keys and c != SIZE]
    names = {k: f"_key_{k}" for k in keys}
    side = stats.select(*[F.col(k).alias(names[k]) for k in keys], *extra)
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(side[names[k]]) for k in keys])
    return df.join(side, match, how).select(*df.columns, *extra)


def with_group_stats(df: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    """Aggregate per group and put the results beside every row of the group."""
    from tablecraft.plans.lineage import materialize

    stats = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(SIZE), *aggregates))
    return join_back(df, stats, keys)
