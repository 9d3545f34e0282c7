"""Long and wide forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WIDE = 10_000
ALL = "All"


def pivot_values(df: DataFrame, column: str, limit: int = MAX_WIDE) -> list:
    """Sorted distinct values that may become columns; refused beyond ``limit``."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many for columns")
    return sorted(r[0] for r in found)


def pivot_table(df: DataFrame, index: list[str], column: str, values: list, *aggregates: Column) -> DataFrame:
    rows = df
    for k in [*index, column]:
        rows = rows.filter(F.col(k).isNotNull())
    return rows.groupBy(*index).pivot(column, values).agg(*aggregates)


def pivot_margins(df: DataFrame, index: str, column: str, values: list, aggregate: Column) -> DataFrame:
    """Pivot with an 'All' row and column computed from the rows themselves."""
    rows = df.filter(F.col(index).isNotNull() & F.col(column).isNotNull())
    cube = rows.cube(index, column).agg(
        aggregate.alias("_v"), F.grouping(index).alias("_gi"), F.grouping(column).alias("_gc"))

    def label(name: str, flag: str) -> Column:
        return F.when(F.col(flag) == 1, F.lit(ALL)).otherwise(F.col(name).cast("string")).alias(name)

    named = cube.select(label(index, "_gi"), label(column, "_gc"), "_v")
    return named.groupBy(index).pivot(column, [*[str(v) for v in values], ALL]).agg(F.first("_v"))


def melt_long(df: DataFrame, keys: list[str], values: list[str], name: str = "variable",
              value: str = "value", drop_null: bool = False) -> DataFrame:
    """Columns to rows; with ``drop_null`` this is a stack."""
    long = df.unpivot(keys, values, name, value)
    return long.filter(F.col(value).isNotNull()) if drop_null else long


def reindex_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per wanted key; keys without a row get NULL."""
    return keys.join(df, keys.columns, "left")
