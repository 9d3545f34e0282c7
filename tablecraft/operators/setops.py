"""Stacking tables and set algebra on keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.ordering import row_index

COPIES_PER_ROW = 100_000


def union_common_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    shared = [c for c in a.columns if c in b.columns]
    return a.select(*shared).unionByName(b.select(*shared))


def union_left_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stack with the columns of ``a``; those ``b`` lacks are NULL there."""
    return a.unionByName(b.select(*[c for c in a.columns if c in b.columns]), allowMissingColumns=True)


def union_tagged(parts: dict[str, DataFrame], tag: str = "src") -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(k)) for k, df in parts.items()])


def union_reindexed(parts: list[DataFrame], order: list[str]) -> DataFrame:
    """Stack and number the rows afresh, part after part."""
    tagged = [df.withColumn("_source", F.lit(n)) for n, df in enumerate(parts)]
    return row_index(reduce(DataFrame.unionByName, tagged), ["_source", *order]).drop("_source")


def assert_unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The table itself, or an error that names one repeated key."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"repeated key {repeated[0].asDict()}")
    return df


def keys_symdiff(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().join(b, a.columns, "left_anti").union(b.distinct().join(a, b.columns, "left_anti"))


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times; a large count is first cut in blocks spread over tasks."""
    blocks = df.withColumn("_block", F.explode(F.expr(
        f"sequence(0L, cast(({times} - 1) div {COPIES_PER_ROW} as long))")))
    blocks = blocks.withColumn("_n", F.least(
        F.lit(COPIES_PER_ROW), F.col(times) - F.col("_block") * COPIES_PER_ROW).cast("int"))
    spread = blocks.repartition("_block", *[c for c in df.columns if c != times])
    return spread.withColumn("_copy", F.explode(F.expr("sequence(1, _n)"))).drop("_block", "_n", "_copy", times)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row: one less than the copies of each."""
    extra = df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("_extra")).filter("_extra > 0")
    return repeat_rows(extra, "_extra")
