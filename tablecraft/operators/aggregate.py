"""Grouped statistics, filters and transforms with dataframe semantics.

Missing group keys are dropped unless asked for; a sum over nothing is zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.groups import SIZE, join_back, largest_group, with_group_stats
from tablecraft.plans.lineage import materialize
from tablecraft.plans.quantiles import percentiles

PANDAS_GROUP_ROWS = 1_000_000
#: Key types whose values are equal exactly where Spark groups them.
PLAIN_KEYS = ("byte", "short", "integer", "long", "string", "date", "boolean")


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def nansum(value: Column | str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def aggregate_by_column(df: DataFrame, keys: list[str], plan: dict[str, list[str]]) -> DataFrame:
    """``plan``: column -> statistic names; output columns are named column_statistic."""
    table = {"sum": nansum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count,
             "std": F.stddev, "var": F.variance, "nunique": F.count_distinct}
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        *[table[s](c).alias(f"{c}_{s}") for c, stats in plan.items() for s in stats])


def median(df: DataFrame, keys: list[str], value: str, name: str = "median", **limits) -> DataFrame:
    return percentiles(df, keys, value, {name: 0.5}, **limits)


def mean_abs_deviation(df: DataFrame, keys: list[str], value: str, name: str = "mad") -> DataFrame:
    """Mean absolute deviation from the group mean."""
    beside = with_group_stats(df.select(*keys, value), keys, [F.avg(value).alias("_mean")])
    return beside.groupBy(*keys).agg(F.avg(F.abs(F.col(value) - F.col("_mean"))).alias(name))


def group_filter(df: DataFrame, keys: list[str], statistics: list[Column], keep: Column | str) -> DataFrame:
    """All rows of the groups whose statistics satisfy ``keep``."""
    groups = drop_null_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(SIZE), *statistics)
    return join_back(df, materialize(groups.filter(keep).select(*keys, SIZE)), keys, how="inner")


def group_transform(df: DataFrame, keys: list[str], statistics: list[Column],
                    outputs: dict[str, Column], **sizes) -> DataFrame:
    """Per-row expressions over the row and the statistics of its group.

    Covers every split-apply-combine whose function reads a group only through
    aggregates (shares, centering, standardizing, filling).
    """
    beside = with_group_stats(drop_null_keys(df, keys), keys, statistics, **sizes)
    kept = [c for c in df.columns if c not in outputs]
    return beside.select(*kept, *[v.alias(n) for n, v in outputs.items()])


def group_apply(df: DataFrame, keys: list[str], function: Callable, schema: str,
                limit: int = PANDAS_GROUP_ROWS) -> DataFrame:
    """Any pandas function per group; refused when a group is too big for one task.

    Use :func:`group_transform` whenever the function can be written with aggregates.
    """
    rows = drop_null_keys(df, keys)
    biggest = largest_group(rows, keys)
    if biggest > limit:
        raise ValueError(f"largest group has {biggest} rows, more than {limit}; use group_transform")
    if any(rows.schema[k].dataType.typeName() not in PLAIN_KEYS for k in keys) or getattr(getattr(function, "__code__", None), "co_argcount", 0) != 1:
        return rows.groupBy(*keys).applyInPandas(function, schema)
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_by_group(keys, function), schema)


def _by_group(keys: list[str], function: Callable) -> Callable:
    """The function on each group of rows that come sorted by keys: many small groups travel in one batch, and so do their results."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def results(rows: pd.DataFrame, cuts: np.ndarray) -> Iterator[pd.DataFrame]:
            found = [function(rows.iloc[a:b].reset_index(drop=True)) for a, b in zip(cuts[:-1], cuts[1:])]
            found = [f for f in found if len(f)]
            if all(f.dtypes.equals(found[0].dtypes) for f in found[1:]):
                found = [pd.concat(found, ignore_index=True)] if found else []
            yield from found  # results of other types stay apart, so that no number is widened

        def key(rows: pd.DataFrame, at: int) -> tuple:
            return tuple(rows[k].iloc[at] for k in keys)

        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            changed = np.zeros(len(batch) - 1, dtype=bool)
            for k in keys:
                values = batch[k].to_numpy()
                changed |= values[1:] != values[:-1]
            cuts = np.r_[0, np.flatnonzero(changed) + 1, len(batch)]
            if held and key(held[0], 0) == key(batch, 0):  # the group that was open goes on
                if len(cuts) == 2:
                    held.append(batch)
                    continue
                held.append(batch.iloc[:cuts[1]])
                cuts = cuts[1:]
            if held:
                whole = pd.concat(held, ignore_index=True)
                yield from results(whole, np.array([0, len(whole)]))
            yield from results(batch, cuts[:-1])
            held = [batch.iloc[cuts[-2]:]]
        if held:
            whole = pd.concat(held, ignore_index=True)
            yield from results(whole, np.array([0, len(whole)]))

    return run


def group_by_mapping(df: DataFrame, key: str, mapping: dict, name: str, *aggregates: Column) -> DataFrame:
    """Group by what a dictionary says about the key; keys it lacks are dropped."""
    kind = dict(df.dtypes)[key]
    pairs = df.sparkSession.createDataFrame(list(mapping.items()), f"{key} {kind}, {name} string")
    return df.join(pairs, key).groupBy(name).agg(*aggregates)


def group_by_external(df: DataFrame, labels: DataFrame, on: str, label: str, *aggregates: Column) -> DataFrame:
    """Group by a parallel column kept in another table, matched by row key."""
    return drop_null_keys(df.join(labels.select(on, label), on), [label]).groupBy(label).agg(*aggregates)


def group_describe(df: DataFrame, keys: list[str], value: str, **limits) -> DataFrame:
    """count, mean, std, min, quartiles and max per group."""
    rows = drop_null_keys(df, keys)
    basic = rows.groupBy(*keys).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    quarters = percentiles(rows, keys, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, **limits)
    return basic.join(quarters, keys, "left")


def value_counts(df: DataFrame, columns: list[str], normalize: bool = False) -> DataFrame:
    """Frequency of each value (or combination), missing ones left out, most frequent first."""
    rows = drop_null_keys(df, columns)
    counts = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = rows.agg(F.count(F.lit(1))).scalar()
        counts = counts.withColumn("share", F.col("n") / total)
    return counts.orderBy(F.desc("n"), *columns)


def scatter_add(df: DataFrame, at: str, size: int, name: str = "n") -> DataFrame:
    """Add one at each index of a vector of ``size`` zeros; repeated indexes add up."""
    counts = df.groupBy(F.col(at).cast("long").alias(at)).agg(F.count(F.lit(1)).alias(name))
    grid = df.sparkSession.range(size).withColumnRenamed("id", at)
    return grid.join(counts, at, "left").fillna(0, [name])


def group_mode(df: DataFrame, keys: list[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent value per group, the smallest one on ties."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min(F.struct(-F.col("_n"), F.col(value).alias("v")))["v"].alias(name))


def fill_group_mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Fill missing values with the most frequent value of the row's group."""
    modes = group_mode(df, keys, value, "_mode")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(SIZE))
    beside = join_back(df, materialize(sizes.join(modes, keys, "left")), keys)
    return beside.withColumn(value, F.coalesce(value, "_mode")).select(*df.columns)
