"""Column profiles, correlations and histograms: one wide aggregate, then long rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tablecraft.operators.aggregate import drop_null_keys
from tablecraft.operators.select import columns_of
from tablecraft.plans.quantiles import percentiles

QUARTERS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _stack(row: DataFrame, structs: list[Column]) -> DataFrame:
    """The structs of a one-row frame as rows."""
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def describe_table(df: DataFrame) -> DataFrame:
    """Per column: type, rows, missing, and for numbers mean, std, min, quartiles, max;
    the number of repeated rows of the table stands beside each."""
    kinds, numeric = dict(df.dtypes), columns_of(df, "numeric")
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"n_{c}") for c in df.columns],
        *[f(c).cast("double").alias(f"{k}_{c}") for c in numeric
          for k, f in (("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max))])

    def one(column: str) -> Column:
        figures = [(F.col(f"{k}_{column}") if column in numeric else F.lit(None).cast("double")).alias(k)
                   for k in ("mean", "std", "min", "max")]
        return F.struct(F.lit(column).alias("column"), F.lit(kinds[column]).alias("dtype"), F.col("_rows").alias("rows"),
                        (F.col("_rows") - F.col(f"n_{column}")).alias("missing"), *figures)

    table = _stack(stats, [one(c) for c in df.columns])
    copies = df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    table = table.withColumn("duplicates", copies.agg(F.coalesce(F.sum("_extra"), F.lit(0))).scalar())
    if not numeric:
        return table.withColumns({q: F.lit(None).cast("double") for q in QUARTERS})
    return table.join(percentiles(_numbers(df, numeric), ["column"], "value", QUARTERS), "column", "left")


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows of numeric columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")


def skew_kurtosis(df: DataFrame, columns: list[str]) -> DataFrame:
    """Skewness and excess kurtosis with small-sample correction, one row per column."""
    row = df.agg(*[f(c).alias(f"{k}_{c}") for c in columns
                   for k, f in (("n", F.count), ("g1", F.skewness), ("g2", F.kurtosis))])

    def one(name: str) -> Column:
        n, g1, g2 = (F.col(f"{k}_{name}") for k in ("n", "g1", "g2"))
        return F.struct(
            F.lit(name).alias("column"),
            (g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
            ((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurt"))

    return _stack(row, [one(c) for c in columns])


def skewed_columns(df: DataFrame, columns: list[str], limit: float = 0.9) -> DataFrame:
    """Columns whose uncorrected skewness is beyond the limit either way."""
    row = df.agg(*[F.skewness(c).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "skew").filter(F.abs("skew") > limit).orderBy(F.desc("skew"))


def high_cardinality_numeric(df: DataFrame, least: int = 120) -> DataFrame:
    """Numeric columns with at least ``least`` different values."""
    values = _numbers(df, columns_of(df, "numeric")).filter("value IS NOT NULL").distinct()
    counts = values.groupBy("column").agg(F.count("*").alias("distinct_values"))
    return counts.filter(F.col("distinct_values") >= least)


def corr_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson r of each ordered pair of columns, over the rows where both are present."""
    names = columns or columns_of(df, "numeric")
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}")
                   for i, (a, b) in enumerate(pairs)])
    both = [(a, b, i) for i, (a, b) in enumerate(pairs)] + [(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    return _stack(row, [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("corr"))
                        for a, b, i in both])


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 1000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def correlation_p_value(r: float, n: int) -> float:
    """Two-sided p-value of Pearson's r under the t distribution with n-2 degrees."""
    if n < 3 or r is None or math.isnan(r):
        return float("nan")
    if abs(r) >= 1.0:
        return 0.0
    a, b, x = (n - 2) / 2.0, 0.5, 1.0 - r * r
    if not r:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(DoubleType())
def _p_values(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([correlation_p_value(x, int(m)) for x, m in zip(r, n)])


def corr_vs_target(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """r, number of complete pairs and p-value of each column against the target."""
    y = F.col(target).cast("double")
    row = df.agg(*[e for i, c in enumerate(columns) for e in (
        F.corr(F.col(c).cast("double"), y).alias(f"r{i}"),
        F.count_if(F.col(c).isNotNull() & y.isNotNull()).alias(f"n{i}"))])
    long = _stack(row, [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("corr"), F.col(f"n{i}").alias("n"))
                        for i, c in enumerate(columns)])
    return long.withColumn("p_value", _p_values("corr", "n")).orderBy(F.desc("corr"))


def top_corr_partners(matrix: DataFrame, k: int) -> DataFrame:
    """From a long correlation matrix: the k-1 strongest other columns of each column."""
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc(F.abs("corr")), "b"))
    return (matrix.filter("a <> b").withColumn("place", place).filter(F.col("place") <= k - 1)
            .select("a", "place", F.col("b").alias("partner"), "corr"))


def target_by_category(df: DataFrame, categories: list[str], target: str) -> DataFrame:
    """Mean target and rows per level of each category column."""
    long = df.select(target, *categories).unpivot([target], categories, "feature", "level")
    return drop_null_keys(long, ["level"]).groupBy("feature", "level").agg(
        F.avg(target).alias("mean_target"), F.count(F.lit(1)).alias("n"))


def group_stats_long(df: DataFrame, categories: list[str], target: str) -> DataFrame:
    """Full description of the target per (category column, level)."""
    long = drop_null_keys(df.select(target, *categories).unpivot([target], categories, "variable", "value"), ["value"])
    keys = ["variable", "value"]
    basic = long.groupBy(*keys).agg(
        F.count(target).alias("count"), F.avg(target).alias("mean"), F.stddev(target).alias("std"),
        F.min(target).alias("min"), F.max(target).alias("max"))
    return basic.join(percentiles(long, keys, target, QUARTERS), keys)


def histogram_counts(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum; the last bin is closed."""
    x = F.col(column).cast("double")
    rows = df.filter(x.isNotNull()).withColumn("_r", df.agg(F.struct(F.min(x).alias("a"), F.max(x).alias("b"))).scalar())
    low, width = F.col("_r.a"), (F.col("_r.b") - F.col("_r.a")) / bins
    at = F.coalesce(F.least(F.floor(F.try_divide(x - low, width)), F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = rows.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
            .join(counts, "bin", "left").fillna(0, ["n"]))
