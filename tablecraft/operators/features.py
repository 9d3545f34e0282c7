"""Encoders, scalers, transforms and feature selection by statistics."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions import arrays
from tablecraft.operators.reshape import pivot_values
from tablecraft.plans.groups import SIZE, join_back
from tablecraft.plans.lineage import materialize
from tablecraft.plans.ordering import row_index
from tablecraft.plans.quantiles import percentiles

MAX_FEATURES = 5_000
LAMBDA_RANGE, LAMBDA_STEPS, LAMBDA_ROUNDS, LAMBDA_FINEST = (-2.0, 2.0), 21, 4, 0.00021


# categories

def one_hot(df: DataFrame, columns: list[str], fitted_on: list[DataFrame] | None = None) -> DataFrame:
    """A 0/1 column ``column_level`` per level seen in any of the fitting tables."""
    out = df
    for column in columns:
        seen = reduce(DataFrame.union, [x.select(column) for x in (fitted_on or [df])])
        levels = pivot_values(seen, column)
        out = out.withColumns({f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
                               for v in levels})
    return out.drop(*columns)


def one_hot_sparse(df: DataFrame, column: str, name: str = "onehot") -> tuple[DataFrame, DataFrame]:
    """Any number of levels: the rows with a sparse vector, and the dictionary (level, position).

    The vector, a struct (size, indices, values), has a one at the position of the row's level, in sorted order of the levels, and
    none for a missing value. The dictionary stays a table.
    """
    levels = materialize(row_index(df.select(F.col(column).alias("level")).where("level is not null").distinct(), ["level"], "position"))
    size = levels.count()

    coded = join_back(df, levels.withColumnRenamed("level", column).withColumnRenamed("position", "_position"), [column])
    at = F.filter(F.array(F.col("_position")), lambda p: p.isNotNull())
    vector = F.struct(F.lit(size).alias("size"), at.alias("indices"), F.transform(at, lambda _: F.lit(1.0)).alias("values"))
    return coded.withColumn(name, vector).drop("_position"), levels


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number the levels 0, 1, ... in sorted order; missing stays missing."""
    sizes = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(SIZE))
    return join_back(df, materialize(row_index(sizes, [column], name)), [column])


def binary_encode(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """The level number in binary, lowest bit first, one column per bit."""
    coded = label_encode(df, column, "_code")
    levels = df.select(column).filter(F.col(column).isNotNull()).distinct().count()
    bits = max(1, math.ceil(math.log2(max(levels, 2))))
    return coded.withColumns({f"{prefix}_{b}": F.getbit("_code", F.lit(b)).cast("int") for b in range(bits)}).drop("_code")


def target_encode_oof(df: DataFrame, category: str, target: str, fold: str, name: str,
                      smoothing: float = 0.0) -> DataFrame:
    """Mean target of the category over the other folds, pulled to their overall mean."""
    cells = materialize(df.groupBy(category, fold).agg(
        F.count(F.lit(1)).alias(SIZE), F.count(target).alias("_n"), F.sum(target).alias("_s")))
    per_category = cells.groupBy(category).agg(F.sum("_n").alias("_cn"), F.sum("_s").alias("_cs"))
    per_fold = cells.groupBy(fold).agg(F.sum("_n").alias("_fn"), F.sum("_s").alias("_fs"))
    everything = cells.agg(F.struct(F.sum("_n").alias("n"), F.sum("_s").alias("s"))).scalar()
    rest_n, rest_s = F.col("_cn") - F.col("_n"), F.col("_cs") - F.coalesce("_s", F.lit(0.0))
    prior = F.try_divide(F.col("_all.s") - F.col("_fs"), F.col("_all.n") - F.col("_fn"))
    encoded = (cells.join(per_category, cells[category].eqNullSafe(per_category[category])).drop(per_category[category])
               .join(per_fold, fold).withColumn("_all", everything)
               .withColumn(name, F.coalesce(F.try_divide(rest_s + prior * smoothing, rest_n + smoothing), prior)))
    return join_back(df, materialize(encoded.select(category, fold, SIZE, name)), [category, fold])


def rare_to_other(df: DataFrame, column: str, least: int, other: str = "Other",
                  known: DataFrame | None = None) -> DataFrame:
    """Levels with fewer than ``least`` rows in ``known`` (default: the table) become 'Other'."""
    counts = (known if known is not None else df).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    common = counts.filter(F.col("_n") >= least).select(column, F.col("_n").alias(SIZE), F.lit(True).alias("_common"))
    beside = join_back(df, materialize(common), [column])
    return beside.withColumn(column, F.when(F.col(column).isNull() | F.col("_common"), F.col(column)).otherwise(other)
                             ).drop("_common")


def cut(value: Column, edges: list[float], labels: list[str] | None = None) -> Column:
    """Right-closed bins; a value outside every bin is missing."""
    names = labels or [f"({a}, {b}]" for a, b in zip(edges, edges[1:])]
    out = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], names))):
        out = F.when((value > low) & (value <= high), F.lit(name)).otherwise(out)
    return out


# scaling and transforms

def center_scale(df: DataFrame, columns: list[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation, with the statistics of the fitting table."""
    base = fitted_on if fitted_on is not None else df
    stats = base.agg(F.struct(*[f(c).alias(f"{k}_{c}") for c in columns
                                for k, f in (("m", F.avg), ("s", F.stddev_pop))])).scalar()
    return df.withColumn("_f", stats).withColumns(
        {c: F.try_divide(F.col(c) - F.col(f"_f.m_{c}"), F.col(f"_f.s_{c}")) for c in columns}).drop("_f")


def robust_scale(df: DataFrame, column: str, name: str) -> DataFrame:
    """(x - median) / interquartile range."""
    stats = percentiles(df, [], column, {"a": 0.25, "b": 0.5, "c": 0.75})
    row = stats.select(F.struct("a", "b", "c")).scalar()
    return df.withColumn("_f", row).withColumn(
        name, F.try_divide(F.col(column) - F.col("_f.b"), F.col("_f.c") - F.col("_f.a"))).drop("_f")


def min_max_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    stats = df.agg(F.struct(*[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("a", F.min), ("b", F.max))])).scalar()
    return df.withColumn("_f", stats).withColumns(
        {c: F.try_divide(F.col(c) - F.col(f"_f.a_{c}"), F.col(f"_f.b_{c}") - F.col(f"_f.a_{c}"))
         for c in columns}).drop("_f")


def boxcox(x: Column, power: float) -> Column:
    """((1 + x) ** power - 1) / power, or log(1 + x) for power zero."""
    if power == 0:
        return F.log1p(x)
    return (F.pow(1 + x, F.lit(float(power))) - 1) / F.lit(float(power))


def boxcox_fit(df: DataFrame, columns: list[str], shift: float = 1.0) -> dict[str, float]:
    """Power with the highest likelihood for each positive column ``x + shift``; 1 for a constant one.

    The likelihood of a whole grid of powers comes from one aggregate. The grid is widened until the best power is
    inside it, and then narrowed around it. Only these sums reach the driver. Values are taken
    relative to their geometric mean, which leaves the best power as it is and keeps large powers finite.
    """
    logs = {c: F.log(F.col(c).cast("double") + shift) for c in columns}
    first = df.agg(*[f(logs[c]).alias(f"{k}{n}") for n, c in enumerate(columns) for k, f in (("m", F.avg), ("a", F.min), ("b", F.max))]).first()
    best: dict[str, float] = dict.fromkeys(columns, 1.0)
    spans = {c: LAMBDA_RANGE for n, c in enumerate(columns) if first[f"a{n}"] != first[f"b{n}"]}
    rounds = dict.fromkeys(spans, 0)
    while spans:
        grids = {c: [a + (b - a) * i / (LAMBDA_STEPS - 1) for i in range(LAMBDA_STEPS)] for c, (a, b) in spans.items()}
        aggs = []
        for n, c in enumerate(columns):
            x = logs[c] - F.lit(first[f"m{n}"])
            for i, power in enumerate(grids.get(c, ())):
                y = x if abs(power) < 1e-12 else F.expm1(x * F.lit(power)) / F.lit(power)
                aggs.append(F.var_pop(y).alias(f"v{n}_{i}"))
        sums = df.agg(*aggs).first()
        for n, c in enumerate(columns):
            if c not in spans:
                continue

            def likelihood(i: int, n=n) -> float:
                spread = sums[f"v{n}_{i}"]
                return -math.log(spread) if spread and math.isfinite(spread) else -math.inf
            top = max(range(LAMBDA_STEPS), key=likelihood)
            best[c], (a, b) = grids[c][top], spans[c]
            if not rounds[c] and top in (0, LAMBDA_STEPS - 1):
                spans[c] = (best[c] - (b - a), best[c] + (b - a))
                continue
            step, rounds[c] = grids[c][1] - grids[c][0], rounds[c] + 1
            spans[c] = (best[c] - step, best[c] + step)
            if rounds[c] >= LAMBDA_ROUNDS and step <= LAMBDA_FINEST * max(1.0, abs(best[c])):
                del spans[c]
    return best


def poly_features(df: DataFrame, columns: list[str], keep: list[str] = (), most: int = MAX_FEATURES) -> DataFrame:
    """1, every column, and every product of two columns; refused if there are more than ``most`` of them."""
    if 1 + len(columns) * (len(columns) + 3) // 2 > most:
        raise ValueError(f"more than {most} polynomial features")
    terms = [F.lit(1.0).alias("bias"), *[F.col(c).cast("double").alias(c) for c in columns]]
    for i, a in enumerate(columns):
        terms += [(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}*{b}") for b in columns[i:]]
    return df.select(*keep, *terms)


def spatial_sign(df: DataFrame, columns: list[str]) -> DataFrame:
    """Divide a row by its length."""
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    out = df.withColumn("_n", arrays.norm(vector))
    return out.withColumns({c: F.try_divide(F.col(c), F.col("_n")) for c in columns}).drop("_n")


def outlier_mask(df: DataFrame, column: str, share: float) -> DataFrame:
    """Rows up to the given percentile of the column."""
    limit = percentiles(df, [], column, {"_limit": share}).scalar()
    return df.filter(F.col(column) <= limit)


def pca_project(df: DataFrame, columns: list[str], k: int, keep: list[str] = ()) -> DataFrame:
    """First k principal components; only a columns x columns matrix reaches the driver."""
    scaled = center_scale(df, columns)
    rows = VectorAssembler(inputCols=columns, outputCol="_x").transform(scaled)
    model = PCA(k=k, inputCol="_x", outputCol="_p").fit(rows)
    parts = model.transform(rows).withColumn("_a", vector_to_array("_p"))
    return parts.select(*keep, *[F.get("_a", F.lit(i)).alias(f"pc{i + 1}") for i in range(k)])


# selection by statistics

def variance_filter(df: DataFrame, columns: list[str], least: float) -> DataFrame:
    """Columns whose population variance exceeds ``least``."""
    row = df.agg(*[F.var_pop(c).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "variance").filter(F.col("variance") > least)


def collinear_filter(matrix: DataFrame, columns: list[str], limit: float) -> list[str]:
    """Columns kept when, going left to right, one too close to a kept one is dropped."""
    close = {(r.a, r.b) for r in matrix.filter(F.abs("corr") > limit).select("a", "b").collect()}
    kept: list[str] = []
    for c in columns:
        if not any((k, c) in close for k in kept):
            kept.append(c)
    return kept


def mutual_information(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Mutual information (nats) of each category column with the label."""
    long = df.select(F.col(label).cast("string").alias("_y"), *[F.col(c).cast("string").alias(c) for c in features])
    long = long.unpivot(["_y"], features, "feature", "_x").filter("_x IS NOT NULL AND _y IS NOT NULL")
    n = F.col("_n")
    cells = materialize(long.groupBy("feature", "_x", "_y").agg(F.count(F.lit(1)).alias("_n")))
    both = cells.groupBy("feature").agg(F.sum(n * F.log(n)).alias("xy"), F.sum(n).alias("t"))
    sides = [cells.groupBy("feature", side).agg(F.sum(n).alias("_n")).groupBy("feature").agg(
        F.sum(n * F.log(n)).alias(side)) for side in ("_x", "_y")]
    joined = both.join(sides[0], "feature").join(sides[1], "feature")
    return joined.select("feature", (F.log("t") + (F.col("xy") - F.col("_x") - F.col("_y")) / F.col("t")).alias("score"))


def anova_f(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Ratio of the variance between classes to that within, per numeric column."""
    classes = materialize(df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        *[e for c in features for e in (F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"m_{c}"),
                                        (F.var_pop(c) * F.count(c)).alias(f"w_{c}"))]))

    def one(c: str) -> DataFrame:
        n, m, w = F.col(f"n_{c}"), F.col(f"m_{c}"), F.col(f"w_{c}")
        sums = classes.agg(F.sum(n).alias("n"), F.count_if(n > 0).alias("k"), F.sum(w).alias("w"),
                           F.sum(n * m).alias("s"), F.sum(n * m * m).alias("q"))
        between = (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("k") - 1)
        return sums.select(F.lit(c).alias("feature"),
                           F.try_divide(between, F.col("w") / (F.col("n") - F.col("k"))).alias("score"))

    out = one(features[0])
    for c in features[1:]:
        out = out.unionByName(one(c))
    return out


def chi2_scores(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Chi-squared distance of class sums of non-negative columns from class shares."""
    classes = materialize(df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"s_{c}") for c in features]))
    totals = classes.agg(F.struct(F.sum("_n").alias("n"), *[F.sum(f"s_{c}").alias(f"s_{c}") for c in features])).scalar()
    rows = classes.withColumn("_t", totals)
    parts = []
    for c in features:
        want = F.col(f"_t.s_{c}") * F.col("_n") / F.col("_t.n")
        parts.append(F.sum(F.pow(F.col(f"s_{c}") - want, F.lit(2)) / want).alias(c))
    return rows.agg(*parts).unpivot([], features, "feature", "score")


def select_best(scores: DataFrame, k: int | None = None, percent: float | None = None) -> DataFrame:
    """The k best-scored features, or the best percentage of them (score rows are few: one per column)."""
    total = scores.count()
    keep = k if k is not None else max(1, int(total * percent / 100))
    return scores.orderBy(F.desc("score"), "feature").limit(keep)
