"""Ensembles of trees built from weighted fits; weights come from a hash of row and model."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.ml.boosting import StagedBoost
from tablecraft.ml.ensembles import Forest
from tablecraft.plans.lineage import materialize

GRAIN = 1 << 30


def impurity(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Gini, entropy (bits) and error rate of the label per group."""
    cells = df.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    sums = cells.groupBy(*keys).agg(F.sum(n).alias("t"), F.sum(n * n).alias("q"), F.sum(n * F.log2(n)).alias("l"),
                                    F.max(n).alias("m"))
    return sums.select(*keys, (1 - F.col("q") / (F.col("t") * F.col("t"))).alias("gini"),
                       (F.log2("t") - F.col("l") / F.col("t")).alias("entropy"),
                       (1 - F.col("m") / F.col("t")).alias("error"))


def hash_uniform(key: Column | str, model: int, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by row key and model number."""
    return F.pmod(F.xxhash64(key, F.lit(model), F.lit(seed)), F.lit(GRAIN)) / F.lit(float(GRAIN))


def poisson_weight(uniform: Column, most: int = 12) -> Column:
    """Times a row is drawn in a bootstrap sample: Poisson with mean one."""
    out, reached = F.lit(most), 1.0
    tail = [math.exp(-1) / math.factorial(k) for k in range(most)]
    for k in reversed(range(most)):
        reached = sum(tail[: k + 1])
        out = F.when(uniform < reached, k).otherwise(out)
    return out.cast("double")


def majority(votes: list[Column]) -> Column:
    """Most frequent non-missing vote, the smallest on ties."""
    given = F.filter(F.array(*votes), lambda v: v.isNotNull())
    tally = F.transform(F.array_distinct(given), lambda v: F.struct(
        F.size(F.filter(given, lambda w: w == v)).alias("n"), (-v).alias("v")))
    return -F.array_max(tally)["v"]


class BaggedTrees(Forest):
    """Classification trees on samples with replacement (bagging) or without (pasting), all grown together."""

    def __init__(self, key: str, models: int = 500, replace: bool = True, share: float = 0.5, depth: int = 5, seed: int = 0, **more):
        super().__init__(key, models, depth, replace=replace, share=share, seed=seed, **more)


class BoostedTrees:
    """Adaptive boosting for several classes: wrong rows gain weight, good trees gain votes."""

    def __init__(self, rounds: int = 5, depth: int = 1, rate: float = 1.0, seed: int = 0):
        self.rounds, self.depth, self.rate, self.seed = rounds, depth, rate, seed
        self.models: list = []
        self.alphas: list[float] = []

    def fit(self, df: DataFrame, label: str = "label") -> BoostedTrees:
        classes = df.select(label).distinct().count()
        tree = DecisionTreeClassifier(maxDepth=self.depth, weightCol="_weight", labelCol=label, seed=self.seed)
        rows = df.select("features", label).withColumn("_weight", F.lit(1.0))
        self.models, self.alphas = [], []
        for _ in range(self.rounds):
            rows = materialize(rows)
            model = tree.fit(rows)
            judged = model.transform(rows).withColumn("_miss", (F.col("prediction") != F.col(label)).cast("double"))
            error, total = judged.agg(F.sum(F.col("_miss") * F.col("_weight")), F.sum("_weight")).first()
            error = min(max(error / total, 1e-10), 1 - 1e-10)
            alpha = self.rate * (math.log((1 - error) / error) + math.log(classes - 1))
            if alpha <= 0:
                break
            self.models.append(model)
            self.alphas.append(alpha)
            weight = F.col("_weight") * F.exp(F.lit(alpha) * F.col("_miss")) / F.lit(float(total))
            rows = judged.select("features", label, weight.alias("_weight"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out, votes = df, []
        for m, (model, alpha) in enumerate(zip(self.models, self.alphas)):
            out = model.transform(out).withColumnRenamed("prediction", f"_v{m}").drop("rawPrediction", "probability")
            votes.append(F.struct(F.col(f"_v{m}").alias("v"), F.lit(alpha).alias("a")))
        given = F.array(*votes)
        tally = F.transform(F.array_distinct(F.transform(given, lambda s: s["v"])), lambda v: F.struct(
            F.aggregate(F.filter(given, lambda s: s["v"] == v), F.lit(0.0), lambda acc, s: acc + s["a"]).alias("w"),
            (-v).alias("v")))
        return out.withColumn("prediction", -F.array_max(tally)["v"]).drop(*[f"_v{m}" for m in range(len(self.models))])


def residual_trees(df: DataFrame, label: str, trees: int = 3, depth: int = 2, bins: int = 64) -> tuple[list, DataFrame]:
    """Each tree learns what the sum of the earlier ones leaves; returns trees and predictions."""
    rows = df.withColumns({"_rest": F.col(label).cast("double"), "prediction": F.lit(0.0)})
    fitted = []
    for _ in range(trees):
        rows = materialize(rows)
        model = DecisionTreeRegressor(maxDepth=depth, maxBins=bins, labelCol="_rest", predictionCol="_step").fit(rows)
        fitted.append(model)
        rows = model.transform(rows).withColumns({
            "prediction": F.col("prediction") + F.col("_step"), "_rest": F.col("_rest") - F.col("_step")}).drop("_step")
    return fitted, rows.drop("_rest")


def best_iteration(train: DataFrame, valid: DataFrame, label: str, most: int = 500, depth: int = 2, rate: float = 0.1, patience: int | None = None):
    """(errors after each tree on the validation rows, best count, model with that many trees).

    ``patience`` ends the search once that many trees in a row brought nothing better; without it all ``most`` are searched.
    """
    model = StagedBoost(most, depth, rate, patience=patience).fit(train, valid, label=label)
    return model.errors, model.best, model.keep_best()


def bootstrap_statistics(df: DataFrame, value: str, weights: list[Column]) -> DataFrame:
    """Weighted mean per replicate and the standard error over replicates, in one pass."""
    x = F.col(value).cast("double")
    row = df.filter(x.isNotNull()).agg(*[(F.sum(x * w) / F.sum(w)).alias(f"m{i}") for i, w in enumerate(weights)])
    long = row.select(F.explode(F.array(*[f"m{i}" for i in range(len(weights))])).alias("mean"))
    return long.agg(F.avg("mean").alias("mean"), F.stddev("mean").alias("standard_error"))


def poisson_weights(key: str, replicates: int, seed: int = 0) -> list[Column]:
    return [poisson_weight(hash_uniform(key, b, seed)) for b in range(replicates)]
