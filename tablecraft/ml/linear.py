"""Linear models. Least squares needs sums of products only, so a single pass over the
table serves the closed form and any number of gradient steps."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions import arrays
from tablecraft.operators.reshape import pivot_values
from tablecraft.plans.groups import join_back
from tablecraft.plans.lineage import materialize

MAX_CLASSES = 100


def with_features(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)


@dataclass
class Products:
    """Sums over rows: X'X, X'y, y'y and the row count, with a leading column of ones."""

    xx: np.ndarray
    xy: np.ndarray
    yy: float
    rows: float

    def mse(self, theta: np.ndarray) -> float:
        return float((theta @ self.xx @ theta - 2 * theta @ self.xy + self.yy) / self.rows)

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        return 2.0 / self.rows * (self.xx @ theta - self.xy)

    def part(self, at: list[int]) -> Products:
        return Products(self.xx[np.ix_(at, at)], self.xy[at], self.yy, self.rows)


def _sums(columns: list[str], label: str) -> list[Column]:
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    y = F.col(label).cast("double")
    pairs = [F.sum(x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]
    return [F.array(*pairs).alias("xx"), F.array(*[F.sum(a * y) for a in x]).alias("xy"),
            F.sum(y * y).alias("yy"), F.count(y).cast("double").alias("rows")]


def _unpack(row) -> Products:
    width = len(row.xy)
    xx = np.zeros((width, width))
    xx[np.triu_indices(width)] = row.xx
    return Products(xx + np.triu(xx, 1).T, np.array(row.xy), row.yy, row.rows)


def products(df: DataFrame, columns: list[str], label: str) -> Products:
    complete = df.dropna("any", subset=[*columns, label])
    return _unpack(complete.agg(*_sums(columns, label)).first())


def normal_equation(df: DataFrame, columns: list[str], label: str) -> np.ndarray:
    """Intercept and weights of least squares."""
    p = products(df, columns, label)
    return np.linalg.lstsq(p.xx, p.xy, rcond=None)[0]


def predict_linear(columns: list[str], theta: np.ndarray) -> Column:
    out = F.lit(float(theta[0]))
    for c, w in zip(columns, theta[1:]):
        out = out + F.col(c) * F.lit(float(w))
    return out


def gradient_descent(train: Products, rate: float = 0.1, steps: int = 200, tolerance: float = 1e-9,
                     validation: Products | None = None) -> np.ndarray:
    """Full-batch steps from zero; stops at a flat slope or when validation gets worse."""
    theta = np.zeros(len(train.xy))
    best = np.inf
    for _ in range(steps):
        slope = train.gradient(theta)
        if np.linalg.norm(slope) < tolerance:
            break
        following = theta - rate * slope
        if validation is not None:
            error = validation.mse(following)
            if error > best:
                break
            best = error
        theta = following
    return theta


def minibatch_descent(df: DataFrame, columns: list[str], label: str, key: str, batches: int = 20,
                      epochs: int = 5, t0: float = 5.0, t1: float = 50.0, seed: int = 0) -> np.ndarray:
    """Mini-batch steps with rate t0 / (t + t1). An epoch deals the rows to batches by
    hash and sums each batch in one pass; the steps then need only those sums."""
    rows = df.dropna("any", subset=[*columns, label])
    theta, t = np.zeros(len(columns) + 1), 0
    for epoch in range(epochs):
        batch = F.pmod(F.xxhash64(key, F.lit(seed + epoch)), F.lit(batches)).alias("batch")
        for row in rows.groupBy(batch).agg(*_sums(columns, label)).orderBy("batch").collect():
            theta = theta - t0 / (t + t1) * _unpack(row).gradient(theta)
            t += 1
    return theta


# estimators with the parameters of the usual single-machine library

def linear() -> LinearRegression:
    return LinearRegression(solver="normal")


def label_stats(df: DataFrame, label: str = "label") -> tuple[int, float]:
    """Rows and population deviation of the label."""
    rows, spread = df.agg(F.count(label), F.stddev_pop(label)).first()
    return rows, spread


def penalty(alpha: float, l1_ratio: float, spread: float) -> tuple[float, float]:
    """(regParam, elasticNetParam) for alpha (l1_ratio |w| + (1 - l1_ratio) / 2 |w|^2).

    Spark scales the label to unit deviation, which divides the quadratic part of the
    penalty by that deviation but leaves the absolute part; this undoes it.
    """
    first, second = alpha * l1_ratio, alpha * (1 - l1_ratio) * spread
    return first + second, (first / (first + second) if first + second else 0.0)


def elastic_net(df: DataFrame, alpha: float, l1_ratio: float, steps: int = 1000, label: str = "label") -> LinearRegression:
    """RSS / 2n + alpha (l1_ratio |w| + (1 - l1_ratio) / 2 |w|^2)."""
    strength, share = penalty(alpha, l1_ratio, label_stats(df, label)[1])
    return LinearRegression(regParam=strength, elasticNetParam=share, standardization=False, maxIter=steps, tol=1e-10,
                            solver="normal", labelCol=label)


def ridge(df: DataFrame, alpha: float, label: str = "label") -> LinearRegression:
    """RSS + alpha |w|^2."""
    return elastic_net(df, alpha / label_stats(df, label)[0], 0.0, label=label)


def lasso(df: DataFrame, alpha: float, steps: int = 1000, label: str = "label") -> LinearRegression:
    """RSS / 2n + alpha |w|."""
    return elastic_net(df, alpha, 1.0, steps, label)


def logistic(c: float, rows: int, steps: int = 100, **more) -> LogisticRegression:
    """Inverse penalty strength ``c``."""
    return LogisticRegression(regParam=1.0 / (c * rows), standardization=False, maxIter=steps, **more)


def linear_svm(c: float, rows: int, steps: int = 100) -> LinearSVC:
    return LinearSVC(regParam=1.0 / (c * rows), standardization=False, maxIter=steps)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows / (classes * rows of the class), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.withColumn("_t", totals).select(label, (F.col("_t.n") / (F.col("_t.k") * F.col("_n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight``, whatever the number of classes; a missing class has none."""
    return join_back(df, materialize(class_weights(df, label).where(F.col(label).isNotNull())), [label])


class OneVsOne:
    """A binary model per pair of classes; the class with most wins, the smaller on ties.

    There are ``classes * (classes - 1) / 2`` models, so more than ``most`` classes are refused rather than left out.
    """

    def __init__(self, estimator, label: str = "label", parallelism: int = 4, most: int = MAX_CLASSES):
        self.estimator, self.label, self.parallelism, self.most = estimator, label, parallelism, most
        self.classes: list = []
        self.models: list = []

    def fit(self, df: DataFrame) -> OneVsOne:
        self.classes = pivot_values(df, self.label, self.most)

        def one(pair):
            low, high = pair
            rows = df.filter(F.col(self.label).isin(low, high)).withColumn(
                "_target", (F.col(self.label) == high).cast("double"))
            model = self.estimator.copy({self.estimator.labelCol: "_target"}).fit(rows)
            return low, high, model.coefficients.toArray().tolist(), float(model.intercept)

        with ThreadPoolExecutor(self.parallelism) as pool:
            self.models = list(pool.map(one, combinations(self.classes, 2)))
        return self

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        x = vector_to_array("features")
        rows = df.withColumn("_x", x)
        wins = F.array(*[F.when(arrays.dot(F.col("_x"), F.lit(w)) + b > 0, F.lit(high)).otherwise(F.lit(low))
                         for low, high, w, b in self.models])
        rows = rows.withColumn("_wins", wins)

        def count(value) -> Column:
            return F.size(F.filter("_wins", lambda v: v == value))

        tally = F.array(*[F.struct(count(c).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c"))
                          for i, c in enumerate(self.classes)])
        return rows.withColumn(name, F.array_max(tally)["c"]).drop("_x", "_wins")
