"""Validation over folds, parameter search, stacking and learning curves."""

from __future__ import annotations

import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.ml.folds import hash_bucket
from tablecraft.ml.linear import Products, logistic, products, with_features
from tablecraft.operators.reshape import pivot_values
from tablecraft.plans.lineage import materialize

PARALLEL = 4


def _folds(df: DataFrame, fold: str) -> list:
    return pivot_values(df, fold)


def _each(jobs: list, work: Callable) -> list:
    """Run independent fits side by side, so that their small stages fill the cluster."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(work, jobs))


def cross_validate(df: DataFrame, estimator: Estimator, evaluators: dict[str, Evaluator], fold: str) -> DataFrame:
    """Train and test score of each fold (a table of folds x measures)."""
    rows = materialize(df)

    def one(k) -> list:
        train, test = rows.filter(F.col(fold) != k), rows.filter(F.col(fold) == k)
        model = estimator.fit(train)
        return [(int(k), name, float(evaluator.evaluate(model.transform(train))),
                 float(evaluator.evaluate(model.transform(test)))) for name, evaluator in evaluators.items()]

    scores = [score for part in _each(_folds(rows, fold), one) for score in part]
    return df.sparkSession.createDataFrame(scores, "fold int, measure string, train double, test double")


def cross_predict(df: DataFrame, estimator: Estimator, fold: str, column: str = "prediction",
                  name: str = "prediction") -> DataFrame:
    """Each row predicted by the model that did not see its fold."""
    rows = materialize(df)

    def one(k) -> DataFrame:
        model = estimator.fit(rows.filter(F.col(fold) != k))
        scored = model.transform(rows.filter(F.col(fold) == k))
        return scored.select(*df.columns, F.col(column).alias(name))

    return reduce(DataFrame.unionByName, _each(_folds(rows, fold), one))


def _search(df: DataFrame, estimator: Estimator, grid: list, evaluator: Evaluator, fold: str) -> tuple[DataFrame, object]:
    rows = materialize(df)
    found = _folds(rows, fold)
    at = F.lit(0)
    for i, k in enumerate(found):
        at = F.when(F.col(fold) == k, i).otherwise(at)
    search = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=len(found),
                            foldCol="_fold", parallelism=PARALLEL, collectSubModels=False)
    model = search.fit(rows.withColumn("_fold", at.cast("int")))
    better = -1 if evaluator.isLargerBetter() else 1
    order = sorted(range(len(grid)), key=lambda i: better * model.avgMetrics[i])
    table = [(", ".join(f"{p.name}={v}" for p, v in sorted(grid[i].items(), key=lambda e: e[0].name)),
              float(model.avgMetrics[i]), float(model.stdMetrics[i]), rank + 1) for rank, i in enumerate(order)]
    return df.sparkSession.createDataFrame(table, "params string, mean double, std double, place int"), model.bestModel


def combinations_of(params: dict) -> list[dict]:
    """All combinations of ``params`` (param -> values)."""
    grid = ParamGridBuilder()
    for param, values in params.items():
        grid.addGrid(param, values)
    return grid.build()


def grid_search(df: DataFrame, estimator: Estimator, grid: list[dict], evaluator: Evaluator, fold: str):
    """(result table, best model) over the given parameter combinations."""
    return _search(df, estimator, grid, evaluator, fold)


def random_search(df: DataFrame, estimator: Estimator, grid: list[dict], evaluator: Evaluator, fold: str,
                  tries: int, seed: int = 0):
    """The same over randomly drawn combinations."""
    return _search(df, estimator, random.Random(seed).sample(grid, min(tries, len(grid))), evaluator, fold)


def logistic_cv(df: DataFrame, fold: str, strengths: list[float], evaluator: Evaluator, steps: int = 100):
    """Logistic regression with the inverse penalty chosen by cross-validation: (table, best model)."""
    rows, base = df.count(), logistic(1.0, 1, steps)
    return _search(df, base, [{base.regParam: 1.0 / (c * rows)} for c in strengths], evaluator, fold)


def stack_models(df: DataFrame, estimators: dict[str, Estimator], label: str, fold: str) -> tuple[object, DataFrame]:
    """Linear model over out-of-fold predictions of the base models; returns it and its predictions."""
    rows = df
    for name, estimator in estimators.items():
        rows = materialize(cross_predict(rows, estimator, fold, name=f"oof_{name}"))
    level = with_features(rows, [f"oof_{n}" for n in estimators], "_level")
    final = LinearRegression(featuresCol="_level", labelCol=label, solver="normal").fit(level)
    return final, final.transform(level).drop("_level")


def learning_curve(df: DataFrame, estimator: Estimator, evaluator: Evaluator, key: str, steps: int = 10,
                   seed: int = 0) -> DataFrame:
    """Train and validation score for growing shares of the training rows."""
    rows = materialize(df.withColumn("_b", hash_bucket(key, 100, seed)))
    train, valid = rows.filter("_b >= 20"), rows.filter("_b < 20")

    def one(step: int) -> tuple:
        part = train.filter(F.col("_b") < 20 + 80 * step / steps)
        model = estimator.fit(part)
        return (step / steps, part.count(), float(evaluator.evaluate(model.transform(part))),
                float(evaluator.evaluate(model.transform(valid))))

    scores = _each(list(range(1, steps + 1)), one)
    return df.sparkSession.createDataFrame(scores, "share double, rows long, train double, validation double")


def complexity_curve(df: DataFrame, feature: str, label: str, fold: str, degrees: list[int]) -> DataFrame:
    """Cross-validated error of polynomials of one feature by degree.

    All powers are summed per fold in one pass; every fit is then a small solve.
    """
    top = max(degrees)
    stats = df.agg(F.avg(feature), F.stddev_pop(feature)).first()
    z = (F.col(feature) - stats[0]) / (stats[1] or 1.0)
    powers = df.select(fold, label, *[F.pow(z, F.lit(float(d))).alias(f"p{d}") for d in range(1, top + 1)])
    names = [f"p{d}" for d in range(1, top + 1)]
    parts = {k: products(powers.filter(F.col(fold) == k), names, label) for k in _folds(df, fold)}
    scores = []
    for degree in degrees:
        at = list(range(degree + 1))
        train_error, test_error = [], []
        for k, test in parts.items():
            others = [p for j, p in parts.items() if j != k]
            train = Products(sum(p.xx for p in others), sum(p.xy for p in others), sum(p.yy for p in others),
                             sum(p.rows for p in others)).part(at)
            theta = np.linalg.lstsq(train.xx, train.xy, rcond=None)[0]
            train_error.append(np.sqrt(max(train.mse(theta), 0.0)))
            test_error.append(np.sqrt(max(test.part(at).mse(theta), 0.0)))
        scores.append((degree, float(np.mean(train_error)), float(np.mean(test_error))))
    return df.sparkSession.createDataFrame(scores, "degree int, train double, test double")


def greedy_select(df: DataFrame, columns: list[str], label: str, most: int) -> DataFrame:
    """Add, step by step, the column that lowers the squared error most.

    One pass gives the sums of products; every candidate set is solved from these.
    """
    everything = products(df, columns, label)
    chosen, scores = [0], []
    for step in range(min(most, len(columns))):
        trials = []
        for i in range(1, len(columns) + 1):
            if i not in chosen:
                part = everything.part([*chosen, i])
                trials.append((part.mse(np.linalg.lstsq(part.xx, part.xy, rcond=None)[0]), i))
        error, best = min(trials)
        if scores and error >= scores[-1][2]:
            break
        chosen.append(best)
        scores.append((step + 1, columns[best - 1], float(error)))
    return df.sparkSession.createDataFrame(scores, "step int, column string, mse double")


def importance_table(df: DataFrame, columns: list[str], importances) -> DataFrame:
    """Feature importance, highest first, with the running total."""
    pairs = sorted(zip(columns, (float(x) for x in importances)), key=lambda e: (-e[1], e[0]))
    total, out = 0.0, []
    for name, value in pairs:
        total += value
        out.append((name, value, total))
    return df.sparkSession.createDataFrame(out, "feature string, importance double, cumulative double")
