"""Gradient boosting in stages: predictions are carried beside the rows, and a stage looks at its own tree only.

Rows that fall in the same bins have the same prediction at every stage, so they are added up to one cell before the first
stage; sums of squares, gradients and losses over cells are those over rows. A level of a tree is one pass over the cells, and the
pass that starts a tree also sums the validation loss of the trees so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.ml import ensembles
from tablecraft.ml.ensembles import PARTS, Nodes, Variance, as_array, binned, borders
from tablecraft.plans.lineage import materialize

#: Stages after which predictions are written down; between, the tasks add the trees since then.
WRITTEN = 25


class SquaredLoss:
    @staticmethod
    def start(mean: float) -> float:
        return mean

    @staticmethod
    def mean(f: np.ndarray) -> np.ndarray:
        return f

    @staticmethod
    def curvature(f: np.ndarray) -> np.ndarray:
        return np.ones_like(f)

    @staticmethod
    def total(f, count, label, square):
        return square - 2 * f * label + count * f * f


class LogisticLoss:
    """Labels 0 and 1; predictions are log odds."""

    @staticmethod
    def start(mean: float) -> float:
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(mean / (1 - mean)))

    @staticmethod
    def mean(f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-f))

    @staticmethod
    def curvature(f: np.ndarray) -> np.ndarray:
        p = LogisticLoss.mean(f)
        return np.maximum(p * (1 - p), 1e-12)

    @staticmethod
    def total(f, count, label, square):
        return label * np.logaddexp(0, -f) + (count - label) * np.logaddexp(0, f)


class StagedBoost:
    """Up to ``rounds`` trees, each fitted to what the others leave, times ``rate``.

    With validation rows, ``errors`` has the mean loss after each tree and ``best`` the number of trees with the least; ``patience`` ends
    the search once that many trees in a row brought nothing better (none: all rounds are searched). ``keep_best`` cuts the model there.
    Rows without a label are not learned from; missing values are larger than all others; no rows at all give the prediction 0.
    """

    def __init__(self, rounds: int = 500, depth: int = 2, rate: float = 0.1, loss=SquaredLoss, bins: int = 64, patience: int | None = None,
                 least: float = 1.0):
        self.rounds, self.depth, self.rate, self.loss, self.bins, self.patience, self.least = rounds, depth, rate, loss, bins, patience, least
        self.cuts: list[np.ndarray] = []
        self.start, self.errors, self.best = 0.0, [], 0
        self.trees: list[Nodes] = []

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def _cells(self, train: DataFrame, valid: DataFrame | None, features: str, label: str) -> DataFrame:
        def side(df: DataFrame, learned: float) -> DataFrame:
            return df.where(F.col(label).isNotNull()).select(as_array(features, df).alias("v"), F.col(label).cast("double").alias("y"), F.lit(learned).alias("t"))

        known = side(train, 1.0)
        self.cuts = borders(known, F.col("v"), self.bins)
        rows = binned(known if valid is None else known.unionAll(side(valid, 0.0)), F.col("v"), self.cuts, F.col("y"), F.col("t"))
        t, y = F.col("t"), F.col("y")
        cells = rows.groupBy("x").agg(F.sum(t).alias("tw"), F.sum(t * y).alias("ts"), F.sum(1 - t).alias("vw"),
                                      F.sum((1 - t) * y).alias("vs"), F.sum((1 - t) * y * y).alias("vq"))
        return materialize(cells)

    def fit(self, train: DataFrame, valid: DataFrame | None = None, features: str = "features", label: str = "label") -> StagedBoost:
        cells = self._cells(train, valid, features, label)
        weight, total, judged = cells.agg(F.sum("tw"), F.sum("ts"), F.sum("vw")).first()
        self.trees, self.errors, self.best = [], [], 0
        if not weight or not self.cuts:
            return self
        self.start = self.loss.start(total / weight)
        # a pass is over soon, so its tasks are as few as blocks of cells
        blocks = -(-cells.count() // ensembles.BLOCK)
        cells = materialize(cells.withColumn("p", F.lit(self.start)).repartition(blocks))
        of = np.arange(len(self.cuts))[None, :]
        unwritten: list[Nodes] = []
        while len(self.trees) < self.rounds:
            tree = Nodes.empty(1, self.depth, 4)
            for level in range(self.depth):
                parts = cells.mapInArrow(self._pass(unwritten, tree, level), PARTS)
                splits = ensembles._splits(parts, of, self.bins, Variance(4), self.least)
                if level == 0 and judged and self.trees:
                    self.errors.append(float(splits["sums"].iat[0][3]) / judged)
                ensembles._enter(tree, splits)
                if not (splits["feature"] >= 0).any():
                    break
            if self._stopped() or (tree.feature < 0).all():
                break
            self.trees.append(self._leaves(tree))
            unwritten.append(self.trees[-1])
            if len(unwritten) == WRITTEN:
                cells, unwritten = materialize(cells.withColumn("p", self._add(unwritten)("x", "p"))), []
        if judged and len(self.errors) < len(self.trees):
            last = cells.mapInArrow(self._pass(unwritten, Nodes.empty(1, self.depth, 4), 0), PARTS)
            self.errors.append(float(ensembles._splits(last, of, self.bins, Variance(4), self.least)["sums"].iat[0][3]) / judged)
        self.best = int(np.argmin(self.errors)) + 1 if self.errors else len(self.trees)
        return self

    def _stopped(self) -> bool:
        return bool(self.patience and self.errors and len(self.errors) - 1 - int(np.argmin(self.errors)) >= self.patience)

    def _leaves(self, tree: Nodes) -> Nodes:
        """The tree with its step in each node instead of sums."""
        sums = tree.value
        step = np.divide(sums[..., 1], sums[..., 2], out=np.zeros(sums.shape[:2]), where=sums[..., 2] > 0)
        return Nodes(tree.feature, tree.bin, self.rate * step[..., None])

    def _pass(self, earlier: list[Nodes], tree: Nodes, level: int):
        """Histograms of the tree's nodes at a level: weight, gradient, curvature and validation loss by feature and bin."""
        loss, width, bins, depth = self.loss, len(self.cuts), self.bins, self.depth

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in ensembles._blocks(batches):
                x = ensembles._bytes(table.column("x"), width)
                count, total, vw, vs, vq, f = (table.column(c).to_numpy() for c in ("tw", "ts", "vw", "vs", "vq", "p"))
                for done in earlier:
                    f = f + done.value[0, done.reached(x, depth)[:, 0], 0]
                reached = tree.reached(x, level)[:, 0] - ((1 << level) - 1)
                rows = np.flatnonzero(reached >= 0)
                if not len(rows):
                    continue
                channels = (count, total - count * loss.mean(f), count * loss.curvature(f), loss.total(f, vw, vs, vq))
                at = ((reached[rows][:, None] * width + np.arange(width)) * bins + x[rows]).ravel()
                sums = np.stack([np.bincount(at, np.repeat(c[rows], width), width * bins << level) for c in channels], axis=1)
                out = [(0, (1 << level) - 1 + n, ensembles._packed(part.ravel())) for n, part in enumerate(sums.reshape(1 << level, -1, 4))]
                block = int.from_bytes(x[0].tobytes()[:7].ljust(7), "big")
                yield from ensembles._as_batches(iter(out), block)

        return partial

    def _add(self, trees: list[Nodes]):
        """A function of bins and prediction that adds the steps of trees."""
        width, depth = len(self.cuts), self.depth

        @F.pandas_udf("double")
        def added(x: pd.Series, p: pd.Series) -> pd.Series:
            bins, out = np.frombuffer(b"".join(x), dtype=np.uint8).reshape(-1, width), p.to_numpy().copy()
            for tree in trees:
                out += tree.value[0, tree.reached(bins, depth)[:, 0], 0]
            return pd.Series(out)

        return added

    def keep_best(self) -> StagedBoost:
        self.trees = self.trees[: self.best]
        return self

    def transform(self, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        """Add the prediction: a number, or for the logistic loss the class with at least even odds."""
        cuts, trees, start, depth, logistic = self.cuts, self.trees, self.start, self.depth, self.loss is LogisticLoss

        def answers(x: np.ndarray) -> np.ndarray:
            f = np.full(len(x), start)
            for tree in trees if cuts else ():
                f += tree.value[0, tree.reached(x, depth)[:, 0], 0]
            return (f > 0).astype(float) if logistic else f

        # rows of equal bins have one answer
        many = ensembles._combinations(cuts)
        known = answers(ensembles._of_codes(np.arange(many), cuts)) if cuts and many <= ensembles.ANSWERS else None

        @F.arrow_udf("double")
        def predict(values: pa.Array) -> pa.Array:
            x = ensembles._cut(ensembles._matrix(values, len(cuts)), cuts)
            return pa.array(answers(x) if known is None else known[ensembles._codes(x, cuts)])

        return df.withColumn(prediction, predict(as_array(features, df)))
