"""Network with one tanh layer and a sigmoid output, trained on sums of the gradient over all rows.

Every pass sums the gradient over partitions in one job; several networks (say, of different sizes) share the
pass over the data. Second-order steps (L-BFGS) need some hundred passes where plain steps need thousands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tablecraft.plans.lineage import materialize

START_SCALE = 0.01


@dataclass
class Weights:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    @staticmethod
    def random(inputs: int, hidden: int, seed: int, scale: float = START_SCALE) -> Weights:
        draw = np.random.default_rng(seed)
        return Weights(draw.standard_normal((hidden, inputs)) * scale, np.zeros(hidden),
                       draw.standard_normal(hidden) * scale, 0.0)

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.w1.T + self.b1)
        return hidden, 1.0 / (1.0 + np.exp(-(hidden @ self.w2 + self.b2)))

    def gradient(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Flat sums of (w1, b1, w2, b2, cross-entropy) over the rows."""
        hidden, p = self.forward(x)
        gap = p - y
        inner = np.outer(gap, self.w2) * (1.0 - hidden**2)
        p = np.clip(p, 1e-15, 1 - 1e-15)
        cost = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
        return np.concatenate([(inner.T @ x).ravel(), inner.sum(0), gap @ hidden, [gap.sum(), cost]])

    def moved(self, flat: np.ndarray, rate: float) -> Weights:
        return self.of(self.flat() - rate * flat)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w1.ravel(), self.b1, self.w2, [self.b2]])

    def of(self, flat: np.ndarray) -> Weights:
        """A network of this shape with these (w1, b1, w2, b2)."""
        n, h = self.w1.size, len(self.b1)
        return Weights(flat[:n].reshape(self.w1.shape), flat[n:n + h], flat[n + h:n + 2 * h], flat[n + 2 * h])


def _packed(rows: DataFrame, mean: np.ndarray, deviation: np.ndarray) -> DataFrame:
    """The rows as blocks of standardised numbers, which a pass reads without unpacking row by row."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = (np.stack(batch["x"].to_numpy()) - mean) / deviation
                yield pd.DataFrame({"x": [x.tobytes()], "y": [batch["y"].to_numpy(dtype=float).tobytes()]})

    return materialize(rows.mapInPandas(pack, "x binary, y binary"))


def _sums(blocks: DataFrame, nets: list[Weights], width: int) -> list[np.ndarray]:
    """The flat sums of each network, combined in the tasks before they are shuffled."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x).reshape(-1, width), np.frombuffer(y)
                part = np.concatenate([net.gradient(x, y) for net in nets])
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"at": np.arange(len(total)), "part": total})

    sums = blocks.mapInPandas(partial, "at int, part double").groupBy("at").agg(F.sum("part").alias("s")).toPandas()
    flat = np.zeros(sum(net.w1.size + 2 * len(net.b1) + 2 for net in nets))
    flat[sums["at"]] = sums["s"]
    return np.split(flat, np.cumsum([net.w1.size + 2 * len(net.b1) + 2 for net in nets])[:-1])


def descent(start: np.ndarray, steps: int, rate: float, momentum: float):
    """Plain steps: asks for cost and gradient at a point (by ``yield``) and returns the last point."""
    point, speed = start, np.zeros_like(start)
    for _ in range(steps):
        _, gradient = yield point
        speed = momentum * speed + gradient
        point = point - rate * speed
    return point


def lbfgs(start: np.ndarray, steps: int, memory: int = 10, tolerance: float = 1e-7):
    """Limited-memory quasi-Newton steps, each with a search for a point that is lower and flatter; asks as ``descent`` does."""
    point, pairs = start, []
    cost, gradient = yield point
    for _ in range(steps):
        direction, kept = -gradient, []
        for s, y in reversed(pairs):
            kept.append(s @ direction / (s @ y))
            direction = direction - kept[-1] * y
        if pairs:
            s, y = pairs[-1]
            direction = direction * (s @ y / (y @ y))
        for (s, y), a in zip(pairs, reversed(kept)):
            direction = direction + (a - y @ direction / (s @ y)) * s
        slope = gradient @ direction
        if slope >= 0:
            pairs, direction, slope = [], -gradient, -(gradient @ gradient)
        low, high, length = 0.0, np.inf, 1.0 if pairs else min(1.0, 1.0 / max(np.abs(gradient).sum(), 1e-12))
        for _ in range(20):
            new_cost, new_gradient = yield point + length * direction
            if not new_cost <= cost + 1e-4 * length * slope:
                high = length
            elif new_gradient @ direction < 0.9 * slope:
                low = length
            else:
                break
            length = 2 * length if high == np.inf else (low + high) / 2
        if not new_cost < cost:
            return point
        step, change = length * direction, new_gradient - gradient
        done = cost - new_cost <= tolerance * max(abs(cost), 1e-3) or np.abs(new_gradient).max() < 1e-9
        point, cost, gradient = point + step, new_cost, new_gradient
        if step @ change > 1e-12:
            pairs = [*pairs, (step, change)][-memory:]
        if done:
            return point
    return point


def train_networks(df: DataFrame, features: str, label: str, sizes: list[int], steps: int, rate: float = 1.2,
                   seed: int = 2, momentum: float = 0.0, scale: float = START_SCALE,
                   standardise: bool = False, solver: str = "descent") -> tuple[list[Weights], list[list[float]]]:
    """Networks of the given hidden sizes and their cost at each pass.

    ``features`` is an array column. Only weight-sized sums reach the driver. With ``standardise`` the
    steps are taken on inputs of mean 0 and deviation 1, and the weights returned apply to the inputs as they are. The solver
    ``descent`` takes ``steps`` plain steps; ``lbfgs`` takes second-order steps until the cost stands still, ``steps`` at most, and
    ignores rate and momentum. All networks share a pass, each at the point that its solver asks for, until the last one is done.
    """
    rows = materialize(df.select(F.col(features).alias("x"), F.col(label).cast("double").alias("y")))
    count = rows.count()
    width = len(rows.first().x)
    mean, deviation = np.zeros(width), np.ones(width)
    if standardise:
        moments = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.avg("v"), F.stddev_pop("v")).collect()
        for at, m, d in moments:
            mean[at], deviation[at] = m, d or 1.0
    blocks = _packed(rows, mean, deviation)
    nets = [Weights.random(width, h, seed, scale) for h in sizes]
    solvers = [lbfgs(n.flat(), steps) if solver == "lbfgs" else descent(n.flat(), steps, rate, momentum) for n in nets]
    costs: list[list[float]] = [[] for _ in sizes]
    asked = {}
    for i, run in enumerate(solvers):
        _advance(run, None, i, asked, nets)
    while asked:
        at = sorted(asked)
        for i, flat in zip(at, _sums(blocks, [nets[i].of(asked[i]) for i in at], width)):
            cost, gradient = float(flat[-1]) / count, flat[:-1] / count
            costs[i].append(cost)
            _advance(solvers[i], (cost, gradient), i, asked, nets)
    return [Weights(n.w1 / deviation, n.b1 - n.w1 @ (mean / deviation), n.w2, n.b2) for n in nets], costs


def _advance(run, answer, i: int, asked: dict, nets: list[Weights]) -> None:
    """Give a solver its answer; note the point it asks for next, or the network it ends with."""
    try:
        asked[i] = run.send(answer)
    except StopIteration as done:
        asked.pop(i, None)
        nets[i] = nets[i].of(done.value)


def probability(net: Weights, features: str):
    """Column with the probability of class 1."""
    @F.pandas_udf(DoubleType())
    def forward(x: pd.Series) -> pd.Series:
        return pd.Series(net.forward(np.stack(x.to_numpy()))[1]) if len(x) else pd.Series([], dtype="float64")

    return forward(features)
