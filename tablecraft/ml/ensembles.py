"""Ensembles of trees, grown level by level: one pass a level sums the histograms of all trees and nodes.

Columns are cut into bins once and the binned rows written once. A pass sends a model of bounded size (trees times nodes)
to the rows, adds up a histogram for each (tree, node) inside the tasks, and finds the best split of a node where its
partial histograms meet. Only splits reach the driver. Which rows a tree draws is a hash of row key and tree.

Where the bins of all columns have few combinations, rows of equal bins are added up to cells first, with the weights that each
tree drew for them, and levels go over cells. A prediction is worked out once for a combination, not once for a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.lineage import materialize

#: Rows whose histograms are added up before they are sent on.
BLOCK = 1 << 16
#: Rows and trees that are walked at a time.
WALKED = 1 << 20
#: Numbers in the sums of all cells, and cells whose predictions are worked out beforehand, at most.
CELLS, ANSWERS = 1 << 23, 1 << 16
#: What all trees say of all combinations of bins is worked out beforehand, if it has that many numbers at most.
SAID = 1 << 20
#: Trees whose rows are drawn at a time, and bytes of cells that travel as one.
DRAWN, SLICE = 8, 1 << 18
#: Borders are taken from that many quantiles, or are all values if these are few.
QUANTILES = 1024

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(13)])


def as_array(features: str, df: DataFrame) -> Column:
    """Features as an array of doubles, whether they are an array or a vector."""
    kind = df.schema[features].dataType.typeName()
    return F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)


def borders(df: DataFrame, x: Column, bins: int) -> list[np.ndarray]:
    """Ascending cut values of each feature, fewer than ``bins``: all values if they are few, else quantiles. Behind the last are missing values."""
    cells = df.select(F.posexplode(x).alias("at", "v")).where("v is not null and not isnan(v)")
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    found = cells.groupBy("at").agg(F.percentile_approx("v", shares, 10_000).alias("q")).collect()
    out = [np.empty(0)] * (max((r["at"] for r in found), default=-1) + 1)
    for row in found:
        values = np.unique(row["q"])
        if len(values) >= bins:
            values = np.unique(np.array(row["q"])[np.linspace(0, QUANTILES, bins).astype(int)[1:]])
        out[row["at"]] = values
    return out


def _matrix(arrays: pa.ListArray, width: int) -> np.ndarray:
    """Rows of features; a missing value is not a number, a missing row all of them."""
    lengths = np.diff(arrays.offsets.to_numpy())
    if not arrays.null_count and (lengths == lengths[:1]).all() and lengths[:1].sum() >= width:
        return arrays.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(arrays), -1)[:, :width]
    rows = (np.full(width, np.nan) if a is None else np.array(a, dtype=float)[:width] for a in arrays.to_pylist())
    return np.array(list(rows)).reshape(len(arrays), width)


def _cut(rows: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(rows, features) bins as bytes."""
    out = np.empty(rows.shape, dtype=np.uint8)
    for i, c in enumerate(cuts):
        out[:, i] = np.searchsorted(c, rows[:, i])
    return out


def _as_binary(bins: np.ndarray) -> pa.Array:
    rows, width = bins.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


def binned(df: DataFrame, x: Column, cuts: list[np.ndarray], *keep: Column) -> DataFrame:
    """The kept columns and ``x``, a byte for each feature: its bin. Missing values are in the last bin, beyond all borders."""
    @F.arrow_udf("binary")
    def cut(values: pa.Array) -> pa.Array:
        return _as_binary(_cut(_matrix(values, len(cuts)), cuts))

    rows = df.select(*keep, cut(x).alias("x"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return materialize(rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores))


def _codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Number of each row's combination of bins."""
    code = np.zeros(len(x), dtype=np.int64)
    for i, c in enumerate(cuts):
        code = code * (len(c) + 1) + x[:, i]
    return code


def _of_codes(codes: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bins of combinations."""
    x = np.empty((len(codes), len(cuts)), dtype=np.uint8)
    for i in range(len(cuts) - 1, -1, -1):
        codes, x[:, i] = np.divmod(codes, len(cuts[i]) + 1)
    return x


def _combinations(cuts: list[np.ndarray]) -> int:
    return math.prod(len(c) + 1 for c in cuts)


def cells(rows: DataFrame, cuts: list[np.ndarray], classes: int, wide: int, drawing=None) -> DataFrame:
    """(h, y, x, numbers): rows (y, v[, w or h]) of equal bins of ``v``, and class if there are ``classes``, added up: the weights of ``wide`` trees
    (one stands for all), without classes also weight times y. ``drawing`` gives the weights of rows with hash h, some trees at a time.
    Sums are added inside tasks, then where the slices of the tasks meet."""
    many, channels = max(1, classes), 1 if classes else 2
    total, size = _combinations(cuts) * many, max(1, min(1 << 12, SLICE // (8 * channels * wide)))

    def weights(table: pa.Table) -> Iterator[np.ndarray | None]:
        if drawing is None:
            yield from _lists(table.column("w"), wide).T if "w" in table.column_names else [None]
            return
        h = table.column("h").to_numpy()
        for start in range(0, wide, DRAWN):
            yield from np.ascontiguousarray(drawing(h, None, start, min(start + DRAWN, wide)).T)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((wide, channels, total))
        for table in _blocks(batches):
            y = table.column("y").to_numpy()
            x = _cut(_matrix(table.column("v").combine_chunks(), len(cuts)), cuts)
            code = _codes(x, cuts) * many + (y.astype(np.int64) if classes else 0)
            for tree, w in enumerate(weights(table)):
                sums[tree, 0] += np.bincount(code, w, total)
                if not classes:
                    sums[tree, 1] += np.bincount(code, y if w is None else w * y, total)
        for start in range(0, total, size):
            part = np.ascontiguousarray(sums[:, :, start:start + size].transpose(2, 1, 0))
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([start], "int64"), pa.array([part.tobytes()], "binary")], ["start", "sums"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for start, numbers in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(numbers.as_py())
                sums[start] = sums[start] + part if start in sums else part
        for start, part in sums.items():
            part = part.reshape(-1, channels, wide)
            filled = np.flatnonzero((part[:, 0] > 0).any(axis=1))
            codes = start + filled
            numbers = [part[i].tobytes() for i in filled]
            yield pa.RecordBatch.from_arrays([pa.array(codes, "int64"), pa.array((codes % many).astype(float)), _as_binary(_of_codes(codes // many, cuts)),
                                              pa.array(numbers, "binary")], ["h", "y", "x", "numbers"])

    parts = rows.mapInArrow(add_up, "start bigint, sums binary")
    return materialize(parts.repartition("start").mapInArrow(meet, "h bigint, y double, x binary, numbers binary"))


def drawn(keys: np.ndarray, trees: np.ndarray, replace: bool, share: float) -> np.ndarray:
    """(rows, trees) times that a tree has a row: a Poisson number of mean one, or one with the given share."""
    mixed = keys.view(np.uint64)[:, None] + (trees.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    uniform = (mixed >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_POISSON, uniform, side="right").astype(float) if replace else (uniform < share).astype(float)


@dataclass
class Nodes:
    """Trees as heaps: children of node n are 2n + 1 and 2n + 2. ``feature`` is -1 where a node is not split."""

    feature: np.ndarray  # (trees, nodes)
    bin: np.ndarray
    value: np.ndarray  # (trees, nodes, channels): sums of the rows in a node

    @staticmethod
    def empty(trees: int, depth: int, channels: int) -> Nodes:
        many = (1 << (depth + 1)) - 1
        return Nodes(np.full((trees, many), -1, dtype=np.int32), np.zeros((trees, many), dtype=np.uint8), np.zeros((trees, many, channels)))

    def reached(self, x: np.ndarray, steps: int) -> np.ndarray:
        """(rows, trees) node of each binned row after at most that many splits."""
        trees, rows = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int32)
        for _ in range(steps):
            feature = self.feature[trees, node]
            right = x[rows, feature] > self.bin[trees, node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node

    def some(self, start: int, end: int) -> Nodes:
        return Nodes(self.feature[start:end], self.bin[start:end], self.value[start:end])


def _packed(table: np.ndarray) -> bytes:
    """A histogram as bytes: its filled cells only, if these are few."""
    filled = np.flatnonzero(table)
    if 3 * len(filled) > 2 * table.size:
        return b"d" + table.tobytes()
    return b"s" + filled.astype(np.int32).tobytes() + table[filled].tobytes()


def _add(total: np.ndarray, packed: bytes) -> None:
    if packed[:1] == b"d":
        total += np.frombuffer(packed, offset=1)
        return
    count = (len(packed) - 1) // 12
    at = np.frombuffer(packed, dtype=np.int32, count=count, offset=1)
    total[at] += np.frombuffer(packed, count=count, offset=1 + 4 * count)


class Gini:
    """Classes: a channel of weight for each."""

    def __init__(self, classes: int):
        self.channels = classes

    @staticmethod
    def score(sums: np.ndarray) -> np.ndarray:
        weight = sums.sum(axis=-1)
        return np.divide((sums * sums).sum(axis=-1), weight, out=np.zeros_like(weight), where=weight > 0)

    @staticmethod
    def weight(sums: np.ndarray) -> np.ndarray:
        return sums.sum(axis=-1)


class Entropy(Gini):
    @staticmethod
    def score(sums: np.ndarray) -> np.ndarray:
        def nlogn(v: np.ndarray) -> np.ndarray:
            return v * np.log(np.where(v > 0, v, 1.0))

        return nlogn(sums).sum(axis=-1) - nlogn(sums.sum(axis=-1))


class Variance:
    """Numbers: channels weight, weighted sum [, and whatever a caller adds up beside]."""

    def __init__(self, channels: int = 2):
        self.channels = channels

    @staticmethod
    def score(sums: np.ndarray) -> np.ndarray:
        weight = sums[..., 0]
        return np.divide(sums[..., 1] ** 2, weight, out=np.zeros_like(weight), where=weight > 0)

    @staticmethod
    def weight(sums: np.ndarray) -> np.ndarray:
        return sums[..., 0]


def best_split(table: np.ndarray, kind, least: float) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray] | None:
    """(place of the feature, bin, sums of the node, left, right) of the split that gains most; the first one on ties."""
    left = table.cumsum(axis=1)
    node = left[0, -1]
    left = left[:, :-1]
    right = node - left
    score = kind.score(left) + kind.score(right)
    fits = (kind.weight(left) >= least) & (kind.weight(right) >= least)
    score = np.where(fits, score, -np.inf)
    if not score.size or not fits.any():
        return None
    best, base = score.max(), kind.score(node)
    if best <= base + 1e-9 * max(abs(base), 1e-12):
        return None
    # sums of other orders differ in their last digits; the first of those that tie is taken
    at = int(np.argmax(score >= best - 1e-12 * abs(best)))
    place, cut = divmod(at, score.shape[1])
    return place, cut, node, left[place, cut], right[place, cut]


def _histograms(x: np.ndarray, nodes: Nodes, level: int, of: np.ndarray, bins: int, weights, channels: int, first: int) -> Iterator[tuple[int, int, bytes]]:
    """(tree, node, packed histogram) over a block. ``weights(start, end)`` gives per row, tree and channel what to add up, or (weight, class)."""
    width, begin = of.shape[1], (1 << level) - 1
    step = max(1, WALKED // max(1, len(x)))
    for start in range(0, len(of), step):
        end = min(start + step, len(of))
        reached = nodes.some(start, end).reached(x, level) - begin
        added, classes = weights(start, end)
        for t in range(end - start):
            heavy = added[:, t] > 0 if classes is not None else added[0][:, t] > 0
            rows = np.flatnonzero(heavy & (reached[:, t] >= 0))
            if not len(rows):
                continue
            at = (reached[rows, t][:, None] * width + np.arange(width)) * bins + x[rows][:, of[start + t]]
            size = (begin + 1) * width * bins
            if classes is not None:
                table = np.bincount((at * channels + classes[rows][:, None]).ravel(), np.repeat(added[rows, t], width), size * channels)
            else:
                table = np.stack([np.bincount(at.ravel(), np.repeat(a[rows, t], width), size) for a in added], axis=1).ravel()
            for node, part in enumerate(table.reshape(begin + 1, -1)):
                if part.any():
                    yield first + start + t, begin + node, _packed(part)


def _splits(parts: DataFrame, of: np.ndarray, bins: int, kind, least: float, node_draw=None) -> pd.DataFrame:
    """One row for each (tree, node) that has rows: its sums, and feature, bin and sums of both children if it is split.

    ``node_draw(tree, node, width)`` gives the places of the columns that may split a node, if not all may."""
    width, channels = of.shape[1], kind.channels

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, out = None, None, []

        def close() -> None:
            table = total.reshape(width, bins, channels)
            places = node_draw(*current, width) if node_draw else np.arange(width)
            found = best_split(table[places], kind, least)
            node = table[0].sum(axis=0)
            if found is None:
                out.append((*current, -1, 0, node.tolist(), [], []))
            else:
                place, cut, _, left, right = found
                out.append((*current, int(of[current[0], places[place]]), cut, node.tolist(), left.tolist(), right.tolist()))

        for batch in batches:
            for tree, node, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (tree, node) != current:
                    if current is not None:
                        close()
                    current, total = (tree, node), np.zeros(width * bins * channels)
                _add(total, packed)
        if current is not None:
            close()
        kinds = ["int32", "int32", "int32", "int32", *[pa.list_(pa.float64())] * 3]
        names = ["tree", "node", "feature", "bin", "sums", "low", "high"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    schema = "tree int, node int, feature int, bin int, sums array<double>, low array<double>, high array<double>"
    return parts.repartition("tree", "node").sortWithinPartitions("tree", "node", "block").mapInArrow(meet, schema).toPandas()


def _enter(nodes: Nodes, splits: pd.DataFrame) -> None:
    """Put the splits of a level into the trees."""
    for tree, node, feature, cut, sums, low, high in splits.itertuples(index=False):
        nodes.value[tree, node] = sums
        if feature >= 0:
            nodes.feature[tree, node], nodes.bin[tree, node] = feature, cut
            nodes.value[tree, 2 * node + 1], nodes.value[tree, 2 * node + 2] = low, high


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= BLOCK:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def _bytes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _lists(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """(rows, width) numbers of a column of lists."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), -1)[:, :width]


class Forest:
    """Many trees, each on rows of its own (with replacement or a share of them) and, if wanted, columns of its own.

    ``columns`` columns are drawn for each tree, all if it is missing, and ``node_columns`` of these again for each node. A row is known by its
    ``key``, one column or several. ``weights`` (an array column with a weight for each tree) replaces the
    drawing. Rows without a label are not learned from. Missing values are larger than all others. ``classes`` labels are 0, 1, 2 ...; without
    it labels are numbers. Trees vote with their leaf's most frequent class (the smaller one on ties) or average their leaves' means.
    """

    def __init__(self, key: str | list[str], trees: int = 500, depth: int = 5, classes: bool = True, replace: bool = True, share: float = 0.5,
                 columns: int | None = None, bins: int = 32, criterion: str = "gini", least: float = 1.0, weights: Column | None = None, seed: int = 0,
                 node_columns: int | None = None):
        self.node_columns, self.kind = node_columns, Variance()
        self.key, self.trees, self.depth, self.classes, self.replace, self.share = key, trees, depth, classes, replace, share
        self.columns, self.bins, self.criterion, self.least, self.weights, self.seed = columns, bins, criterion, least, weights, seed
        self.cuts: list[np.ndarray] = []
        self.of = np.empty((0, 0), dtype=np.int64)
        self.nodes = Nodes.empty(0, 0, 0)

    def _given(self) -> list[Column]:
        """Hash and given weights of a row. Weights keep their type until they are in numpy: a cast of a long array costs far more than the array."""
        given = F.lit(None).cast("array<double>") if self.weights is None else self.weights
        return [self._hash(), given.alias("w")]

    def _hash(self) -> Column:
        return F.xxhash64(*([self.key] if isinstance(self.key, str) else self.key), F.lit(self.seed)).alias("h")

    def _weights(self):
        """What gives the weights of rows (hashes, given weights) for trees start to end; it travels to the tasks."""
        fixed, replace, share = self.weights is not None, self.replace, self.share

        def weights(h: np.ndarray, w: np.ndarray | None, start: int, end: int) -> np.ndarray:
            if fixed:
                return w[:, start:end]
            return drawn(h, np.arange(start, end), replace, share)

        return weights

    def _all_rows(self) -> bool:
        """Whether every tree has every row once."""
        return self.weights is None and not self.replace and self.share >= 1

    def drawn_columns(self, width: int) -> np.ndarray:
        """(trees, columns) ascending columns of each tree."""
        draw, chosen = np.random.default_rng(self.seed), min(self.columns or width, width)
        return np.array([np.sort(draw.permutation(width)[:chosen]) for _ in range(self.trees)], dtype=np.int64).reshape(self.trees, chosen)

    def _node_draw(self):
        """What gives the places of the columns that a node may be split by, or nothing if all may."""
        some, seed = self.node_columns, self.seed
        return some and (lambda tree, node, width: np.sort(np.random.default_rng((seed, tree, node)).permutation(width)[:some]))

    def importances(self) -> np.ndarray:
        """What splits by each column gain, as shares of each tree's gain, averaged over the trees that have a split."""
        nodes, kind = self.nodes, self.kind
        total = np.zeros(len(self.cuts))
        for feature, value in zip(nodes.feature, nodes.value):
            at = np.flatnonzero(feature >= 0)
            gain = kind.score(value[2 * at + 1]) + kind.score(value[2 * at + 2]) - kind.score(value[at])
            if gain.sum() > 0:
                total += np.bincount(feature[at], gain, len(total)) / gain.sum()
        return total / total.sum() if total.any() else total

    def fit(self, df: DataFrame, features: str = "features", label: str = "label") -> Forest:
        known = df.where(F.col(label).isNotNull())
        x, y = as_array(features, df), F.col(label).cast("double").alias("y")
        self.cuts = borders(known, x, self.bins)
        width = len(self.cuts)
        self.of = self.drawn_columns(width)
        if self.classes:
            many = int((known.agg(F.max(F.col(label).cast("double"))).first()[0] or 0) + 1)
            kind = (Entropy if self.criterion == "entropy" else Gini)(many)
        else:
            many, kind = 0, Variance()
        self.kind = kind
        wide = 1 if self._all_rows() else self.trees
        small = 0 < wide * _combinations(self.cuts) * max(2, many) <= CELLS
        if small:
            by_hash = self.weights is None and not self._all_rows()
            given = [self._hash()] if by_hash else [] if self.weights is None else [self.weights.alias("w")]
            more = [self._weights()] if by_hash else []
            rows = cells(known.select(y, x.alias("v"), *given), self.cuts, many, wide, *more)
        else:
            rows = binned(known, x, self.cuts, *self._given(), y)
        self.nodes = nodes = Nodes.empty(self.trees, self.depth, kind.channels)
        of, bins, classes, drawing, trees, fixed = self.of, self.bins, self.classes, self._weights(), self.trees, self.weights is not None

        for level in range(self.depth if width else 0):
            def partial(batches: Iterator[pa.RecordBatch], level=level, now=nodes) -> Iterator[pa.RecordBatch]:
                for table in _blocks(batches):
                    h, y = table.column("h").to_numpy(), table.column("y").to_numpy()
                    if small:
                        sums = np.frombuffer(b"".join(table.column("numbers").to_pylist())).reshape(len(y), -1, wide)
                    else:
                        w = _lists(table.column("w"), trees) if fixed else None

                    def weights(start: int, end: int):
                        if small:
                            of_tree = [np.broadcast_to(s, (len(y), end - start)) if wide == 1 else s[:, start:end] for s in sums.transpose(1, 0, 2)]
                            return (of_tree[0], y.astype(int)) if classes else (of_tree, None)
                        times = drawing(h, w, start, end)
                        return (times, y.astype(int)) if classes else ((times, times * y[:, None]), None)

                    found = _histograms(_bytes(table.column("x"), width), now, level, of, bins, weights, kind.channels, 0)
                    yield from _as_batches(found, int(h[0]))

            parts = rows.mapInArrow(partial, PARTS)
            splits = _splits(parts, of, bins, kind, self.least, self._node_draw())
            _enter(nodes, splits)
            if not (splits["feature"] >= 0).any():
                break
        return self

    def transform(self, df: DataFrame, features: str = "features", unseen_only: bool = False, prediction: str = "prediction") -> DataFrame:
        """Add the ensemble's prediction; ``unseen_only`` asks only trees that did not have the row, and gives null where all had it."""
        nodes, cuts, classes, drawing = self.nodes, self.cuts, self.classes, self._weights()
        leaf = nodes.value.argmax(axis=2) if classes else np.divide(nodes.value[..., 1], nodes.value[..., 0], out=np.zeros(nodes.value.shape[:2]), where=nodes.value[..., 0] > 0)
        grown = nodes.value[..., 0] > 0 if not classes else nodes.value.sum(axis=2) > 0
        many, width, trees = nodes.value.shape[2], len(cuts), self.trees
        depth = self.depth if width else 0
        step = max(1, WALKED // max(1, trees))
        fixed = self.weights is not None

        def asked_trees(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            node = nodes.reached(x, depth)
            at = np.arange(trees)[None, :]
            return leaf[at, node], grown[at, node]

        def answers(x: np.ndarray, unseen: np.ndarray | None = None) -> np.ndarray:
            said, asked = asked_trees(x) if each is None else (a[_codes(x, cuts)] for a in each)
            if unseen is not None:
                asked = asked & unseen
            if classes:
                votes = np.stack([np.count_nonzero((said == k) & asked, axis=1) for k in range(many)], axis=1)
                return np.where(votes.any(axis=1), votes.argmax(axis=1), np.nan)
            count = asked.sum(axis=1)
            return np.divide(np.where(asked, said, 0).sum(axis=1), count, out=np.full(len(x), np.nan), where=count > 0)

        def in_steps(x: np.ndarray, unseen=lambda start, end: None) -> np.ndarray:
            parts = [answers(x[start:start + step], unseen(start, start + step)) for start in range(0, len(x), step)]
            return np.concatenate(parts) if parts else np.empty(0)

        known = each = None
        if width and not unseen_only and _combinations(cuts) <= ANSWERS:
            known = in_steps(_of_codes(np.arange(_combinations(cuts)), cuts))
        elif width and unseen_only and _combinations(cuts) * trees <= SAID:
            each = asked_trees(_of_codes(np.arange(_combinations(cuts)), cuts))
            each = (each[0].astype(np.min_scalar_type(max(many - 1, 1))) if classes else each[0], each[1])

        def bins_of(values: pa.Array) -> np.ndarray:
            return _cut(_matrix(values, width), cuts)

        def numbers(found: np.ndarray) -> pa.Array:
            return pa.array(found, mask=np.isnan(found))

        @F.arrow_udf("double")
        def predict(values: pa.Array) -> pa.Array:
            x = bins_of(values)
            return numbers(in_steps(x) if known is None else known[_codes(x, cuts)])

        @F.arrow_udf("double")
        def predict_unseen(values: pa.Array, h: pa.Array, w: pa.Array) -> pa.Array:
            keys, given = h.to_numpy(), _lists(w, trees) if fixed else None
            return numbers(in_steps(bins_of(values), lambda a, b: drawing(keys[a:b], given if given is None else given[a:b], 0, trees) == 0))

        features = as_array(features, df)
        return df.withColumn(prediction, predict_unseen(features, *self._given()) if unseen_only else predict(features))

    def oob_score(self, df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
        """Share of right votes (or mean squared error) of the trees that did not have a row, and how many rows have such trees."""
        rows = self.transform(df, features, unseen_only=True).where("prediction is not null")
        miss = F.col("prediction") - F.col(label)
        measure = F.avg((miss == 0).cast("double")).alias("oob_accuracy") if self.classes else F.avg(miss * miss).alias("oob_mse")
        return rows.agg(measure, F.count(F.lit(1)).alias("rows"))


PARTS = "tree int, node int, block bigint, packed binary"


def _as_batches(found: Iterator[tuple[int, int, bytes]], block: int) -> Iterator[pa.RecordBatch]:
    """Histograms as batches of some megabytes."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        tree, node, packed = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(tree, "int32"), pa.array(node, "int32"), pa.array([block] * len(held), "int64"),
                                           pa.array(packed, "binary")], ["tree", "node", "block", "packed"])

    for row in found:
        held.append(row)
        size += len(row[2])
        if size > 1 << 24:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()
