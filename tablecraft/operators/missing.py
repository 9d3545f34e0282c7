"""Reports on and repairs of missing values (NULL)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.operators.dense import knn_partial
from tablecraft.operators.select import columns_of
from tablecraft.plans.lineage import materialize
from tablecraft.plans.quantiles import percentiles
from tablecraft.plans.reduce import FACTOR, along_a_tree, one_row

ROUNDS = 10


def null_counts(df: DataFrame) -> DataFrame:
    """One row: total rows and missing values per column, from one scan."""
    return df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def missing_rate(df: DataFrame) -> DataFrame:
    """Count and whole percentage (half to even) of missing values, columns with some only."""
    long = null_counts(df).unpivot(["_rows"], df.columns, "column", "missing")
    return (long.filter("missing > 0")
            .select("column", "missing", F.bround(F.col("missing") * 100 / F.col("_rows"), 0).alias("percent"))
            .orderBy(F.desc("percent"), "column"))


def missing_rate_two(train: DataFrame, test: DataFrame) -> DataFrame:
    sides = [missing_rate(df).select("column", F.col("percent").alias(name))
             for df, name in ((train, "train"), (test, "test"))]
    return sides[0].join(sides[1], "column", "full_outer")


def drop_null_columns(df: DataFrame, how: str = "any", thresh: int | None = None) -> DataFrame:
    """Drop columns with any / only missing values, or fewer than ``thresh`` present ones."""
    counts = null_counts(df).first().asDict()
    rows = counts.pop("_rows")
    if thresh is not None:
        drop = [c for c, n in counts.items() if rows - n < thresh]
    else:
        drop = [c for c, n in counts.items() if (n == rows if how == "all" else n > 0)]
    return df.drop(*drop)


def drop_high_missing(df: DataFrame, share: float = 0.5) -> DataFrame:
    counts = null_counts(df).first().asDict()
    rows = counts.pop("_rows")
    return df.drop(*[c for c, n in counts.items() if n > share * rows])


def impute_mean_median(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """``plan``: column -> mean | median | mode; one scalar per column, filled in place."""
    out = df
    for column, kind in plan.items():
        if kind == "mean":
            fill = df.agg(F.avg(column)).scalar()
        elif kind == "median":
            fill = percentiles(df, [], column, {"m": 0.5}).scalar()
        else:
            counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
            fill = counts.agg(F.min(F.struct(-F.col("count"), F.col(column).alias("v")))["v"]).scalar()
        out = out.withColumn(column, F.coalesce(F.col(column), fill))
    return out


def row_backfill(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill a missing cell from the next column to the right."""
    return df.withColumns({c: F.coalesce(*columns[i:]) for i, c in enumerate(columns[:-1])})


def censored_fill(value: Column, censored: Column, limit: Column, spread: Column | None = None) -> Column:
    """Values below detection become the limit, or a share (0..1) of it."""
    return F.when(censored, limit * spread if spread is not None else limit).otherwise(value)


class IterativeImputer:
    """Regress each incomplete column on the others in turn, rounds over.

    Columns with fewer gaps go first; gaps start at the column mean. Fitted on one
    table, applied to any other.

    Among rows with the same pattern of gaps, every filled value is a linear function
    of the values that are there. So the rows are read once, to sum products per pattern; a step
    then turns each pattern's sums into those of its filled rows, where the pattern is, and adds them up along a tree.
    Patterns may be as many as there are rows: only (columns x columns) sums reach the driver. A column without any value stays empty.
    """

    def __init__(self, columns: list[str], rounds: int = ROUNDS, tolerance: float = 1e-10):
        self.columns, self.rounds, self.tolerance = columns, rounds, tolerance
        self.means: dict[str, float] = {}
        self.steps: list[tuple[str, np.ndarray, float]] = []

    def fit(self, df: DataFrame) -> IterativeImputer:
        width = len(self.columns)
        self.means, self.steps = {}, []
        seen = [F.lit(1.0), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.columns]]
        gaps = F.array(*[F.col(c).isNull() for c in self.columns]).alias("gaps")
        pairs = [F.sum(seen[i] * seen[j]) for i in range(width + 1) for j in range(i, width + 1)]
        patterns = materialize(df.groupBy(gaps).agg(F.array(*pairs).alias("sums")))
        first = along_a_tree(_blocks(patterns, lambda g, s, _: np.stack([(~g * s[:, 0, :1]).sum(0), (~g * s[:, 0, 1:]).sum(0), np.full(width, s[:, 0, 0].sum())])),
                             _numbers, np.add)
        if first is None:
            return self
        present, sums, rows = first.reshape(3, width)
        means = np.divide(sums, present, out=np.full(width, np.nan), where=present > 0)
        self.means = {c: float(m) for c, m in zip(self.columns, means) if not np.isnan(m)}
        fills = np.nan_to_num(means)

        def start(g: np.ndarray, s: np.ndarray, _) -> np.ndarray:
            """A filled row is its pattern's map times (1, the values that are there)."""
            maps = np.tile(np.eye(width + 1), (len(g), 1, 1))
            maps[:, 1:][g] = 0.0
            maps[:, 1:, 0][g] = np.tile(fills, (len(g), 1))[g]
            return maps

        patterns = _mapped(patterns, start)
        turn = sorted((j for j in range(width) if 0 < present[j] < rows[j]), key=lambda j: (-present[j], self.columns[j]))
        last = None
        for _ in range(self.rounds if turn else 0):
            taken: list[tuple[int, np.ndarray]] = []
            for j in turn:
                others = [0, *[i + 1 for i in range(width) if i != j]]
                total = along_a_tree(_blocks(patterns, _filled_sums(j, list(taken))), _numbers, np.add).reshape(width + 1, width + 1)
                theta = np.linalg.lstsq(total[np.ix_(others, others)], total[others, j + 1], rcond=None)[0]
                self.steps.append((self.columns[j], theta[1:], float(theta[0])))
                taken.append((j, theta))
            patterns = _mapped(patterns, lambda g, _, maps, taken=taken: _moved(g, maps, taken))
            now = np.concatenate([theta for _, theta in taken])
            if last is not None and np.allclose(now, last, rtol=self.tolerance, atol=0):
                break
            last = now
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        rows = df.withColumns({f"_gap_{c}": F.col(c).isNull() for c in self.columns}).withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(self.means.get(c))) for c in self.columns})
        for column, weights, bias in self.steps:
            guess = F.lit(bias)
            for name, weight in zip((c for c in self.columns if c != column), weights):
                guess = guess + F.coalesce(F.col(name), F.lit(0.0)) * F.lit(float(weight))
            rows = rows.withColumn(column, F.when(F.col(f"_gap_{column}"), guess).otherwise(F.col(column)))
        return rows.drop(*[f"_gap_{c}" for c in self.columns])


def _unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Of each pattern in a batch: the gaps, the matrix of its sums, and its map if it has one."""
    gaps = np.array(batch.column(0).to_pylist(), dtype=bool)
    size = gaps.shape[1] + 1
    sums = np.zeros((len(gaps), size, size))
    up = np.triu_indices(size)
    sums[:, up[0], up[1]] = np.array(batch.column(1).to_pylist(), dtype=float)
    sums[:, up[1], up[0]] = sums[:, up[0], up[1]]
    maps = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(-1, size, size) if batch.num_columns > 2 else None
    return gaps, sums, maps


def _blocks(patterns: DataFrame, measure) -> DataFrame:
    """What ``measure`` makes of the patterns of a batch, as one array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield one_row("at numbers", ["int64", "binary"], 0, np.ascontiguousarray(measure(*_unpack(batch))).tobytes())

    return patterns.mapInArrow(run, FACTOR)


def _mapped(patterns: DataFrame, change) -> DataFrame:
    """The patterns with new maps, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                maps = change(*_unpack(batch))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([m.tobytes() for m in maps], "binary")], ["gaps", "sums", "maps"])

    return materialize(patterns.mapInArrow(run, "gaps array<boolean>, sums array<double>, maps binary"))


def _numbers(_: int, numbers: bytes) -> np.ndarray:
    return np.frombuffer(numbers)


def _moved(gaps: np.ndarray, maps: np.ndarray, taken: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """The maps after some steps: a gap's row is the regression of its column on the other rows."""
    maps = maps.copy()
    for j, theta in taken:
        others = [i for i in range(maps.shape[1]) if i != j + 1]
        at = np.flatnonzero(gaps[:, j])
        maps[at, j + 1] = np.einsum("o,pon->pn", theta, maps[at][:, others])
    return maps


def _filled_sums(column: int, taken: list[tuple[int, np.ndarray]]):
    """Sums of products of the filled rows that have the column."""
    def measure(gaps: np.ndarray, sums: np.ndarray, maps: np.ndarray) -> np.ndarray:
        at = ~gaps[:, column]
        now = _moved(gaps[at], maps[at], taken)
        return np.einsum("pab,pbc,pdc->ad", now, sums[at], now, optimize=True)

    return measure


def impute_knn(df: DataFrame, key: str, columns: list[str], k: int = 5) -> DataFrame:
    """Fill gaps with the mean over the k nearest complete rows.

    Distance runs over the columns a row does have; rows with any pattern of gaps share one search. A row without any
    value keeps its gaps, and so do all if no row is complete. Columns with gaps come back as doubles.
    """
    counts = null_counts(df.select(*columns)).first().asDict()
    gappy = [c for c in columns if counts[c]]
    point = F.array(*[F.col(c).cast("double") for c in columns])
    have = F.size(F.filter(point, lambda v: v.isNotNull()))
    complete = materialize(df.where(have == len(columns)).select(key, *columns))
    asked = df.where((have > 0) & (have < len(columns))).select(key, point.alias("_x"))
    near = knn_partial(asked, complete.select(key, point.alias("_x")), key, "_x", k)
    donors = complete.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"_f_{c}") for c in gappy])
    fills = near.join(donors, "neighbour").groupBy(F.col("id").alias("_row")).agg(*[F.avg(f"_f_{c}").alias(f"_f_{c}") for c in gappy])
    filled = df.join(fills, df[key] == fills["_row"], "left").withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(f"_f_{c}")) for c in gappy})
    return filled.select(*df.columns)


def numeric_gaps(df: DataFrame) -> list[str]:
    """Numeric columns with missing values."""
    counts = null_counts(df).first().asDict()
    return [c for c in columns_of(df, "numeric") if counts[c]]
