"""Approximate nearest neighbours by cosine: NN-descent builds a graph of all vectors, greedy search walks it."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.simhash import whole_cells
from tablecraft.plans.lineage import materialize

#: Neighbours that a node keeps in the graph, and vectors that a block of the first, rough graph holds.
DEGREE, BLOCK = 48, 256
#: Rough graphs from which the descent starts at least; more by the logarithm of the vectors.
STARTS = 4
#: The descent ends when a round changes less than this share of the edges; one that has not settled, or a search
#: that has not ended, after so many rounds for each doubling of the vectors is an error.
SETTLED, GUARD = 0.02, 8
#: Reverse neighbours of a node that meet in one local join.
MEETING = 64
#: Nodes that a search keeps for a query at least; more by the logarithm of the vectors.
BEAM = 64


def sizes(count: int) -> tuple[int, int, int]:
    """Rough graphs, beam and most rounds for so many vectors."""
    doublings = math.ceil(math.log2(max(count, 2)))
    return max(STARTS, math.ceil(doublings / 3)), max(BEAM, 6 * doublings), GUARD * doublings


def usable(vector: str) -> Column:
    """True for a vector with finite components only, not all of them zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vector: str) -> Column:
    """A usable vector in doubles, divided by a power of two near its largest component.

    That is exact, leaves every cosine as it is to the last digit, and keeps squares of very large or tiny components
    finite and above zero.
    """
    doubles = F.transform(vector, lambda x: x.cast("double"))
    power = F.floor(F.log2(F.array_max(F.transform(doubles, lambda x: F.abs(x)))))
    by = F.pow(F.lit(2.0), -F.greatest(F.least(power, F.lit(1000)), F.lit(-1000)))
    return F.zip_with(doubles, F.array_repeat(by, F.size(vector)), lambda x, y: x * y)  # worked out once a vector


def distinct_vectors(rows: DataFrame, key: str, vector: str, ids: int) -> DataFrame:
    """(node, vector, code, length, ids): equal vectors once (scaled, so that doubling makes no other vector), with the ``ids`` smallest keys of those that have it.

    Only vectors of the commonest dimension take part (of the larger, if two are equally common), and only rows
    with a key. Ties between equal vectors go to the smallest keys, so a result never needs more of
    them; the window keeps that many per vector and task before it is shuffled.
    """
    good = rows.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).alias("id"), scaled(vector).alias("vector"))
    size = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    good = good.where(F.size("vector") == (size["n"] if size else 0)).distinct()
    first = good.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("place") <= ids)
    grouped = first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))

    @F.pandas_udf("binary")
    def coded(batch: pd.Series) -> pd.Series:
        if not len(batch):
            return pd.Series([], dtype=object)
        v = np.stack(batch.to_list()).astype(np.float64)
        v /= np.abs(v).max(axis=1, keepdims=True)
        return pd.Series([row.tobytes() for row in np.rint(v * 127).astype(np.int8)])

    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return materialize(grouped.select("vector", coded("vector").alias("code"), length.alias("length"), "ids")).withColumn(
        "node", F.monotonically_increasing_id())


def _unit(codes: pd.Series) -> np.ndarray:
    """Vectors of length one from their 8-bit codes, which serve to build the graph and nothing else."""
    v = np.frombuffer(b"".join(codes), dtype=np.int8).reshape(len(codes), -1).astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """The nearest ``degree`` neighbours of each node; ties to the smaller neighbour. ``new``: not known before.

    The edges are dealt out by node once, for the repeated ones to be merged and the rest to be ranked.
    """
    ranked = Window.partitionBy("node").orderBy(F.desc("near"), "other")
    return (edges.repartition("node").groupBy("node", "other").agg(F.max("near").alias("near"), F.min("new").alias("new"))
            .withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= degree).drop("place"))


def rough_graph(points: DataFrame, count: int, degree: int, starts: int) -> DataFrame:
    """Edges inside blocks of points on the same side of random planes; each start has planes of its own.

    Crowded cells are cut into blocks by hash, so a block has about ``BLOCK`` points however they lie.
    """
    bits = max(0, int(np.ceil(np.log2(max(count / BLOCK, 1)))))

    @F.pandas_udf("array<long>")
    def cells(batch: pd.Series) -> pd.Series:
        v, weight = _unit(batch), 1 << np.arange(bits, dtype=np.int64)
        out = [((v @ np.random.default_rng(s).normal(size=(v.shape[1], bits)).astype(np.float32)) > 0) @ weight if bits else
               np.zeros(len(v), dtype=np.int64) for s in range(starts)]
        return pd.Series(list(np.stack(out, axis=1)))

    placed = points.select("node", "code", F.posexplode(cells("code")).alias("start", "cell"))
    crowds = placed.groupBy("start", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = placed.join(crowds, ["start", "cell"]).select(
        F.xxhash64("start", "cell", F.pmod(F.xxhash64("node", "start"), "blocks")).alias("cell"), "node", "code")

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_cells(batches, "cell", 1 << 13):
            node, v = rows["node"].to_numpy(), _unit(rows["code"])
            for a, b in _spans(rows["cell"].to_numpy()):
                near = v[a:b] @ v[a:b].T
                np.fill_diagonal(near, -2)
                keep = min(degree, b - a - 1)
                if keep < 1:
                    continue
                others = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                yield pd.DataFrame({"node": np.repeat(node[a:b], keep), "other": node[a:b][others].ravel(),
                                    "near": np.take_along_axis(near, others, axis=1).ravel()})

    return blocks.repartition("cell").sortWithinPartitions("cell").mapInPandas(nearest, "node long, other long, near float")


def _spans(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def _meetings(graph: DataFrame, points: DataFrame, turn: int = 0) -> DataFrame:
    """(node, other, near): pairs of neighbours of a common node that are nearer than what either has.

    Every node's neighbours, and the nodes that have it as theirs, meet around it. A node that very
    many others have as a neighbour holds several meetings; its own neighbours attend all of them. The others are
    dealt to them anew in each turn, so that two who missed each other meet in a later one.
    """
    asked = graph.groupBy(F.col("other").alias("host")).agg(F.ceil(F.count("*") / MEETING).alias("rooms"))
    own = graph.select(F.col("node").alias("host"), F.col("other").alias("guest")).join(asked, "host", "left").select(
        "host", "guest", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("rooms", F.lit(1)) - 1)).alias("room"))
    back = graph.select(F.col("other").alias("host"), F.col("node").alias("guest")).join(asked, "host").select(
        "host", "guest", F.pmod(F.xxhash64("guest", F.lit(turn)), "rooms").alias("room"))
    worst = graph.groupBy("node").agg(F.min("near").alias("worst"))
    hosts = own.select("host", F.col("host").alias("guest"), "room").distinct()
    guests = own.union(back).union(hosts).select(F.xxhash64("host", "room").alias("cell"), F.col("guest").alias("node"))
    cells = guests.join(points.select("node", "code").join(worst, "node"), "node")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_cells(batches, "cell", 1 << 14):
            node, v, worst_near = rows["node"].to_numpy(), _unit(rows["code"]), rows["worst"].to_numpy()
            found = []
            for a, b in _spans(rows["cell"].to_numpy()):
                _, own = np.unique(node[a:b], return_index=True)  # some are neighbours both ways
                some = a + own
                near = v[some] @ v[some].T
                np.fill_diagonal(near, -2)
                i, j = np.nonzero(near > worst_near[some, None] + 1e-6)
                found.append((node[some[i]], node[some[j]], near[i, j]))
            yield pd.DataFrame({k: np.concatenate(c) for k, c in zip(("node", "other", "near"), zip(*found))})

    return cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(meet, "node long, other long, near float")


def neighbour_graph(points: DataFrame, degree: int = DEGREE, starts: int | None = None, most: int | None = None) -> DataFrame:
    """(node, other, near): for each point its approximately nearest ``degree`` others.

    Rounds follow each other until one settles. More than ``most`` of them are an error, never a graph that is cut short.
    """
    count = points.count()
    grown, _, guard = sizes(count)
    graph = materialize(_best(rough_graph(points, count, degree, starts or grown).withColumn("new", F.lit(True)), degree))
    changed, turn, most = count > BLOCK, 0, guard if most is None else most
    while changed:
        if turn >= most:
            raise RuntimeError(f"the neighbour graph of {count} vectors has not settled after {turn} rounds")
        known, met = graph.withColumn("new", F.lit(False)), _meetings(graph, points, turn).withColumn("new", F.lit(True))
        graph, turn = materialize(_best(known.unionByName(met), degree)), turn + 1
        changed = graph.where("new").count() >= SETTLED * degree * count
    return graph.drop("new")


def greedy_search(graph: DataFrame, points: DataFrame, queries: DataFrame, beam: int = BEAM, most: int = 64) -> DataFrame:
    """(query, node, near) from (query, vector, length, node): the nearest found, at most ``beam`` for each query.

    A search starts at the given nodes. In each step it looks at the neighbours, both ways, of all nodes
    that it keeps and has not left yet, and keeps the nearest. It ends when none of them is new; more steps than ``most`` are an error.
    """
    ways = materialize(graph.select("node", "other").union(graph.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    asked = queries.select("query", F.col("vector").alias("q_vector"), F.col("length").alias("q_length")).dropDuplicates(["query"])
    place = points.select(F.col("node"), "vector", "length")
    dot = F.aggregate(F.zip_with("q_vector", "vector", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    kept = Window.partitionBy("query").orderBy(F.desc("near"), "node")

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.join(place, "node").join(asked, "query").select("query", "node", (dot / (F.col("q_length") * F.col("length"))).alias("near"), F.lit(True).alias("new"))

    state = materialize(scored(queries.select("query", "node").distinct()))
    for _ in range(most):
        fresh = (state.where("new").select("query", "node").join(ways, "node").select("query", F.col("other").alias("node")).distinct()
                 .join(state.select("query", "node"), ["query", "node"], "left_anti"))
        both = state.withColumn("new", F.lit(False)).union(scored(fresh))
        state = materialize(both.withColumn("place", F.row_number().over(kept)).where(F.col("place") <= beam).drop("place"))
        if state.where("new").isEmpty():
            return state.drop("new")
    raise RuntimeError(f"a search has not ended after {most} steps")


def nearest(rows: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", beam: int | None = None) -> DataFrame:
    """(query_id, rank, key, score): for each row that ``queries`` picks, the k nearest other rows that were found.

    Every row is in the graph. Scores are cosines of the original vectors in double precision, highest first, ties to
    the smaller key. A query's own key is no candidate, copies of its vector under other keys are. Rows without
    key, and vectors that are missing, zero, not finite or of another dimension, take no part; repeated rows
    count once; with fewer than k candidates all are given. The beam grows with the vectors unless it is given.
    """
    points = distinct_vectors(rows, key, vector, k + 1)
    graph = neighbour_graph(points)
    wanted = rows.where(F.coalesce(queries, F.lit(False)) & F.col(key).isNotNull() & usable(vector)).select(
        F.col(key).alias("query_id"), scaled(vector).alias("vector")).distinct()
    asked = materialize(wanted.join(points.select("vector", "length", "node"), "vector"))
    starts = asked.select(F.col("node").alias("query"), "vector", "length", "node").dropDuplicates(["query"])
    _, grown, most = sizes(points.count())
    found = greedy_search(graph, points, starts, beam or grown, max(most, 64))
    members = found.join(points.select("node", F.explode("ids").alias("id")), "node")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = (asked.select("query_id", F.col("node").alias("query")).join(members, "query").where("id <> query_id")
            .groupBy("query_id", "id").agg(F.max("near").alias("score")).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k))
    return best.select("query_id", "rank", F.col("id").alias(key), "score")
