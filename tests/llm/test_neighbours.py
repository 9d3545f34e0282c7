"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm.neighbours import _meetings, distinct_vectors, nearest, neighbour_graph, sizes

SCHEMA = "vec_id long, embedding array<float>, node string, score double"


def brute(rows, k=5, every=50):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and len(v) == len(rows[0][1]) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=np.float32).astype(float)
    ids = np.array(sorted(good))
    u = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids]) if len(ids) else np.empty((0, 1))
    out = {}
    for a, q in enumerate(ids):
        if q % every == 0:
            near = u @ u[a]
            others = [j for j in np.lexsort((ids, -np.round(near, 9))) if j != a][:k]
            out[int(q)] = [(int(ids[j]), float(near[j])) for j in others]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def recall(got, want):
    hits = total = 0
    for q, pairs in want.items():
        assert [r for r, *_ in got[q]] == list(range(1, len(pairs) + 1))
        hits += len({i for _, i, _ in got[q]} & {i for i, _ in pairs})
        total += len(pairs)
    return hits / total


def test_recall_and_scores_over_many_vectors(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(10, 24))
    v = (centres[draw.integers(0, 10, 3000)] + draw.normal(size=(3000, 24))).astype(np.float32)
    rows = [(i, x.tolist(), "x", 0.0) for i, x in enumerate(v)]
    got = found(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    want = brute(rows)
    assert recall(got, want) >= 0.95
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    assert all(s == pytest.approx(u[q] @ u[i], abs=1e-12) for q, hits in got.items() for _, i, s in hits)


def test_copies_odd_vectors_and_ties(spark):
    draw = np.random.default_rng(2)
    same = draw.normal(size=8).astype(np.float32).tolist()
    rows = [(i, draw.normal(size=8).astype(np.float32).tolist(), "x", 0.0) for i in range(120)]
    rows += [(1000 + i, same, None, None) for i in range(200)]
    rows += [(2000, None, "x", 0.0), (2050, [0.0] * 8, "x", 0.0), (2100, [float("nan")] * 8, "x", 0.0), (2150, [None] * 8, "x", 0.0),
             (2200, [1.0] * 5, "x", 0.0), (2250, [float("inf")] + [1.0] * 7, "x", 0.0), (None, same, "x", 0.0), rows[3], rows[50]]
    got = found(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    want = brute(rows)
    assert got.keys() == want.keys() and {q: [i for _, i, _ in h] for q, h in got.items()} == {q: [i for i, _ in h] for q, h in want.items()}
    assert [i for _, i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]


@pytest.mark.parametrize("size", [1e-200, 5e-320, 1.7e308])
def test_scores_do_not_depend_on_the_length_of_vectors(spark, size):
    draw = np.random.default_rng(4)
    v = draw.integers(-8, 9, (90, 6)).astype(float) * 2.0 ** draw.integers(-3, 4, (90, 1))
    v[0] = v[50] = [1, 2, 3, 4, 5, 6]
    schema = "vec_id long, embedding array<double>"
    plain = found(nearest(spark.createDataFrame([(i, (x / 128).tolist()) for i, x in enumerate(v)], schema), F.col("vec_id") % 50 == 0))
    power = 2.0 ** np.floor(np.log2(size))
    wide = [(i, (x / 128 * power if size > 1e-300 else x * (5e-324 * 4096)).tolist()) for i, x in enumerate(v)]
    got = found(nearest(spark.createDataFrame(wide, schema), F.col("vec_id") % 50 == 0))
    assert got.keys() == plain.keys() == {0, 50}
    for q, hits in got.items():
        assert [s for *_, s in hits] == [s for *_, s in plain[q]]


def test_few_or_no_rows(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    few = [(0, [1.0, 0.0], "x", 0.0), (1, [0.0, 1.0], "x", 0.0), (50, [1.0, 1.0], "x", 0.0)]
    got = found(nearest(spark.createDataFrame(few, SCHEMA), F.col("vec_id") % 50 == 0))
    assert {q: [i for _, i, _ in h] for q, h in got.items()} == {0: [50, 1], 50: [0, 1]}
    alone = spark.createDataFrame(few[:1], SCHEMA)
    assert nearest(alone, F.col("vec_id") % 50 == 0).count() == 0


def points_of(spark, count, size):
    v = np.random.default_rng(6).normal(size=(count, size)).astype(np.float32)
    return distinct_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"), "vec_id", "embedding", 1)


def test_guests_of_a_crowded_node_meet_others_in_later_rounds(spark):
    points = points_of(spark, 400, 4)
    nodes = [r.node for r in points.select("node").collect()]
    star = spark.createDataFrame([(n, nodes[0], -1.0) for n in nodes[1:]] + [(nodes[0], nodes[1], -1.0)], "node long, other long, near float")
    first, second = ({(r.node, r.other) for r in _meetings(star, points, turn).collect()} for turn in (0, 1))
    assert len(second - first) > len(first) / 2


def test_descent_ends_settled_or_not_at_all(spark):
    points = points_of(spark, 1500, 24)
    with pytest.raises(RuntimeError, match="settled"):
        neighbour_graph(points, most=1)
    assert neighbour_graph(points).groupBy("node").count().where("count < 48").isEmpty()


def test_sizes_grow_with_the_vectors():
    assert sizes(2_000)[:2] == (4, 66)
    small, large = sizes(50_000), sizes(3_000_000)
    assert all(a < b for a, b in zip(small, large))
