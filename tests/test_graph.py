import math
from itertools import combinations

import numpy as np
import pytest

from tablecraft.operators import graph

EVENTS = [[3, 0], [8, 3, 6], [1, 9, 4], [2, 9], [6, 5, 7]]


def members(spark, events):
    return spark.createDataFrame([(p, e) for e, people in enumerate(events) for p in people], "person int, event int")


def floyd(events, nodes):
    far = np.full((nodes, nodes), np.inf)
    np.fill_diagonal(far, 0)
    for people in events:
        for a, b in combinations(people, 2):
            if a != b:
                far[a, b] = far[b, a] = 1
    for k in range(nodes):
        far = np.minimum(far, far[:, [k]] + far[[k], :])
    return far


def test_hops_of_the_toy_lists(spark):
    lists = graph.comembership(members(spark, EVENTS), "person", "event")
    got = {(r.src, r.dst): (r.hops, r.previous) for r in graph.hops(lists).collect()}
    assert got[0, 5] == (3, 6) and got[0, 0] == (0, None) and got[1, 9] == (1, 1)
    assert (0, 4) not in got
    far = floyd(EVENTS, 10)
    assert {p: h for p, (h, _) in got.items()} == {
        (a, b): far[a, b] for a in range(10) for b in range(10) if math.isfinite(far[a, b])}


def test_hops_on_random_lists_from_some_sources(spark):
    draw = np.random.default_rng(4)
    events = [sorted(set(draw.integers(0, 40, draw.integers(2, 4)).tolist())) for _ in range(30)] + [list(range(10))]
    far = floyd(events, 40)
    lists = graph.comembership(members(spark, events), "person", "event")
    got = {(r.src, r.dst): r for r in graph.hops(lists, spark.createDataFrame([(3,), (30,)], "n int")).collect()}
    known = {p for e in events if len(e) > 1 for p in e}
    want = {(s, d): far[s, d] for s in (3, 30) for d in known if math.isfinite(far[s, d])}
    assert {k: v.hops for k, v in got.items() if k[1] in known} == want
    for (s, d), r in got.items():
        if r.hops:
            near = [p for p in known if far[s, p] == r.hops - 1 and far[p, d] == 1]
            assert r.previous == min(near)


def test_edges_become_lists_of_two(spark, rows):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 3)], "src int, dst int")
    assert rows(graph.edges_as_lists(edges), "node") == [(1,), (2,)]


@pytest.mark.parametrize("people", [[1], [1, 1]])
def test_lists_of_one_connect_nobody(spark, people):
    assert graph.comembership(members(spark, [people]), "person", "event").count() == 0


def test_more_sources_than_a_word_and_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK", 3)
    draw = np.random.default_rng(7)
    events = [sorted(set(draw.integers(0, 150, draw.integers(2, 4)).tolist())) for _ in range(90)] + [list(range(0, 40, 2))]
    far = floyd(events, 150)
    got = {(r.src, r.dst): r for r in graph.hops(graph.comembership(members(spark, events), "person", "event")).collect()}
    known = sorted({p for e in events if len(e) > 1 for p in e})
    assert len(known) > 64
    assert {k: r.hops for k, r in got.items()} == {(a, b): far[a, b] for a in known for b in known if math.isfinite(far[a, b])}
    for (s, d), r in got.items():
        near = [p for p in known if far[s, p] == r.hops - 1 and far[p, d] == 1]
        assert r.previous == (min(near) if r.hops else None)
