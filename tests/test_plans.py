"""Plans that split huge groups must agree with the plain ones."""

from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablecraft.plans import groups, ordering, quantiles
from tablecraft.plans.lineage import checkpoint_home


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows, a third of them in one group, keys partly missing, values with gaps and ties."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 31 == 1, F.lit(None).cast("int")).otherwise(F.col("id") % 97 + 1)
    value = F.when(F.col("id") % 5 != 0, (F.col("id") * 7919 % 101).cast("double"))
    return spark.range(3000).select("id", key.cast("int").alias("k"), value.alias("v")).checkpoint() if (
        checkpoint_home(spark)) else None


def test_row_index_counts_from_zero_without_gaps(hot):
    got = ordering.row_index(hot, [F.desc("v"), "id"]).orderBy("row_index").select("id", "v", "row_index").collect()
    assert [r.row_index for r in got] == list(range(3000))
    want = sorted(hot.collect(), key=lambda r: (-(r.v if r.v is not None else -1e9), r.id))
    assert [r.id for r in got] == [r.id for r in want]


OUT = {"total": ("sum", "v"), "nth": ("count", None), "seen": ("last", "v"), "times": ("product", "f")}


def test_running_values_do_not_depend_on_the_split(hot):
    rows = hot.withColumn("f", 1 + F.col("v") / 1e6)
    got = {r.id: r for r in ordering.running(rows, ["k"], ["id"], OUT).collect()}
    state = {}
    for r in sorted(rows.collect(), key=lambda r: r.id):
        total, nth, seen, times = state.get(r.k, (None, 0, None, None))
        if r.v is not None:
            total, seen = (total or 0.0) + r.v, r.v
            times = (1.0 if times is None else times) * r.f
        state[r.k] = (total, nth + 1, seen, times)
        g = got[r.id]
        assert (g.nth, g.seen) == (nth + 1, seen)
        assert g.total == (None if r.v is None else pytest.approx(total))
        assert g.times == (None if r.v is None else pytest.approx(times))
    assert len(got) == 3000


def test_running_without_key_covers_the_whole_table(hot):
    got = ordering.running(hot, [], ["id"], {"total": ("sum", "v"), "nth": ("count", None)}).orderBy("id").collect()
    assert [r.nth for r in got] == list(range(1, 3001))
    want = np.cumsum([r.v or 0.0 for r in got])
    assert all((r.total is None) == (r.v is None) for r in got)
    assert np.allclose([r.total for r in got if r.v is not None], [w for r, w in zip(got, want) if r.v is not None])


@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles_match_numpy(hot, keys):
    got = quantiles.percentiles(hot, keys, "v", {"a": 0.25, "b": 0.5, "c": 0.99}).collect()
    data = {}
    for r in hot.collect():
        if r.v is not None:
            data.setdefault(r.k if keys else "all", []).append(r.v)
    assert len(got) == len(data)
    for r in got:
        assert np.allclose([r.a, r.b, r.c], np.quantile(data[r.k if keys else "all"], [0.25, 0.5, 0.99]))


@pytest.mark.parametrize("keys", [["k"], []])
def test_percentiles_of_groups_that_are_narrowed_down(spark, monkeypatch, keys):
    """Groups of all sizes around the limit, with ties at the wanted positions; the sketch is made rough."""
    monkeypatch.setattr(quantiles, "LARGE", 50)
    monkeypatch.setattr(quantiles, "ACCURACY", 40)
    draw = np.random.default_rng(3)
    data = {"ties": [1.0] * 900 + [2.0] * 100, "same": [7.0] * 300, "few": list(range(50)), "two": [1.0, 5.0], None: draw.normal(size=2000).tolist(),
            "skewed": np.exp(draw.normal(size=3000) * 3).tolist(), "steps": [float(i // 60) for i in range(1200)]}
    rows = [(k, float(v)) for k, values in data.items() for v in values] + [("two", None), ("lost", None)]
    shares = {"z": 0.0, "a": 0.25, "b": 0.5, "c": 0.9, "d": 0.99, "e": 1.0}
    got = quantiles.percentiles(spark.createDataFrame(rows, "k string, v double").repartition(5), keys, "v", shares).collect()
    want = data if keys else {"all": [v for values in data.values() for v in values]}
    assert len(got) == len(want)
    for r in got:
        assert np.allclose(list(r)[len(keys):], np.quantile(want[r.k if keys else "all"], list(shares.values())))


def test_rows_of_large_groups_are_counted_where_they_are(spark, monkeypatch, hot):
    """What is known of a large group comes to its rows by broadcast: no join sorts a whole group in one task."""
    monkeypatch.setattr(quantiles, "LARGE", 50)
    plans, written = [], quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(quantiles.percentiles(hot, ["k"], "v", {"a": 0.5}).collect()) == len({r.k for r in hot.collect()})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert any("BroadcastHashJoin" in p for p in plans) and not any("SortMergeJoin" in p for p in plans)


def test_group_stats_stay_whole(hot):
    got = groups.with_group_stats(hot, ["k"], [F.avg("v").alias("m")]).collect()
    data = {}
    for r in hot.collect():
        data.setdefault(r.k, []).append(r.v)
    assert len(got) == 3000
    for r in got:
        known = [v for v in data[r.k] if v is not None]
        assert r.m == (pytest.approx(np.mean(known)) if known else None)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40))
def test_forward_fill_property(spark, pairs):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(pairs)], "id int, k int, v int")
    got = {r.id: r.f for r in ordering.running(df, ["k"], ["id"], {"f": ("last", "v")}).collect()}
    last = {}
    for i, (k, v) in enumerate(pairs):
        last[k] = v if v is not None else last.get(k)
        assert got[i] == last[k]


def test_top_k_per_group_large_k_numbers_in_pieces(hot):
    from tablecraft.operators.ordered import top_k_per_group
    got = top_k_per_group(hot, ["k"], ["id"], 1001, "place")
    want = hot.groupBy("k").count().agg(F.sum(F.least("count", F.lit(1001)))).first()[0]
    assert got.count() == want


def fake_session(master, current=None, named=None):
    chosen = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: chosen[-1] if chosen else current,
                              setCheckpointDir=chosen.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named or default)), chosen


def test_checkpoint_folder_comes_from_the_cluster():
    session, chosen = fake_session("spark://host:7077", named="hdfs://shared/checkpoints")
    assert checkpoint_home(session) == "hdfs://shared/checkpoints" and chosen == ["hdfs://shared/checkpoints"]
    session, chosen = fake_session("yarn", current="hdfs://already")
    assert checkpoint_home(session) == "hdfs://already" and not chosen


def test_no_machine_local_folder_on_a_cluster():
    session, _ = fake_session("yarn")
    with pytest.raises(RuntimeError):
        checkpoint_home(session)
