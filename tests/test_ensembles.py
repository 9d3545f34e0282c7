"""Ensembles grown together against single trees grown alone."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tablecraft.ml import ensembles
from tablecraft.ml.ensembles import Forest, drawn


def grow(x, y, w, columns, depth, classes, least=1.0):
    """A plain tree by trying every cut: (prediction of each row)."""
    def value(at):
        if not classes:
            return (w[at] * y[at]).sum() / w[at].sum()
        return np.argmax([w[at][y[at] == k].sum() for k in range(int(y.max()) + 1)])

    def score(at):
        weight = w[at].sum()
        sums = [w[at][y[at] == k].sum() for k in range(int(y.max()) + 1)] if classes else [(w[at] * y[at]).sum()]
        return sum(s * s for s in sums) / weight if weight else 0.0

    def split(at, left):
        if not left or w[at].sum() == 0:
            return {tuple(at): value(at)}
        best, found = score(at) + 1e-9 * max(abs(score(at)), 1e-12), None
        for f in columns:
            for v in np.unique(x[at, f])[:-1]:
                low, high = at[x[at, f] <= v], at[x[at, f] > v]
                if min(w[low].sum(), w[high].sum()) >= least and score(low) + score(high) > best * (1 + 1e-12):
                    best, found = score(low) + score(high), (low, high)
        if found is None:
            return {tuple(at): value(at)}
        return split(found[0], left - 1) | split(found[1], left - 1)

    out = np.zeros(len(x))
    for at, v in split(np.arange(len(x)), depth).items():
        out[list(at)] = v
    return out


@pytest.fixture(scope="module")
def grid(spark):
    """Few values a column, so that bins are values; three classes and a number."""
    draw = np.random.default_rng(3)
    x = draw.integers(0, 9, (240, 3)).astype(float)
    k = ((x[:, 0] > 4).astype(int) + (x[:, 1] * x[:, 2] > 20)).astype(float)
    k[::11] = draw.integers(0, 3, len(k[::11]))
    v = x[:, 0] * 2 - x[:, 2] + draw.normal(0, 0.5, 240)
    df = spark.createDataFrame([(i, a.tolist(), float(p), float(q)) for i, (a, p, q) in enumerate(zip(x, k, v))],
                               "id long, features array<double>, label double, value double").repartition(3).cache()
    return df, x, k, v


def predictions(model, df, **more):
    return np.array([r.prediction for r in model.transform(df, **more).orderBy("id").collect()], dtype=float)


def hashes(df, seed=0):
    return np.array([r.h for r in df.orderBy("id").select(F.xxhash64("id", F.lit(seed)).alias("h")).collect()])


@pytest.mark.parametrize("classes, replace, columns", [(True, True, None), (True, False, 2), (False, True, None), (False, False, 2)])
def test_equal_to_trees_grown_alone(grid, classes, replace, columns):
    df, x, k, v = grid
    model = Forest("id", 7, depth=3, classes=classes, replace=replace, columns=columns, seed=4).fit(df, label="label" if classes else "value")
    w = drawn(hashes(df, 4), np.arange(7), replace, 0.5)
    y = k if classes else v
    alone = np.stack([grow(x, y, w[:, t], model.of[t], 3, classes) for t in range(7)])
    want = np.array([np.bincount(a.astype(int), minlength=3).argmax() for a in alone.T]) if classes else alone.mean(0)
    assert np.allclose(predictions(model, df), want)
    unseen = predictions(model, df, unseen_only=True)
    for i in range(len(x)):
        votes = alone[w[i] == 0, i] if (w[i] == 0).any() else None
        assert np.isnan(unseen[i]) if votes is None else np.isclose(unseen[i], np.bincount(votes.astype(int), minlength=3).argmax() if classes else votes.mean())


def test_one_tree_on_all_rows_equals_the_library_tree(grid):
    df, _, _, _ = grid
    rows = df.withColumn("features", array_to_vector("features"))
    ours = Forest("id", 1, depth=4, replace=False, share=1.0).fit(rows).transform(rows, prediction="ours")
    theirs = DecisionTreeClassifier(maxDepth=4, maxBins=32, minInfoGain=1e-9).fit(rows).transform(ours)
    assert theirs.agg(F.avg((F.col("ours") == F.col("prediction")).cast("double"))).first()[0] > 0.98


def test_blocks_and_small_steps_change_nothing(grid, monkeypatch):
    df, _, _, _ = grid
    whole = predictions(Forest("id", 9, depth=3).fit(df), df)
    monkeypatch.setattr(ensembles, "WALKED", 50)
    assert (predictions(Forest("id", 9, depth=3).fit(df.repartition(7)), df) == whole).all()


def test_many_trees_beat_few_out_of_bag(grid):
    df, _, _, _ = grid
    few, many = (Forest("id", n, depth=4).fit(df).oob_score(df).first() for n in (5, 200))
    assert many.oob_accuracy > few.oob_accuracy and many.rows == 240 > few.rows


def test_drawing(spark):
    keys = hashes(spark.range(20_000))
    times = drawn(keys, np.arange(4), True, 0.5)
    assert abs(times.mean() - 1) < 0.02 and abs(times.var() - 1) < 0.04 and abs((times == 0).mean() - np.exp(-1)) < 0.01
    assert abs(np.corrcoef(times.T)[0, 1]) < 0.03
    assert abs(drawn(keys, np.arange(3), False, 0.3).mean() - 0.3) < 0.01


def test_missing_values_labels_and_tables(spark):
    schema = "id long, features array<double>, label double"
    given = [(i, [None if i % 5 == 0 else float(i % 4), 1.0], float(i % 5 == 0)) for i in range(100)] + [(100, [0.0, 1.0], None), (101, None, None)]
    model = Forest("id", 5, depth=1, replace=False, share=1.0).fit(spark.createDataFrame(given, schema))
    got = {r.id: r.prediction for r in model.transform(spark.createDataFrame(given, schema)).collect()}
    assert all(got[i] == float(i % 5 == 0) for i in range(100)) and got[100] == 0.0 and got[101] == 1.0
    none = spark.createDataFrame([], schema)
    assert Forest("id", 5).fit(none).transform(none).count() == 0
    assert Forest("id", 5).fit(none).transform(spark.createDataFrame(given[:1], schema)).first().prediction is None


@pytest.mark.parametrize("classes, weighted", [(False, False), (True, True), (False, True)])
def test_cells_of_equal_bins_grow_the_same_trees(spark, monkeypatch, classes, weighted):
    draw = np.random.default_rng(3)
    x = draw.integers(0, 5, size=(3000, 3)).astype(float)
    y = (x[:, 0] + x[:, 1] > 4).astype(float) if classes else x[:, 0] * x[:, 1] + draw.normal(size=3000)
    rows = [(i, [None if i % 50 == 0 else float(v[0]), float(v[1]), float(v[2])], float(l)) for i, (v, l) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double")
    given = F.array(*[F.col("id") % b % 3 for b in (5, 7, 11, 13)]) if weighted else None
    made, cells = [], ensembles.cells
    monkeypatch.setattr(ensembles, "cells", lambda *a: made.append(cells(*a)) or made[-1])

    def grown():
        model = ensembles.Forest("id", 4, depth=3, classes=classes, columns=2, replace=False, share=1.0, weights=given).fit(df)
        return model.nodes, [r.prediction for r in model.transform(df).orderBy("id").collect()]

    nodes, said = grown()
    assert len(made) == 1 and made[0].count() <= 6 * 5 * 5 * 2  # levels go over the cells, not over 3,000 rows
    monkeypatch.setattr(ensembles, "CELLS", 0)
    monkeypatch.setattr(ensembles, "ANSWERS", 0)
    plain, want = grown()
    assert len(made) == 1 and (nodes.feature == plain.feature).all() and (nodes.bin == plain.bin).all() and said == pytest.approx(want)


def test_drawn_rows_are_added_up_to_cells(spark, monkeypatch):
    """Trees that draw rows by hash go over cells too; a node may be split by one of its drawn columns only."""
    draw = np.random.default_rng(5)
    x = draw.integers(0, 5, size=(2000, 3)).astype(float)
    y = x[:, 0] * x[:, 1] + draw.normal(size=2000)
    df = spark.createDataFrame([(i, i % 7, v.tolist(), float(l)) for i, (v, l) in enumerate(zip(x, y))], "id long, part long, features array<double>, label double")
    made, cells = [], ensembles.cells
    monkeypatch.setattr(ensembles, "cells", lambda *a: made.append(cells(*a)) or made[-1])

    def grown():
        model = Forest(["id", "part"], 9, depth=3, classes=False, node_columns=1, seed=2).fit(df)
        return model, predictions(model, df)

    model, said = grown()
    assert len(made) == 1 and made[0].count() <= 5 * 5 * 5
    monkeypatch.setattr(ensembles, "CELLS", 0)
    plain, want = grown()
    assert len(made) == 1 and (model.nodes.feature == plain.nodes.feature).all() and said == pytest.approx(want)
    for tree in range(9):
        for node in np.flatnonzero(model.nodes.feature[tree] >= 0):
            assert model.nodes.feature[tree, node] == np.random.default_rng((2, tree, node)).permutation(3)[0]


def test_given_weights_are_short_code_and_keep_their_type(spark, monkeypatch):
    """Weights reach the trees in the type that they are given in; out-of-bag votes are looked up where bins have few combinations."""
    from tablecraft.catalog import models

    keys = spark.range(400).select(F.col("id").alias("l_orderkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"))
    given = models._drawn(models._TIMES)
    model = Forest("l_orderkey", len(models._MULTIPLIERS), depth=1, weights=given)
    for row in keys.select("*", model._given()[1]).collect():
        assert row.w == [(row.l_orderkey * b + row.l_linenumber) % 7 % 3 for b in models._MULTIPLIERS]
    assert dict(keys.select(model._given()[1]).dtypes)["w"] == "array<tinyint>"  # no cast, which took longer than all else
    for classes in (True, False):
        df = keys.withColumn("features", F.array((F.col("l_orderkey") % 6).cast("double"))).withColumn("label", (F.col("l_orderkey") % 6 > 3).cast("double"))
        model = Forest("l_orderkey", len(models._MULTIPLIERS), depth=1, classes=classes, weights=given).fit(df)
        found = []
        for most in (1 << 20, 0):
            monkeypatch.setattr(ensembles, "SAID", most)
            found.append(model.oob_score(df).first())
        assert found[0] == found[1] and found[0].rows > 0


def test_importances_equal_the_library_tree(grid):
    df = grid[0].select("id", array_to_vector("features").alias("features"), F.col("value").alias("label"))
    want = DecisionTreeRegressor(maxDepth=3).fit(df).featureImportances.toArray()
    assert Forest("id", 1, depth=3, classes=False, replace=False, share=1.0).fit(df).importances() == pytest.approx(want)
    given = Forest("id", 1, depth=3, classes=False, weights=F.array((F.col("id") % 2).cast("double"))).fit(df)
    assert given.importances() == pytest.approx(DecisionTreeRegressor(maxDepth=3).fit(df.where("id % 2 = 1")).featureImportances.toArray())
