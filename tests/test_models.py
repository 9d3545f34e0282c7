"""Models against closed forms, hand computations and quality floors."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tablecraft.ml import folds, linear, metrics, net, trees, tune


@pytest.fixture(scope="module")
def line(spark):
    """y = 4 + 3 a - 2 b + noise, 600 rows."""
    draw = np.random.default_rng(0)
    a, b = draw.uniform(0, 2, 600), draw.normal(size=600)
    y = 4 + 3 * a - 2 * b + draw.normal(0, 0.3, 600)
    df = spark.createDataFrame([(i, float(p), float(q), float(r), i % 4) for i, (p, q, r) in enumerate(zip(a, b, y))],
                               "id long, a double, b double, label double, fold int")
    return linear.with_features(df, ["a", "b"]).cache(), np.column_stack([a, b]), y


@pytest.fixture(scope="module")
def moons(spark):
    """Three classes around three centres, 450 rows."""
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.normal(c, 0.6, (150, 2)) for c in ([0, 0], [3, 0], [0, 3])])
    y = np.repeat([0.0, 1.0, 2.0], 150)
    df = spark.createDataFrame([(i, float(p), float(q), float(k), i % 4) for i, ((p, q), k) in enumerate(zip(x, y))],
                               "id long, a double, b double, label double, fold int")
    return linear.with_features(df, ["a", "b"]).cache(), x, y


def hit_rate(df):
    return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def solve(x, y, alpha=0.0):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return np.r_[y.mean() - w @ x.mean(0), w]


def test_normal_equation_and_descent_agree(line):
    df, x, y = line
    want = solve(x, y)
    assert np.allclose(linear.normal_equation(df, ["a", "b"], "label"), want)
    sums = linear.products(df, ["a", "b"], "label")
    assert np.allclose(linear.gradient_descent(sums, 0.1, 5000), want, atol=1e-6)
    assert sums.mse(want) == pytest.approx(np.mean((y - want[0] - x @ want[1:]) ** 2))
    near = linear.minibatch_descent(df, ["a", "b"], "label", "id", batches=10, epochs=15)
    assert np.allclose(near, want, atol=0.15)


def test_descent_stops_when_validation_gets_worse(line):
    df, _, _ = line
    train = linear.products(df.filter("fold > 0"), ["a"], "label")
    wrong = linear.products(df.filter("fold = 0").withColumn("label", -F.col("label")), ["a"], "label")
    one_step = -0.1 * train.gradient(np.zeros(2))
    assert np.allclose(linear.gradient_descent(train, 0.1, 100, validation=wrong), one_step)


@pytest.mark.parametrize("alpha", [1.0, 200.0])
def test_ridge_matches_the_closed_form(line, alpha):
    df, x, y = line
    model = linear.ridge(df, alpha).fit(df)
    assert np.allclose(np.r_[model.intercept, model.coefficients.toArray()], solve(x, y, alpha), rtol=1e-6)


def test_elastic_net_satisfies_its_optimality_conditions(line):
    df, x, y = line
    alpha, share = 0.5, 0.35
    model = linear.elastic_net(df, alpha, share).fit(df)
    w = model.coefficients.toArray()
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / len(y) - alpha * (1 - share) * w
    assert np.allclose(slope, alpha * share * np.sign(w), atol=1e-4)


def test_lasso_drops_weak_columns(line):
    df, _, _ = line
    assert np.allclose(linear.lasso(df, 50.0).fit(df).coefficients.toArray(), 0)


def test_class_weights_balance(spark, rows):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert rows(linear.class_weights(df, "y")) == [(0, pytest.approx(2 / 3)), (1, 2.0)]
    assert linear.with_class_weights(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(4.0)


def test_one_vs_one_beats_the_floor(moons):
    df, _, _ = moons
    model = linear.OneVsOne(LogisticRegression(maxIter=20)).fit(df)
    assert len(model.models) == 3 and hit_rate(model.transform(df)) > 0.95


def test_majority_takes_the_smaller_on_ties(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 1.0, 2.0), (None, None, 5.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(trees.majority([F.col(x) for x in "abc"])).collect()] == [2.0, 1.0, 5.0]


def test_poisson_weights_have_mean_one(spark):
    df = spark.range(20000).select(trees.poisson_weight(trees.hash_uniform("id", 3)).alias("w"))
    mean, var, zero = df.agg(F.avg("w"), F.variance("w"), F.avg((F.col("w") == 0).cast("double"))).first()
    assert mean == pytest.approx(1, abs=0.03) and var == pytest.approx(1, abs=0.05) and zero == pytest.approx(np.exp(-1), abs=0.02)


@pytest.mark.parametrize("replace", [True, False])
def test_bagging_and_oob(moons, replace):
    df, _, _ = moons
    model = trees.BaggedTrees("id", 6, replace=replace, depth=3).fit(df)
    assert hit_rate(model.transform(df)) > 0.95
    score, rows = model.oob_score(df).first()
    assert 0.9 < score <= 1 and 300 < rows <= 450


def test_adaboost_beats_a_single_stump(moons):
    df, _, _ = moons
    stump = DecisionTreeClassifier(maxDepth=1).fit(df).transform(df)
    assert hit_rate(trees.BoostedTrees(rounds=6).fit(df).transform(df)) > hit_rate(stump) + 0.2


def test_residual_trees_reduce_the_error_step_by_step(line):
    df, _, y = line
    errors = []
    for n in (1, 2, 3):
        _, out = trees.residual_trees(df, "label", n, 2)
        errors.append(out.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), F.lit(2)))).first()[0])
    assert y.var() > errors[0] > errors[1] > errors[2]


def test_best_iteration_picks_the_lowest_validation_error(line):
    df, _, _ = line
    errors, best, model = trees.best_iteration(df.filter("fold > 0"), df.filter("fold = 0"), "label", 8)
    assert best == int(np.argmin(errors)) + 1 and model.getNumTrees == best


def test_bootstrap_error_is_near_theory(line):
    df, _, y = line
    got = trees.bootstrap_statistics(df, "label", trees.poisson_weights("id", 80)).first()
    assert got.standard_error == pytest.approx(y.std() / np.sqrt(len(y)), rel=0.3)


def test_impurity_by_hand(spark):
    df = spark.createDataFrame([("g", x) for x in "aabb"] + [("p", "a")], "k string, y string")
    got = {r.k: r[1:] for r in trees.impurity(df, ["k"], "y").collect()}
    assert got["g"] == pytest.approx((0.5, 1.0, 0.5)) and got["p"] == pytest.approx((0.0, 0.0, 0.0))


def test_network_gradient_and_training(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 2))
    y = ((x[:, 0] * x[:, 1]) > 0).astype(int)  # not separable by a line
    df = spark.createDataFrame([([float(a), float(b)], int(k)) for (a, b), k in zip(x, y)], "x array<double>, y int")
    start = net.Weights.random(2, 4, 2, 0.5)
    flat = start.gradient(x, y)
    for name, at in (("w1", 0), ("w2", start.w1.size + 4)):
        bumped = net.Weights(start.w1.copy(), start.b1, start.w2.copy(), start.b2)
        getattr(bumped, name).ravel()[0] += 1e-6
        assert (bumped.gradient(x, y)[-1] - flat[-1]) / 1e-6 == pytest.approx(flat[at], rel=1e-3)
    assert net.Weights.random(2, 4, 2).gradient(x, y)[-1] / 300 == pytest.approx(np.log(2), abs=1e-3)
    nets, costs = net.train_networks(df, "x", "y", [1, 6], steps=3)
    serial = net.Weights.random(2, 6, 2)
    for _ in range(3):
        serial = serial.moved(serial.gradient(x, y)[:-1] / 300, 1.2)
    assert np.allclose(nets[1].w1, serial.w1) and nets[1].b2 == pytest.approx(serial.b2)
    assert len(costs[0]) == 3
    p = [r[0] for r in df.select(net.probability(serial, "x")).collect()]
    assert np.allclose(p, serial.forward(x)[1])


def test_network_learns_and_weights_apply_to_plain_inputs(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(400, 2)) * [3.0, 0.1] + [5.0, -1.0]
    y = ((x[:, 0] - 5) * (x[:, 1] + 1) > 0).astype(int)
    df = spark.createDataFrame([([float(a), float(b)], int(k)) for (a, b), k in zip(x, y)], "x array<double>, y int")
    nets, costs = net.train_networks(df, "x", "y", [1, 8], steps=80, rate=0.8, momentum=0.9, scale=0.5, standardise=True)
    hits = [((n.forward(x)[1] > 0.5) == y).mean() for n in nets]
    assert hits[1] > 0.9 > hits[0] and costs[1][-1] < 0.3 * costs[1][0]


def test_second_order_steps_reach_the_cost_of_ten_thousand_plain_ones(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(400, 3))
    y = ((x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + draw.normal(0, 0.7, 400)) > 0).astype(int)
    df = spark.createDataFrame([([float(v) for v in a], int(k)) for a, k in zip(x, y)], "x array<double>, y int")
    nets, costs = net.train_networks(df, "x", "y", [2, 4], steps=400, scale=0.5, solver="lbfgs")
    for found, cost, hidden in zip(nets, costs, (2, 4)):
        plain = net.Weights.random(3, hidden, 2, 0.5)
        for _ in range(10_000):
            plain = plain.moved(plain.gradient(x, y)[:-1] / 400, 1.2)
        assert found.gradient(x, y)[-1] <= 1.01 * plain.gradient(x, y)[-1]
        assert len(cost) < 1500 and found.gradient(x, y)[-1] / 400 == pytest.approx(min(cost))


def test_second_order_steps_solve_a_quadratic_exactly():
    draw = np.random.default_rng(1)
    matrix = draw.normal(size=(30, 12))
    matrix, goal = matrix.T @ matrix + np.eye(12), draw.normal(size=12)
    run = net.lbfgs(np.zeros(12), 200, tolerance=1e-14)
    point = next(run)
    try:
        while True:
            gap = point - goal
            point = run.send((0.5 * gap @ matrix @ gap, matrix @ gap))
    except StopIteration as done:
        assert np.allclose(done.value, goal, atol=1e-5)


def test_folds_and_splits(moons):
    df, _, _ = moons
    dealt = folds.kfold_stratified(df.select("id", "label"), 4, "label", ["id"], "f").groupBy("label", "f").count().collect()
    assert {r["count"] for r in dealt} <= {37, 38}
    train, test = folds.split_holdout(df, 0.25, "id", seed=3)
    assert train.count() + test.count() == 450 and 70 < test.count() < 160
    assert [r.id for r in folds.shuffle_rows(df, "id", 1).collect()] == [r.id for r in folds.shuffle_rows(df, "id", 1).collect()]


def test_cross_predict_covers_every_row_once(line):
    df, x, y = line
    out = tune.cross_predict(df.drop("prediction"), linear.linear(), "fold").collect()
    assert sorted(r.id for r in out) == list(range(600))
    keep = np.arange(600) % 4 != 2
    w = solve(x[keep], y[keep])
    row = next(r for r in out if r.id == 2)
    assert row.prediction == pytest.approx(w[0] + x[2] @ w[1:])


def test_grid_prefers_the_smaller_error(line):
    df, _, _ = line
    model, spread = linear.elastic_net(df, 1.0, 0.5), linear.label_stats(df)[1]
    grid = [dict(zip((model.regParam, model.elasticNetParam), linear.penalty(a, 0.5, spread))) for a in (0.001, 1.0, 10.0)]
    table, best = tune.grid_search(df, model, grid, metrics.RmsleEvaluator(), "fold")
    rows = sorted(table.collect(), key=lambda r: r.place)
    assert rows[0].mean < rows[1].mean < rows[2].mean
    assert best.getOrDefault("regParam") == pytest.approx(linear.penalty(0.001, 0.5, spread)[0])
    tried, _ = tune.random_search(df, model, grid, metrics.RmsleEvaluator(), "fold", tries=2)
    assert tried.count() == 2


def test_stacking_is_no_worse_than_its_parts(line):
    df, _, _ = line
    rmse = RegressionEvaluator(metricName="rmse")
    _, out = tune.stack_models(df, {"weak": linear.lasso(df, 50.0), "good": linear.linear()}, "label", "fold")
    assert rmse.evaluate(out) <= rmse.evaluate(out.drop("prediction").withColumnRenamed("oof_good", "prediction")) + 1e-9


def test_curves_and_selection(line):
    df, x, y = line
    curve = tune.learning_curve(df, linear.linear(), RegressionEvaluator(metricName="rmse"), "id", 4).collect()
    assert [r.rows for r in curve] == sorted(r.rows for r in curve) and curve[-1].validation < 0.5
    sweep = {r.degree: r.test for r in tune.complexity_curve(
        df.withColumn("label", F.col("a") * F.col("a") + 0.0 * F.col("label")), "a", "label", "fold", [1, 2, 3]).collect()}
    assert sweep[1] > 0.1 and sweep[2] < 1e-6
    chosen = tune.greedy_select(df, ["a", "b"], "label", 2).orderBy("step").collect()
    assert [r.column for r in chosen] == ["b", "a"]
    assert chosen[1].mse == pytest.approx(np.mean((y - solve(x, y)[0] - x @ solve(x, y)[1:]) ** 2))
    table = tune.importance_table(df, ["a", "b"], [0.25, 0.75]).collect()
    assert [tuple(r) for r in table] == [("b", 0.75, 0.75), ("a", 0.25, 1.0)]


def test_metrics_on_perfect_and_constant_predictors(spark):
    df = spark.createDataFrame([(i % 10 == 0, i) for i in range(100)], "t boolean, i int").select(
        F.col("t").cast("int").alias("y"), F.col("t").cast("int").alias("same"), F.lit(0).alias("none"),
        F.col("t").cast("double").alias("p"), F.lit(0.5).alias("flat"), "i")
    assert metrics.binary_scores(df, "y", "same").first().f1 == 1.0
    never = metrics.binary_scores(df, "y", "none").first()
    assert never.precision is None and never.recall == 0.0 and never.prevalence == 0.1
    assert metrics.accuracy(df, "y", "none").first()[0] == 0.9
    assert metrics.roc_auc(df, "y", "p").first()[0] == 1.0
    assert metrics.roc_auc(df, "y", "flat").first()[0] == 0.5
    assert metrics.log_loss(df, "y", "flat").first()[0] == pytest.approx(np.log(2))
    assert metrics.precision_at_k(df, "y", "p", "i", 10).first()[0] == 1.0
