"""Fitted models. Work grows with the tables: every row is trained on or scored."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import PolynomialExpansion, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.ml import boosting, ensembles, linear, metrics, net, trees, tune

c = F.col

X = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
FOREST = {"numTrees": 100, "maxDepth": 5, "seed": 18}
#: The same forest over rows of few different features, whose trees are grown together: every node may be split by two of the four columns.
LINE_FOREST = {"trees": 100, "depth": 5, "classes": False, "node_columns": 2, "seed": 18}
#: Columns that tell lines apart.
LINE = ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "label"]
#: Trees of the ensembles that are grown together.
TREES = 500


def lines(t):
    """Line price (in thousands) against quantity, discount, tax and line number."""
    rows = t.lineitem.select("l_orderkey", "l_suppkey", *[c(x).cast("double").alias(x) for x in X],
                             (c("l_extendedprice") / 1000).alias("label"), (c("l_orderkey") % 4).cast("int").alias("fold"))
    return linear.with_features(rows, X)


def vectors(t, label="label"):
    """Embeddings as feature vectors, with ten classes or the class pair 'first five'."""
    y = c("label") if label == "label" else (c("label") < 5).cast("int")
    return t.embeddings.select("vec_id", array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features"),
                               y.cast("double").alias("label"), (c("vec_id") % 4).cast("int").alias("fold"))


def predicted(model, rows, *keep):
    return model.transform(rows).select(*keep, "label", "prediction")


# least squares

@query("""SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem""")
def linear_normal_eq(t):
    a, b = linear.normal_equation(t.lineitem, ["l_quantity"], "l_extendedprice")
    return t.spark.createDataFrame([(float(a), float(b))], "intercept double, slope double").select(
        F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"))


def _unit(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", (c("l_quantity") / 50).alias("q"), (c("l_discount") * 10).alias("d"),
                             (c("l_extendedprice") / 100000).alias("y"))


@query("""WITH RECURSIVE u AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity / 50 AS q, l_extendedprice / 100000 AS y FROM lineitem),
s AS (SELECT count(*)::DOUBLE AS n, sum(q) AS q, sum(q * q) AS qq, sum(y) AS y, sum(q * y) AS qy FROM u),
g AS (SELECT 0 AS step, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b UNION ALL SELECT step + 1, a - 0.1::DOUBLE * 2 / n * (n * a + q * b - y), b - 0.1::DOUBLE * 2 / n * (q * a + qq * b - qy) FROM g, s WHERE step < 200)
SELECT l_orderkey, l_linenumber, l_suppkey, round(a + b * q, 6) AS prediction FROM u, (SELECT a, b FROM g WHERE step = 200)""")
def linear_gd(t):
    rows = _unit(t)
    theta = linear.gradient_descent(linear.products(rows, ["q"], "y"), rate=0.1, steps=200)
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", F.round(linear.predict_linear(["q"], theta), 6).alias("prediction"))


@query()
def linear_sgd_minibatch(t):
    rows = _unit(t)
    theta = linear.minibatch_descent(rows, ["q", "d"], "y", "l_orderkey")
    return rows.select("l_orderkey", "l_linenumber", "y", linear.predict_linear(["q", "d"], theta).alias("prediction"))


# one feature, so that SQL can state the solution; several features are tested against numpy

_ONE = """WITH d AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity AS x, l_extendedprice / 1000 AS y, (l_orderkey % 4)::INTEGER AS fold FROM lineitem),
s AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx, count(*)::DOUBLE AS n FROM d)"""


def one_feature(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", (c("l_extendedprice") / 1000).alias("label"),
                             (c("l_orderkey") % 4).cast("int").alias("fold"))
    return linear.with_features(rows, ["l_quantity"])


def _with_slope(slope):
    return f"{_ONE} SELECT l_orderkey, l_linenumber, l_suppkey, round(my + ({slope}) * (x - mx), 4) AS prediction FROM d, s"


def _fitted(estimator, rows):
    return estimator.fit(rows).transform(rows).select("l_orderkey", "l_linenumber", "l_suppkey",
                                                      F.round("prediction", 4).alias("prediction"))


@query(_with_slope("sxy / sxx"))
def fit_linear(t):
    return _fitted(linear.linear(), one_feature(t))


@query(_with_slope("sxy / (sxx + 1000000 / n)"))
def fit_ridge(t):
    rows = one_feature(t)
    return _fitted(linear.ridge(rows, 1000000.0), rows)


@query(_with_slope("sign(sxy) * greatest(abs(sxy) - 0.5, 0) / sxx"))
def fit_lasso(t):
    rows = one_feature(t)
    return _fitted(linear.lasso(rows, 0.5), rows)


@query(_with_slope("sign(sxy) * greatest(abs(sxy) - 2 * 0.35, 0) / (sxx + 2 * 0.65)"))
def fit_elastic_net(t):
    rows = one_feature(t)
    return _fitted(linear.elastic_net(rows, 2.0, 0.35), rows)


# classifiers

# With one indicator per group and no penalty, the fitted probability of a class is its
# share in the group, which SQL can state. Wider models are tested in tests/test_models.py.

def graded(t):
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", (c("lang") == "en").cast("double").alias("english"), c("quality").cast("double").alias("label"))
    return linear.with_features(rows, ["english"])


def probability_of(model, rows, classes, *keep):
    p = vector_to_array("probability")
    return model.transform(rows).select(*keep, *[F.round(F.get(p, F.lit(k)), 4).alias(f"p{k}") for k in classes])


@query("SELECT doc_id, round(avg(quality) OVER (PARTITION BY lang = 'en'), 4) AS p1 FROM documents JOIN labels USING (doc_id)")
def fit_logistic(t):
    rows = graded(t)
    model = LogisticRegression(maxIter=200, tol=1e-12).fit(rows)
    return probability_of(model, rows, [1], "doc_id")


@query()
def fit_logistic_penalty(t):
    rows = vectors(t, "half")
    model = linear.logistic(10.0, rows.count(), 30).fit(rows)
    return predicted(model, rows, "vec_id")


@query()
def fit_logistic_cv(t):
    rows = vectors(t, "half")
    table, _ = tune.logistic_cv(rows, "fold", [0.01, 1.0, 100.0], MulticlassClassificationEvaluator(metricName="accuracy"), 20)
    return table


def labelled(t):
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.log1p("n_chars").alias("size"), (c("lang") == "en").cast("double").alias("english"),
        F.size(F.split("text", r"\n")).cast("double").alias("lines"), c("quality").cast("double").alias("label"))
    return linear.with_features(rows, ["size", "english", "lines"])


@query("""WITH d AS (SELECT doc_id, lang = 'en' AS g, quality AS y FROM documents JOIN labels USING (doc_id)), w AS (SELECT y, (SELECT count(*) FROM d) / (2.0 * count(*)) AS w FROM d GROUP BY 1)
SELECT doc_id, round(sum(w * y) OVER (PARTITION BY g) / sum(w) OVER (PARTITION BY g), 4) AS p1, round(w, 6) AS weight FROM d JOIN w USING (y)""")
def fit_logistic_balanced(t):
    rows = linear.with_class_weights(graded(t), "label")
    model = LogisticRegression(maxIter=200, tol=1e-12, weightCol="weight").fit(rows)
    return probability_of(model, rows, [1], "doc_id", F.round("weight", 6).alias("weight"))


@query("SELECT quality, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight FROM labels GROUP BY 1")
def class_weights(t):
    return linear.class_weights(t.labels, "quality").withColumn("weight", F.round("weight", 6))


def ranked(t):
    """Order status (0, 1, 2) by indicators of the order priority."""
    levels = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    status = F.when(c("o_orderstatus") == "F", 0.0).when(c("o_orderstatus") == "O", 1.0).otherwise(2.0)
    rows = t.orders.select("o_orderkey", status.alias("label"),
                           *[(c("o_orderpriority") == v).cast("double").alias(f"x{i}") for i, v in enumerate(levels)])
    return linear.with_features(rows, ["x0", "x1", "x2", "x3"])


_SHARES = """SELECT o_orderkey, o_orderstatus, avg((o_orderstatus = 'F')::INTEGER) OVER w AS f, avg((o_orderstatus = 'O')::INTEGER) OVER w AS o,
avg((o_orderstatus = 'P')::INTEGER) OVER w AS p FROM orders WINDOW w AS (PARTITION BY o_orderpriority)"""
_WINNER = f"SELECT o_orderkey, CASE WHEN f > o AND f > p THEN 0.0 WHEN o > p THEN 1.0 ELSE 2.0 END::DOUBLE AS prediction FROM ({_SHARES})"


@query(f"SELECT o_orderkey, round(f, 4) AS p0, round(o, 4) AS p1, round(p, 4) AS p2 FROM ({_SHARES})")
def fit_softmax(t):
    rows = ranked(t)
    model = LogisticRegression(family="multinomial", maxIter=300, tol=1e-12).fit(rows)
    return probability_of(model, rows, [0, 1, 2], "o_orderkey")


@query(_WINNER)
def fit_one_vs_rest(t):
    rows = ranked(t)
    model = OneVsRest(classifier=LogisticRegression(maxIter=100, tol=1e-12), parallelism=3).fit(rows)
    return model.transform(rows).select("o_orderkey", "prediction")


@query(_WINNER)
def fit_one_vs_one(t):
    rows = ranked(t)
    model = linear.OneVsOne(LogisticRegression(maxIter=100, tol=1e-12)).fit(rows)
    return model.transform(rows).select("o_orderkey", "prediction")


@query()
def fit_linear_svm(t):
    rows = vectors(t, "half")
    return predicted(linear.linear_svm(1.0, rows.count(), 10_000).fit(rows), rows, "vec_id")


@query()
def fit_poly_classifier(t):
    rows = labelled(t)
    steps = Pipeline(stages=[PolynomialExpansion(degree=3, inputCol="features", outputCol="poly"),
                             StandardScaler(withMean=True, inputCol="poly", outputCol="scaled"),
                             LogisticRegression(featuresCol="scaled", maxIter=500, regParam=0.01)])
    return predicted(steps.fit(rows), rows, "doc_id")


# trees

# a tree of one split over columns with few values: SQL tries every split

_SPLITS = """WITH d AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity AS q, l_linenumber::DOUBLE AS n, l_extendedprice / 1000 AS y, (l_quantity * l_linenumber > 80)::INTEGER::DOUBLE AS k FROM lineitem),
x AS (SELECT 'q' AS f, q AS v, y, k FROM d UNION ALL SELECT 'n', n, y, k FROM d),
g AS (SELECT f, v, count(*)::DOUBLE AS m, sum({t}) AS s FROM x GROUP BY ALL),
r AS (SELECT f, v, sum(m) OVER w AS m, sum(s) OVER w AS s, sum(m) OVER (PARTITION BY f) AS mt, sum(s) OVER (PARTITION BY f) AS st FROM g WINDOW w AS (PARTITION BY f ORDER BY v)),
b AS (SELECT f, v, s / m AS low, (st - s) / (mt - m) AS high FROM r WHERE m < mt ORDER BY s * s / m + (st - s) * (st - s) / (mt - m) DESC LIMIT 1)
SELECT l_orderkey, l_linenumber, l_suppkey, round(CASE WHEN (CASE f WHEN 'q' THEN q ELSE n END) <= v THEN low ELSE high END, 4) AS {c} FROM d, b"""


def stump_rows(t, label):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", c("l_linenumber").cast("double").alias("n"),
                             label.alias("label"))
    return linear.with_features(rows, ["l_quantity", "n"])


@query(_SPLITS.format(t="k", c="p1"))
def fit_tree_cls(t):
    rows = stump_rows(t, (c("l_quantity") * c("l_linenumber") > 80).cast("double"))
    model = DecisionTreeClassifier(maxDepth=1, maxBins=64, impurity="gini").fit(rows)
    return probability_of(model, rows, [1], "l_orderkey", "l_linenumber", "l_suppkey")


@query(_SPLITS.format(t="y", c="prediction"))
def fit_tree_reg(t):
    rows = stump_rows(t, c("l_extendedprice") / 1000)
    return _fitted(DecisionTreeRegressor(maxDepth=1, maxBins=64), rows)


@query()
def fit_tree_deep(t):
    rows = vectors(t)
    return predicted(DecisionTreeClassifier(maxDepth=6, impurity="entropy").fit(rows), rows, "vec_id")


@query()
def fit_forest_cls(t):
    rows = vectors(t)
    return predicted(RandomForestClassifier(**FOREST).fit(rows), rows, "vec_id")


@query()
def fit_forest_reg(t):
    rows = lines(t)
    return predicted(ensembles.Forest(LINE, **LINE_FOREST).fit(rows), rows, "l_orderkey", "l_linenumber")


@query()
def fit_gbt(t):
    rows = lines(t)
    reg = boosting.StagedBoost(100, 3).fit(rows)
    halves = vectors(t, "half")
    cls = boosting.StagedBoost(100, 3, loss=boosting.LogisticLoss, bins=32).fit(halves)
    prices = predicted(reg, rows, c("l_orderkey").alias("id")).withColumn("model", F.lit("regression"))
    return prices.unionByName(predicted(cls, halves, c("vec_id").alias("id")).withColumn("model", F.lit("classes")))


def _residual_sql(trees):
    """Stump after stump in SQL; each looks for the best split of what is left."""
    parts = ["d0 AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity AS q, l_linenumber::DOUBLE AS n, l_quantity * l_linenumber / 10 AS left_over, 0.0::DOUBLE AS prediction FROM lineitem)"]
    for i in range(trees):
        parts += [f"x{i} AS (SELECT 'q' AS f, q AS v, left_over AS y FROM d{i} UNION ALL SELECT 'n', n, left_over FROM d{i})",
                  f"g{i} AS (SELECT f, v, count(*)::DOUBLE AS m, sum(y) AS s FROM x{i} GROUP BY ALL)",
                  f"r{i} AS (SELECT f, v, sum(m) OVER w AS m, sum(s) OVER w AS s, sum(m) OVER (PARTITION BY f) AS mt, sum(s) OVER (PARTITION BY f) AS st FROM g{i} WINDOW w AS (PARTITION BY f ORDER BY v))",
                  f"b{i} AS (SELECT f, v, s / m AS low, (st - s) / (mt - m) AS high FROM r{i} WHERE m < mt ORDER BY s * s / m + (st - s) * (st - s) / (mt - m) DESC LIMIT 1)",
                  f"p{i} AS (SELECT d{i}.*, CASE WHEN (CASE f WHEN 'q' THEN q ELSE n END) <= v THEN low ELSE high END AS step FROM d{i}, b{i})",
                  f"d{i + 1} AS (SELECT l_orderkey, l_linenumber, l_suppkey, q, n, left_over - step AS left_over, prediction + step AS prediction FROM p{i})"]
    return "WITH " + ",\n".join(parts) + f"\nSELECT l_orderkey, l_linenumber, l_suppkey, round(prediction, 4) AS prediction FROM d{trees}"


@query(_residual_sql(3))
def gbt_by_residuals(t):
    _, rows = trees.residual_trees(stump_rows(t, c("l_quantity") * c("l_linenumber") / 10), "label", 3, 1)
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", F.round("prediction", 4).alias("prediction"))


@query()
def gbt_best_iteration(t):
    """Up to 500 trees; the search ends once 50 in a row bring nothing better."""
    rows = lines(t)
    return _stages(t, *trees.best_iteration(rows.filter("fold > 0"), rows.filter("fold = 0"), "label", 500, patience=50)[:2])


def _stages(t, errors, best):
    out = [(i + 1, float(e), i + 1 == best) for i, e in enumerate(errors)]
    return t.spark.createDataFrame(out, "trees int, error double, best boolean")


def _stages_sql(trees, rate):
    """Stump after stump on three folds, with the error on the fourth after each."""
    parts = [f"""l AS (SELECT l_quantity AS q, l_linenumber::DOUBLE AS n, l_quantity * l_linenumber / 10 AS y, l_orderkey % 4 > 0 AS learned FROM lineitem),
d0 AS (SELECT *, (SELECT avg(y) FROM l WHERE learned) AS p FROM l)"""]
    for i in range(trees):
        parts += [f"x{i} AS (SELECT 'q' AS f, q AS v, y - p AS r FROM d{i} WHERE learned UNION ALL SELECT 'n', n, y - p FROM d{i} WHERE learned)",
                  f"g{i} AS (SELECT f, v, count(*)::DOUBLE AS m, sum(r) AS s FROM x{i} GROUP BY ALL)",
                  f"r{i} AS (SELECT f, v, sum(m) OVER w AS m, sum(s) OVER w AS s, sum(m) OVER (PARTITION BY f) AS mt, sum(s) OVER (PARTITION BY f) AS st FROM g{i} WINDOW w AS (PARTITION BY f ORDER BY v))",
                  f"b{i} AS (SELECT f, v, s / m AS low, (st - s) / (mt - m) AS high FROM r{i} WHERE m < mt ORDER BY s * s / m + (st - s) * (st - s) / (mt - m) DESC LIMIT 1)",
                  f"d{i + 1} AS (SELECT q, n, y, learned, p + {rate}::DOUBLE * CASE WHEN (CASE f WHEN 'q' THEN q ELSE n END) <= v THEN low ELSE high END AS p FROM d{i}, b{i})"]
    errors = " UNION ALL ".join(f"SELECT {i + 1} AS trees, avg((y - p) ** 2) AS error FROM d{i + 1} WHERE NOT learned" for i in range(trees))
    return "WITH " + ",\n".join(parts) + f"\nSELECT trees, round(error, 6) AS error, error = min(error) OVER () AS best FROM ({errors})"


@query(_stages_sql(8, 0.4))
def gbt_best_iteration_stumps(t):
    rows = stump_rows(t, c("l_quantity") * c("l_linenumber") / 10)
    errors, best, _ = trees.best_iteration(rows.where("l_orderkey % 4 > 0"), rows.where("l_orderkey % 4 = 0"), "label", 8, 1, 0.4)
    return _stages(t, errors, best).withColumn("error", F.round("error", 6))


@query()
def fit_adaboost(t):
    rows = vectors(t, "half")
    return predicted(trees.BoostedTrees(rounds=10).fit(rows), rows, "vec_id")


@query()
def bagging(t):
    rows = vectors(t)
    return predicted(trees.BaggedTrees("vec_id", TREES).fit(rows), rows, "vec_id")


@query()
def pasting(t):
    rows = vectors(t)
    return predicted(trees.BaggedTrees("vec_id", TREES, replace=False).fit(rows), rows, "vec_id")


@query()
def oob_score(t):
    rows = vectors(t, "half")
    return trees.BaggedTrees("vec_id", TREES).fit(rows).oob_score(rows)


# The same ensembles of trees with one split, whose rows are drawn by a rule that SQL can state: each tree has its own multiplier.

_MULTIPLIERS = list(range(3, 3 + 2 * 51, 2))
_ONLY = ensembles.Forest("l_orderkey", len(_MULTIPLIERS), columns=1).drawn_columns(2)[:, 0].tolist()


def _drawn_sql(rule, only="true", score="k"):
    """Per row and tree (w, said): the weight and what the tree's better side says."""
    return f"""WITH d AS (SELECT row_number() OVER () AS row, l_orderkey, l_linenumber, l_suppkey, l_quantity AS q, l_linenumber::DOUBLE AS n, l_extendedprice / 1000 AS y, (l_quantity * l_linenumber > 80)::INTEGER::DOUBLE AS k FROM lineitem),
t AS (SELECT unnest({_MULTIPLIERS}) AS b, unnest({_ONLY}) AS one),
g AS (SELECT b, f, v, sum({rule}) AS m, sum({rule} * {score}) AS s FROM (SELECT *, 'q' AS f, q AS v FROM d UNION ALL SELECT *, 'n', n FROM d), t WHERE {only} GROUP BY ALL),
r AS (SELECT b, f, v, sum(m) OVER w AS m, sum(s) OVER w AS s, sum(m) OVER (PARTITION BY b, f) AS mt, sum(s) OVER (PARTITION BY b, f) AS st FROM g WINDOW w AS (PARTITION BY b, f ORDER BY v)),
p AS (SELECT b, f, v, s / m AS low, (st - s) / (mt - m) AS high FROM r WHERE m < mt AND m > 0
  QUALIFY row_number() OVER (PARTITION BY b ORDER BY s * s / m + (st - s) * (st - s) / (mt - m) DESC, f DESC, v) = 1),
a AS (SELECT d.*, b, {rule} AS w, CASE WHEN (CASE f WHEN 'q' THEN q ELSE n END) <= v THEN low ELSE high END AS said FROM d, p)"""


_TIMES, _ONCE = "((l_orderkey * b + l_linenumber) % 7 % 3)", "((l_orderkey * b + l_linenumber) % 7 % 2)"
_VOTE = " SELECT l_orderkey, l_linenumber, l_suppkey, (avg((said > 0.5)::INTEGER) > 0.5)::INTEGER::DOUBLE AS prediction FROM a GROUP BY row, l_orderkey, l_linenumber, l_suppkey"


def _drawn(rule):
    """The rule for all multipliers, in numpy: written out as expressions it is more code than the JVM compiles, and as a lambda it is interpreted."""
    many, last = np.array(_MULTIPLIERS), {_TIMES: 3, _ONCE: 2}[rule]

    @F.arrow_udf("array<tinyint>")
    def weights(key: pa.Array, line: pa.Array) -> pa.Array:
        known = pc.and_(key.is_valid(), line.is_valid()).to_numpy(zero_copy_only=False)
        k, n = (v.fill_null(0).to_numpy().astype(np.int64)[:, None] for v in (key, line))
        drawn = np.fmod(np.fmod(k * many + n, 7), last).astype(np.int8)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(k) + 1, dtype=np.int32) * len(many)), pa.array(drawn.ravel(), mask=np.repeat(~known, len(many))))

    return weights("l_orderkey", "l_linenumber")


def _stumps(t, rule, label="k", **more):
    y = (c("l_quantity") * c("l_linenumber") > 80).cast("double") if label == "k" else c("l_extendedprice") / 1000
    rows = stump_rows(t, y)
    return rows, ensembles.Forest("l_orderkey", len(_MULTIPLIERS), depth=1, bins=64, weights=rule and _drawn(rule), **more).fit(rows)


@query(_drawn_sql(_TIMES) + _VOTE)
def bagging_stumps(t):
    rows, model = _stumps(t, _TIMES)
    return model.transform(rows).select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


@query(_drawn_sql(_ONCE) + _VOTE)
def pasting_stumps(t):
    rows, model = _stumps(t, _ONCE)
    return model.transform(rows).select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


@query(_drawn_sql(_TIMES) + """, v AS (SELECT k, (avg((said > 0.5)::INTEGER) > 0.5)::INTEGER AS vote FROM a WHERE w = 0 GROUP BY row, k)
SELECT round(avg((vote = k)::INTEGER), 6) AS oob_accuracy, count(*) AS rows FROM v""")
def oob_score_stumps(t):
    rows, model = _stumps(t, _TIMES)
    return model.oob_score(rows).select(F.round("oob_accuracy", 6).alias("oob_accuracy"), "rows")


@query(_drawn_sql("1", only="(f = 'n')::INTEGER = one", score="y") + " SELECT l_orderkey, l_linenumber, l_suppkey, round(avg(said), 4) AS prediction FROM a GROUP BY row, l_orderkey, l_linenumber, l_suppkey")
def random_subspace_stumps(t):
    rows, model = _stumps(t, None, "y", classes=False, columns=1, replace=False, share=1.0)
    return model.transform(rows).select("l_orderkey", "l_linenumber", "l_suppkey", F.round("prediction", 4).alias("prediction"))


def _rule(b):
    return f"((o_orderkey * {b}) % 7 % 3)"


@query("""SELECT round(avg(m), 4) AS mean, round(stddev_samp(m), 4) AS standard_error FROM (""" + " UNION ALL ".join(
    f"SELECT sum(o_totalprice * {_rule(b)}) / sum({_rule(b)}) AS m FROM orders" for b in (2, 3, 5, 8, 9, 11)) + ")")
def bootstrap_stat(t):
    weights = [F.expr(_rule(b)) for b in (2, 3, 5, 8, 9, 11)]
    out = trees.bootstrap_statistics(t.orders, "o_totalprice", weights)
    return out.select(F.round("mean", 4).alias("mean"), F.round("standard_error", 4).alias("standard_error"))


@query(name="bootstrap_stat_random")
def bootstrap_stat_random(t):
    return trees.bootstrap_statistics(t.orders, "o_totalprice", trees.poisson_weights("o_orderkey", 50))


@query()
def random_subspace(t):
    """Every tree sees all rows and two of the four columns."""
    rows = lines(t)
    model = ensembles.Forest("l_orderkey", TREES, depth=3, classes=False, columns=2, replace=False, share=1.0, seed=5).fit(rows)
    return model.transform(rows).select("l_orderkey", "l_linenumber", "label", "prediction")


# combining given predictions

_V = "SELECT vec_id, vec_id % 3 AS a, vec_id % 4 % 3 AS b, vec_id % 5 % 3 AS c FROM embeddings"


@query(f"SELECT vec_id, CASE WHEN b = c AND a <> b THEN b WHEN a = b OR a = c THEN a ELSE least(a, b, c) END::DOUBLE AS prediction FROM ({_V})")
def vote_hard(t):
    v = c("vec_id")
    votes = [x.cast("double") for x in (v % 3, v % 4 % 3, v % 5 % 3)]
    return t.embeddings.select("vec_id", trees.majority(votes).alias("prediction"))


@query("SELECT vec_id, round((p + q) / 2, 6) AS probability, ((p + q) / 2 > 0.5)::INTEGER AS prediction FROM (SELECT vec_id, vec_id % 10 / 10.0::DOUBLE AS p, vec_id % 7 / 7.0::DOUBLE AS q FROM embeddings)")
def vote_soft(t):
    mean = (c("vec_id") % 10 / F.lit(10.0) + c("vec_id") % 7 / F.lit(7.0)) / 2
    return t.embeddings.select("vec_id", F.round(mean, 6).alias("probability"), (mean > 0.5).cast("int").alias("prediction"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round((a + b) / 2, 4) AS prediction FROM (SELECT l_orderkey, l_linenumber, l_suppkey, 2000 * l_quantity AS a, 1000 + 1900 * l_quantity * (1 - l_tax) AS b FROM lineitem)""")
def blend_average(t):
    a, b = 2000 * c("l_quantity"), 1000 + 1900 * c("l_quantity") * (1 - c("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.round((a + b) / 2, 4).alias("prediction"))


@query()
def stack_models(t):
    rows = lines(t)
    base = {"net": linear.elastic_net(rows, 0.01, 0.5), "tree": DecisionTreeRegressor(maxDepth=4)}
    _, rows = tune.stack_models(rows, base, "label", "fold")
    return rows.select("l_orderkey", "l_linenumber", "label", "oof_net", "oof_tree", "prediction")


# networks

#: Second-order steps on standardised inputs, until the cost stands still or 100 are done; tests hold the solver against 10,000 plain steps.
NETWORK = {"steps": 100, "solver": "lbfgs", "scale": 0.125, "standardise": True}


def _points(t):
    return t.embeddings.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("x"),
                               (c("label") < 5).cast("int").alias("label"))


@query()
def fit_mlp(t):
    rows = _points(t)
    nets, _ = net.train_networks(rows, "x", "label", [6], **NETWORK)
    p = net.probability(nets[0], "x")
    return rows.select("vec_id", "label", p.alias("probability")).withColumn("prediction", (c("probability") > 0.5).cast("int"))


@query()
def sweep_hidden_size(t):
    rows = _points(t)
    sizes = [1, 2, 4, 8, 16, 32]
    nets, costs = net.train_networks(rows, "x", "label", sizes, **NETWORK)
    judged = rows.select("label", *[net.probability(w, "x").alias(f"h{h}") for w, h in zip(nets, sizes)])
    hits = judged.agg(*[F.avg(((c(f"h{h}") > 0.5).cast("int") == c("label")).cast("double")).alias(f"h{h}") for h in sizes])
    return hits.unpivot([], [f"h{h}" for h in sizes], "hidden", "accuracy")


# selection and tables

def _rmse():
    return RegressionEvaluator(metricName="rmse")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round(exp(a + b * l_quantity) - 1, 2) AS l_extendedprice FROM lineitem,
(SELECT regr_slope(ln(1 + l_extendedprice), l_quantity) AS b, regr_intercept(ln(1 + l_extendedprice), l_quantity) AS a FROM lineitem)""")
def predict_table(t):
    rows = one_feature(t).withColumn("label", F.log1p(c("label") * 1000))
    out = linear.linear().fit(rows).transform(rows)
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", F.round(F.expm1("prediction"), 2).alias("l_extendedprice"))


@query()
def importance_table(t):
    rows = lines(t)
    model = ensembles.Forest(LINE, **LINE_FOREST).fit(rows)
    return tune.importance_table(rows, X, model.importances())


@query("WITH d AS (SELECT *, l_extendedprice / 1000 AS y FROM lineitem), r AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM d" for a in [*X, "y"] for b in [*X, "y"])
    + """), v AS (SELECT var_pop(y) AS v FROM d), s1 AS (SELECT a, r FROM r WHERE b = 'y' AND a <> 'y' ORDER BY r * r DESC LIMIT 1),
s2 AS (SELECT y2.a, (s1.r ** 2 + y2.r ** 2 - 2 * s1.r * y2.r * m.r) / (1 - m.r ** 2) AS r2 FROM s1 JOIN r y2 ON y2.b = 'y' AND y2.a NOT IN ('y', s1.a)
JOIN r m ON m.a = s1.a AND m.b = y2.a ORDER BY r2 DESC LIMIT 1)
SELECT 1 AS step, a AS "column", round(v * (1 - r * r), 6) AS mse FROM s1, v UNION ALL SELECT 2, a, round(v * (1 - r2), 6) FROM s2, v""")
def greedy_select(t):
    return tune.greedy_select(lines(t), X, "label", 2).withColumn("mse", F.round("mse", 6))


_FOLDS = _ONE + """, m AS (SELECT f.fold AS out, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY 1)"""


@query(_FOLDS + """ SELECT out AS fold, 'rmse' AS measure, round(sqrt(avg((y - a - b * x) ** 2) FILTER (fold <> out)), 6) AS train,
round(sqrt(avg((y - a - b * x) ** 2) FILTER (fold = out)), 6) AS test FROM d, m GROUP BY 1""")
def cross_validate(t):
    out = tune.cross_validate(one_feature(t), linear.linear(), {"rmse": _rmse()}, "fold")
    return out.withColumns({"train": F.round("train", 6), "test": F.round("test", 6)})


@query(_FOLDS + " SELECT l_orderkey, l_linenumber, l_suppkey, round(a + b * x, 4) AS prediction FROM d JOIN m ON out = fold")
def cross_predict(t):
    out = tune.cross_predict(one_feature(t), linear.linear(), "fold")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", F.round("prediction", 4).alias("prediction"))


_ALPHAS = [0.0, 100.0, 1000.0]


@query(_ONE.replace("l_extendedprice / 1000 AS y", "l_extendedprice / 1000 + l_quantity AS y") + f""", k AS (SELECT unnest({_ALPHAS}::DOUBLE[]) AS alpha),
m AS (SELECT f.fold AS out, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx, stddev_pop(y) AS sy FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY 1),
e AS (SELECT alpha, out, sqrt(avg((y - my - sxy / (sxx + alpha * (SELECT stddev_pop(y) FROM d) / sy) * (x - mx)) ** 2)) AS rmse FROM k, m JOIN d ON fold = out GROUP BY 1, 2)
SELECT round(avg(rmse), 6) AS mean, round(stddev_pop(rmse), 6) AS std, row_number() OVER (ORDER BY avg(rmse))::INTEGER AS place FROM e GROUP BY alpha""")
def grid_search(t):
    """Ridge strengths by cross-validation (Spark applies the penalty relative to each fold's deviation)."""
    rows = one_feature(t).withColumn("label", c("label") + c("l_quantity"))
    model, spread = linear.elastic_net(rows, 1.0, 0.0), linear.label_stats(rows)[1]
    grid = [dict(zip((model.regParam, model.elasticNetParam), linear.penalty(a, 0.0, spread))) for a in _ALPHAS]
    table, _ = tune.grid_search(rows, model, grid, _rmse(), "fold")
    return table.select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "place")


@query()
def grid_search_many(t):
    rows = lines(t).withColumn("label", F.log("label"))
    model, spread = linear.elastic_net(rows, 0.1, 0.5, 50), linear.label_stats(rows)[1]
    grid = [dict(zip((model.regParam, model.elasticNetParam), linear.penalty(alpha, share, spread)))
            for alpha in (0.0017, 0.05) for share in (0.0, 0.35)]
    return tune.grid_search(rows, model, grid, metrics.RmsleEvaluator(), "fold")[0]


@query()
def random_search(t):
    model = LogisticRegression(maxIter=200)
    table, _ = tune.random_search(
        vectors(t, "half"), model,
        tune.combinations_of({model.regParam: np.logspace(-4, 0, 5).tolist(), model.elasticNetParam: [0.0, 0.5]}),
        MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0), "fold", tries=4)
    return table


@query()
def learning_curve(t):
    return tune.learning_curve(lines(t), linear.linear(), _rmse(), "l_orderkey", 5)


@query()
def complexity_curve(t):
    return tune.complexity_curve(lines(t), "l_quantity", "label", "fold", [1, 2, 4, 8])
