"""Splits and model scores."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.ml import folds, metrics

c = F.col


def r(x, digits=6):
    return F.round(x, digits)


# splits

@query("SELECT o_orderkey, o_totalprice, 'test' AS part FROM orders WHERE o_orderkey % 5 < 1 UNION ALL SELECT o_orderkey, o_totalprice, 'train' FROM orders WHERE o_orderkey % 5 >= 1")
def split_holdout(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    train, test = folds.split_holdout(rows, 0.2, bucket=c("o_orderkey") % 5, buckets=5)
    return test.withColumn("part", F.lit("test")).union(train.withColumn("part", F.lit("train")))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def shuffle_rows(t):
    return folds.shuffle_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 7)


@query("SELECT o_orderkey, (o_orderkey % 5)::INTEGER AS fold FROM orders")
def kfold_assign(t):
    return folds.kfold_assign(t.orders.select("o_orderkey"), 5, bucket=c("o_orderkey"))


@query("SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 4)::INTEGER AS fold FROM labels")
def kfold_stratified(t):
    return folds.kfold_stratified(t.labels.select("doc_id", "quality"), 4, "quality", ["doc_id"])


@query("SELECT event_id, user_id, (user_id % 5)::INTEGER AS fold FROM events")
def kfold_group(t):
    return folds.kfold_assign(t.events.select("event_id", "user_id"), 5, bucket=c("user_id"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS fold FROM labels")
def leave_one_out(t):
    return folds.leave_one_out(t.labels.select("doc_id"), ["doc_id"])


# scores of simple deterministic predictions

_P = "SELECT doc_id, quality AS y, ((doc_id * 37) % 101) / 100.0::DOUBLE AS p, (((doc_id * 37) % 101) > 50)::INTEGER AS guess FROM labels"


def scored(t):
    p = (c("doc_id") * 37) % 101
    return t.labels.select("doc_id", c("quality").alias("y"), (p / F.lit(100.0)).alias("p"), (p > 50).cast("int").alias("guess"))


_M = "SELECT vec_id, label, ((vec_id * 7) % 10)::INTEGER AS guess FROM embeddings"


def classes(t):
    return t.embeddings.select("vec_id", "label", ((c("vec_id") * 7) % 10).cast("int").alias("guess"))


@query(f"SELECT label AS actual, guess AS predicted, count(*) AS n FROM ({_M}) GROUP BY ALL")
def confusion_matrix(t):
    return metrics.confusion_matrix(classes(t), "label", "guess")


@query(f"""SELECT actual, predicted, CASE WHEN actual = predicted THEN 0.0 ELSE round(n / sum(n) OVER (PARTITION BY actual), 6) END::DOUBLE AS share
FROM (SELECT label AS actual, guess AS predicted, count(*) AS n FROM ({_M}) GROUP BY ALL)""")
def confusion_normalized(t):
    out = metrics.confusion_normalized(metrics.confusion_matrix(classes(t), "label", "guess"))
    return out.withColumn("share", r("share"))


@query(f"SELECT * FROM ({_M}) WHERE label = 3 AND guess = 5")
def error_cells(t):
    return metrics.error_cells(classes(t), "label", "guess", 3, 5)


@query(f"""SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
round(fn / (tp + fn), 6) AS miss_rate, round(fp / (fp + tn), 6) AS fpr, round(tn / (fp + tn), 6) AS tnr, round((tp + fn) / (tp + fp + fn + tn), 6) AS prevalence FROM (
SELECT count_if(y = 1 AND guess = 1)::BIGINT AS tp, count_if(y = 0 AND guess = 1)::BIGINT AS fp, count_if(y = 1 AND guess = 0)::BIGINT AS fn, count_if(y = 0 AND guess = 0)::BIGINT AS tn FROM ({_P}))""")
def precision_recall_f1(t):
    out = metrics.binary_scores(scored(t), "y", "guess")
    return out.withColumns({x: r(x) for x in out.columns[4:]})


@query(f"SELECT round(avg((label = guess)::INTEGER), 6) AS accuracy FROM ({_M})")
def accuracy(t):
    return metrics.accuracy(classes(t), "label", "guess").withColumn("accuracy", r("accuracy"))


_CUM = f"""SELECT p AS score, sum(sum(y)) OVER w AS tp, sum(sum(1 - y)) OVER w AS fp, sum(y) AS pos, sum(1 - y) AS neg,
sum(sum(y)) OVER () AS tot, sum(sum(1 - y)) OVER () AS ton FROM ({_P}) GROUP BY p WINDOW w AS (ORDER BY p DESC)"""


@query(f"SELECT score, round(tp / (tp + fp), 6) AS precision, round(tp / tot, 6) AS recall FROM ({_CUM})")
def pr_curve(t):
    out = metrics.pr_curve(scored(t), "y", "p")
    return out.withColumns({"precision": r("precision"), "recall": r("recall")})


@query(f"SELECT score, round(fp / ton, 6) AS fpr, round(tp / tot, 6) AS tpr FROM ({_CUM})")
def roc_curve(t):
    out = metrics.roc_curve(scored(t), "y", "p")
    return out.withColumns({"fpr": r("fpr"), "tpr": r("tpr")})


@query(f"""SELECT round(avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END::DOUBLE), 6) AS auc FROM ({_P}) a, ({_P}) b WHERE a.y = 1 AND b.y = 0""")
def roc_auc(t):
    return metrics.roc_auc(scored(t), "y", "p").withColumn("auc", r("auc"))


@query(f"""SELECT round(-avg(y * ln(q) + (1 - y) * ln(1 - q)), 6) AS log_loss FROM (SELECT y, least(greatest(p, 1e-15), 1 - 1e-15) AS q FROM ({_P}))""")
def log_loss(t):
    return metrics.log_loss(scored(t), "y", "p").withColumn("log_loss", r("log_loss"))


@query(f"SELECT round(avg(y), 6) AS precision_at_k FROM (SELECT * FROM ({_P}) ORDER BY p DESC, doc_id LIMIT 50)")
def precision_at_k(t):
    return metrics.precision_at_k(scored(t), "y", "p", "doc_id", 50).withColumn("precision_at_k", r("precision_at_k"))


_R = "SELECT l_extendedprice AS y, 1500 + l_quantity * 2000 AS p FROM lineitem"


def estimated(t):
    return t.lineitem.select(c("l_extendedprice").alias("y"), (1500 + c("l_quantity") * 2000).alias("p"))


@query(f"SELECT round(sqrt(avg((ln(y) - ln(p)) ** 2)), 6) AS rmsle FROM ({_R})")
def rmsle(t):
    return estimated(t).agg(r(metrics.rmsle_of(c("y"), c("p"))).alias("rmsle"))


@query(f"""SELECT round(avg((y - p) ** 2), 2) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
round(avg(abs((y - p) / y)), 6) AS mape, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2 FROM ({_R})""")
def mse_rmse_mae_mape_r2(t):
    out = metrics.regression_scores(estimated(t), "y", "p")
    return out.select(r("mse", 2).alias("mse"), r("rmse", 4).alias("rmse"), r("mae", 4).alias("mae"),
                      r("mape").alias("mape"), r("r2").alias("r2"))


@query(f"SELECT doc_id, (p > 0.4)::INTEGER AS positive FROM ({_P})")
def threshold_apply(t):
    return scored(t).select("doc_id", (c("p") > 0.4).cast("int").alias("positive"))


@query("""SELECT o_orderstatus, round(1 - sum(s * s), 6) AS gini, round(-sum(s * log2(s)), 6) AS entropy, round(1 - max(s), 6) AS error FROM (
SELECT o_orderstatus, count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS s FROM orders GROUP BY o_orderstatus, o_orderpriority) GROUP BY 1""")
def impurity(t):
    from tablecraft.ml.trees import impurity as of_groups
    out = of_groups(t.orders, ["o_orderstatus"], "o_orderpriority")
    return out.withColumns({x: r(x) for x in ("gini", "entropy", "error")})


@query("""SELECT o_orderkey, round(1 / (1 + exp(-(0.5 * x - 1))), 6) AS probability, round(0.5 * x - 1, 8) AS log_odds, 2.0 :: DOUBLE AS boundary, (0.5 * x - 1 > 0)::INTEGER AS guess
FROM (SELECT o_orderkey, o_totalprice / 100000 AS x FROM orders)""")
def log_odds_probability(t):
    from tablecraft.functions.mathx import sigmoid
    z = c("o_totalprice") / 100000 * 0.5 - 1
    return t.orders.select("o_orderkey", r(sigmoid(z)).alias("probability"), r(z, 8).alias("log_odds"),
                           F.lit(1 / 0.5).alias("boundary"), (z > 0).cast("int").alias("guess"))


@query("""SELECT round(sqrt(avg((ln(o_totalprice) - ln(m)) ** 2)), 6) AS rmsle, m AS prediction FROM orders, (SELECT round_even(avg(o_totalprice), 0) AS m FROM orders) GROUP BY m""")
def mean_baseline(t):
    mean = t.orders.agg(F.bround(F.avg("o_totalprice"), 0)).scalar()
    rows = t.orders.select("o_totalprice").withColumn("prediction", mean)
    return rows.groupBy("prediction").agg(r(metrics.rmsle_of(c("o_totalprice"), c("prediction"))).alias("rmsle"))


@query("""SELECT quality AS prediction, round(count(*) / (SELECT count(*) FROM labels), 6) AS accuracy FROM labels GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""")
def majority_baseline(t):
    from tablecraft.operators.aggregate import value_counts
    top = value_counts(t.labels, ["quality"], normalize=True).limit(1)
    return top.select(c("quality").alias("prediction"), r("share").alias("accuracy"))
