"""Profiles, correlations and statistics."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.operators import aggregate
from tablecraft.operators import profile as op

c = F.col


def r(x, digits=6):
    return F.round(x, digits)


_FIG = """round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 4) AS p25,
round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, max(v) AS max"""
_NONE = ", ".join(f"NULL::DOUBLE AS {x}" for x in ("mean", "std", "min", "p25", "p50", "p75", "max"))


def _column(name, dtype, numeric):
    return f"""SELECT '{name}' AS "column", '{dtype}' AS dtype, count(*) AS rows, count(*) - count(v) AS missing, {_FIG if numeric else _NONE},
(SELECT sum(n - 1)::BIGINT FROM (SELECT d, count(*) AS n FROM d GROUP BY d)) AS duplicates FROM (SELECT {name}{'::DOUBLE' if numeric else ''} AS v FROM d)"""


def _rounded(df):
    return df.withColumns({x: r(x, 4) for x in ("mean", "std", "p25", "p50", "p75")})


@query("""WITH d AS (SELECT l_quantity, l_returnflag, CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_tax END AS l_tax, l_suppkey FROM lineitem) """
       + " UNION ALL ".join([_column("l_quantity", "double", True), _column("l_returnflag", "string", False),
                             _column("l_tax", "double", True), _column("l_suppkey", "bigint", True)]))
def describe_table(t):
    rows = t.lineitem.select("l_quantity", "l_returnflag", F.when(c("l_orderkey") % 9 != 0, c("l_tax")).alias("l_tax"), "l_suppkey")
    return _rounded(op.describe_table(rows))


@query("""WITH d AS (SELECT * FROM (SELECT c_acctbal, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer) WHERE c_nationkey IS NOT NULL) """
       + " UNION ALL ".join([_column("c_acctbal", "double", True), _column("c_nationkey", "int", True)]))
def describe_after_dropna(t):
    rows = t.customer.select("c_acctbal", F.when(c("c_custkey") % 3 != 0, c("c_nationkey")).alias("c_nationkey"))
    return _rounded(op.describe_table(rows.dropna()))


@query(" UNION ALL ".join(f"""SELECT '{x}' AS "column", round(skewness({x}), 6) AS skew, round(kurtosis({x}), 6) AS kurt FROM {t}"""
                          for x, t in (("value", "events"), ("user_id", "events"))))
def skew_kurtosis(t):
    out = op.skew_kurtosis(t.events, ["value", "user_id"])
    return out.withColumns({"skew": r("skew"), "kurt": r("kurt")})


_SKEW = "SELECT value, value * value AS squared, sqrt(value) AS root, user_id FROM events"


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", round(skewness({x}) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1)), 6) AS skew FROM ({_SKEW})"""
    for x in ("value", "squared", "root", "user_id")) + ") WHERE abs(skew) > 0.9")
def skewed_columns(t):
    rows = t.events.select("value", (c("value") * c("value")).alias("squared"), F.sqrt("value").alias("root"), "user_id")
    return op.skewed_columns(rows, rows.columns, 0.9).withColumn("skew", r("skew"))


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", count(DISTINCT {x}) AS distinct_values FROM lineitem"""
    for x in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    + ") WHERE distinct_values >= 120")
def high_cardinality_numeric(t):
    return op.high_cardinality_numeric(t.lineitem, 120)


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _corr_sql(names, source):
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM {source}" for a in names for b in names)


_GAPPY = "(SELECT * REPLACE (CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE l_tax END AS l_tax) FROM lineitem)"


def gappy_lines(t):
    return t.lineitem.withColumn("l_tax", F.when(c("l_orderkey") % 6 != 0, c("l_tax")))


@query(_corr_sql(_NUM, _GAPPY))
def corr_matrix(t):
    return op.corr_matrix(gappy_lines(t), _NUM).withColumn("corr", r("corr"))


@query(" UNION ALL ".join(f"""SELECT '{x}' AS "column", round(corr({x}, l_extendedprice), 6) AS corr, count({x})::BIGINT AS n FROM {_GAPPY}"""
                          for x in _NUM if x != "l_extendedprice"))
def corr_vs_target(t):
    out = op.corr_vs_target(gappy_lines(t), [x for x in _NUM if x != "l_extendedprice"], "l_extendedprice")
    return out.select("column", r("corr").alias("corr"), "n")


@query(f"""WITH m AS ({_corr_sql(_NUM, _GAPPY)}) SELECT a, place, b AS partner, corr FROM (
SELECT *, row_number() OVER (PARTITION BY a ORDER BY abs(corr) DESC, b)::INTEGER AS place FROM m WHERE a <> b) WHERE place <= 2""")
def top_corr_partners(t):
    matrix = op.corr_matrix(gappy_lines(t), _NUM).withColumn("corr", r("corr"))
    return op.top_corr_partners(matrix, 3)


@query(" UNION ALL ".join(f"SELECT '{x}' AS feature, {x} AS level, round(avg(o_totalprice), 4) AS mean_target, count(*) AS n FROM orders GROUP BY 2"
                          for x in ("o_orderstatus", "o_orderpriority")))
def target_by_category(t):
    out = op.target_by_category(t.orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice")
    return out.withColumn("mean_target", r("mean_target", 4))


@query(" UNION ALL ".join(f"SELECT '{x}' AS variable, {x} AS value, count(v) AS count, {_FIG} FROM (SELECT *, o_totalprice AS v FROM orders) GROUP BY 2"
                          for x in ("o_orderstatus", "o_orderpriority")))
def group_stats_long(t):
    return _rounded(op.group_stats_long(t.orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice"))


@query("SELECT quality, count(*) AS n, count(*) / (SELECT count(*) FROM labels) AS share FROM labels GROUP BY 1")
def class_balance(t):
    return aggregate.value_counts(t.labels, ["quality"], normalize=True)


@query("""WITH b AS (SELECT min(value) AS a, (max(value) - min(value)) / 20 AS w FROM events)
SELECT i::INTEGER AS bin, count(value) AS n FROM (SELECT unnest(range(0, 20)) AS i) LEFT JOIN (
SELECT value, least(floor((value - a) / w), 19) AS slot FROM events, b) ON i = slot GROUP BY 1""")
def histogram_counts(t):
    return op.histogram_counts(t.events, "value", 20)
