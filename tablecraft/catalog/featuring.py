"""Feature engineering."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.operators import aggregate, profile
from tablecraft.operators import features as op

c = F.col


def r(x, digits=6):
    return F.round(x, digits)


@query("""SELECT o_orderkey, """ + ", ".join(f"""(o_orderstatus = '{x}')::INTEGER AS "o_orderstatus_{x}" """ for x in "FOP")
       + " FROM orders")
def one_hot(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    early = t.orders.filter(c("o_orderdate") < "1997-01-01").select(*rows.columns)
    return op.one_hot(rows, ["o_orderstatus"], fitted_on=[early, rows])


_CODE = "dense_rank() OVER (ORDER BY source) - 1"


@query(f"SELECT doc_id, source, {_CODE} AS code FROM documents")
def label_encode(t):
    return op.label_encode(t.documents.select("doc_id", "source"), "source", "code")


@query("SELECT doc_id, source, " + ", ".join(f"((({_CODE}) >> {b}) & 1)::INTEGER AS bit_{b}" for b in range(5)) + " FROM documents")
def binary_encode(t):
    return op.binary_encode(t.documents.select("doc_id", "source"), "source", "bit")


@query("""WITH d AS (SELECT o_orderkey, o_orderpriority AS cat, o_orderkey % 5 AS fold, o_totalprice AS y FROM orders),
p AS (SELECT f.fold, (SELECT avg(y) FROM d WHERE d.fold <> f.fold) AS prior FROM (SELECT DISTINCT fold FROM d) f),
e AS (SELECT k.cat, k.fold, sum(d.y) AS s, count(d.y) AS n FROM (SELECT DISTINCT cat, fold FROM d) k JOIN d ON d.cat = k.cat AND d.fold <> k.fold GROUP BY ALL)
SELECT o_orderkey, d.cat, d.fold, round((s + 10 * prior) / (n + 10), 4) AS encoded FROM d JOIN e ON e.cat = d.cat AND e.fold = d.fold JOIN p ON p.fold = d.fold""")
def target_encode_oof(t):
    rows = t.orders.select("o_orderkey", c("o_orderpriority").alias("cat"), (c("o_orderkey") % 5).alias("fold"), c("o_totalprice").alias("y"))
    out = op.target_encode_oof(rows, "cat", "y", "fold", "encoded", smoothing=10)
    return out.select("o_orderkey", "cat", "fold", r("encoded", 4).alias("encoded"))


@query("""SELECT doc_id, CASE WHEN n < 50 THEN 'Other' ELSE source END AS source FROM documents JOIN (SELECT source, count(*) AS n FROM documents GROUP BY 1) USING (source)""")
def rare_to_other(t):
    return op.rare_to_other(t.documents.select("doc_id", "source"), "source", 50)


@query("""SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 18 THEN 'low' WHEN p_size > 18 AND p_size <= 45 THEN 'high' END AS bin FROM part""")
def bin_numeric(t):
    return t.part.select("p_partkey", op.cut(c("p_size"), [0, 18, 45], ["low", "high"]).alias("bin"))


@query("""SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal,
round((c_acctbal - (SELECT median(c_acctbal) FROM customer)) / (SELECT quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25) FROM customer), 6) AS robust FROM customer""")
def center_scale(t):
    rows = op.robust_scale(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "robust")
    return op.center_scale(rows, ["c_acctbal"]).select("c_custkey", r("c_acctbal").alias("c_acctbal"), r("robust").alias("robust"))


@query("""SELECT p_partkey, round((p_size - a) / (b - a), 6) AS p_size, round((p_retailprice - e) / (f - e), 6) AS p_retailprice FROM part,
(SELECT min(p_size) AS a, max(p_size) AS b, min(p_retailprice) AS e, max(p_retailprice) AS f FROM part)""")
def min_max_scale(t):
    out = op.min_max_scale(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return out.withColumns({"p_size": r("p_size"), "p_retailprice": r("p_retailprice")})


@query("""SELECT event_id, round(ln(value + 3), 6) AS logged, round(ln(1 + value), 6) AS log1, round(exp(ln(1 + value)) - 1, 6) AS back FROM events""")
def log_transform(t):
    v = c("value")
    return t.events.select("event_id", r(F.log(v + 3)).alias("logged"), r(F.log1p(v)).alias("log1"),
                           r(F.expm1(F.log1p(v))).alias("back"))


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN round(sqrt(c_acctbal), 6) END AS root, CASE WHEN c_nationkey <> 0 THEN round(1.0::DOUBLE / c_nationkey, 6) END AS inverse FROM customer")
def sqrt_inverse_transform(t):
    return t.customer.select("c_custkey", r(F.when(c("c_acctbal") >= 0, F.sqrt("c_acctbal"))).alias("root"),
                             r(F.try_divide(F.lit(1.0), c("c_nationkey"))).alias("inverse"))


@query("""SELECT event_id, round(((2 + value) ** 0.25 - 1) / 0.25, 6) AS quarter, round(ln(2 + value), 6) AS zero FROM events""")
def boxcox_apply(t):
    v = c("value") + 1
    return t.events.select("event_id", r(op.boxcox(v, 0.25)).alias("quarter"), r(op.boxcox(v, 0)).alias("zero"))


@query()
def boxcox_fit(t):
    found = op.boxcox_fit(t.events, ["value"], shift=2.0)
    return t.events.select("event_id", *[op.boxcox(c(x) + 1, p).alias(x) for x, p in found.items()],
                           *[F.lit(p).alias(f"power_{x}") for x, p in found.items()])


@query("""SELECT event_id, 1.0::DOUBLE AS bias, value, user_id::DOUBLE AS user_id, value * value AS "value*value", value * user_id AS "value*user_id",
user_id::DOUBLE * user_id AS "user_id*user_id" FROM events""")
def poly_features(t):
    return op.poly_features(t.events, ["value", "user_id"], ["event_id"])


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round(l_quantity + l_extendedprice + 0.5 * l_tax, 4) AS total,
round((l_extendedprice + avg(l_extendedprice) OVER (PARTITION BY l_quantity)) / 2, 7) AS price_and_group,
(l_discount > 0)::INTEGER AS has_discount, (l_tax > 0)::INTEGER AS has_tax, month(l_shipdate)::VARCHAR AS month FROM lineitem""")
def house_features(t):
    price = c("l_extendedprice")
    out = aggregate.group_transform(t.lineitem, ["l_quantity"], [F.avg(price).alias("_m")], {
        "total": r(c("l_quantity") + price + 0.5 * c("l_tax"), 4), "price_and_group": r((price + c("_m")) / 2, 7),
        "has_discount": F.when(c("l_discount") > 0, 1).otherwise(0), "has_tax": F.when(c("l_tax") > 0, 1).otherwise(0),
        "month": F.month("l_shipdate").cast("string")})
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "total", "price_and_group", "has_discount", "has_tax", "month")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round(l_quantity / n, 6) AS l_quantity, round(l_linenumber / n, 6) AS l_linenumber_unit
FROM (SELECT *, sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber) AS n FROM lineitem)""")
def spatial_sign(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", c("l_linenumber").alias("l_linenumber_unit"))
    out = op.spatial_sign(rows, ["l_quantity", "l_linenumber_unit"])
    return out.withColumns({x: r(x) for x in ("l_quantity", "l_linenumber_unit")})


@query("SELECT event_id, value FROM events WHERE value <= (SELECT quantile_cont(value, 0.95) FROM events)")
def outlier_mask(t):
    return op.outlier_mask(t.events.select("event_id", "value"), "value", 0.95)


# two standardized columns have the axes (1, 1) and (1, -1); the sign of an axis is free

@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round(abs(a + sign(r) * b) / sqrt(2), 4) AS pc1, round(abs(a - sign(r) * b) / sqrt(2), 4) AS pc2 FROM (
SELECT l_orderkey, l_linenumber, l_suppkey, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS a,
(l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS b, corr(l_quantity, l_extendedprice) OVER () AS r FROM lineitem)""")
def pca_project(t):
    out = op.pca_project(t.lineitem, ["l_quantity", "l_extendedprice"], 2, ["l_orderkey", "l_linenumber", "l_suppkey"])
    return out.withColumns({x: r(F.abs(x), 4) for x in ("pc1", "pc2")})


@query()
def pca_project_many(t):
    return op.pca_project(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 2, ["l_orderkey", "l_linenumber"])


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{x}' AS "column", round(var_pop({x}), 4) AS variance FROM lineitem""" for x in _NUM) + ") WHERE variance > 0.5")
def variance_filter(t):
    return op.variance_filter(t.lineitem, _NUM, 0.5).withColumn("variance", r("variance", 4))


_LINES = "(SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)"


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem""")
def collinear_filter(t):
    lines = t.lineitem.withColumns({"net": c("l_extendedprice") * (1 - c("l_discount"))})
    names = ["l_quantity", "l_extendedprice", "net", "l_discount"]
    kept = op.collinear_filter(profile.corr_matrix(lines, names), names, 0.5)
    return lines.select("l_orderkey", "l_linenumber", *kept)


_LABELLED = "(SELECT * FROM documents JOIN labels USING (doc_id))"
_MI = """SELECT 'mutual information' AS method, '{x}' AS feature, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS score FROM (
SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM (
SELECT {x} AS x, quality AS y, count(*)::DOUBLE AS n FROM {src} GROUP BY ALL))"""
_F = """SELECT 'anova f' AS method, '{x}' AS feature, round(((sum(n * m * m) - sum(n * m) ** 2 / sum(n)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 6) AS score
FROM (SELECT quality, count(*)::DOUBLE AS n, avg({x}) AS m, var_pop({x}) * count(*) AS w FROM {src} GROUP BY 1)"""
_CHI = """SELECT 'chi2' AS method, '{x}' AS feature, round(sum((s - st * n / nt) ** 2 / (st * n / nt)), 6) AS score FROM (
SELECT s, n, sum(s) OVER () AS st, sum(n) OVER () AS nt FROM (SELECT quality, sum({x})::DOUBLE AS s, count(*)::DOUBLE AS n FROM {src} GROUP BY 1))"""


@query(" UNION ALL ".join([_MI.format(x=x, src=_LABELLED) for x in ("lang", "source")]
                          + [f.format(x=x, src=_LABELLED) for f in (_F, _CHI) for x in ("n_chars", "doc_id")]))
def univariate_select(t):
    rows = t.documents.join(t.labels, "doc_id")
    scores = {"mutual information": op.mutual_information(rows, ["lang", "source"], "quality"),
              "anova f": op.anova_f(rows, ["n_chars", "doc_id"], "quality"),
              "chi2": op.chi2_scores(rows, ["n_chars", "doc_id"], "quality")}
    parts = [op.select_best(s, k=2).select(F.lit(m).alias("method"), "feature", r("score").alias("score"))
             for m, s in scores.items()]
    return parts[0].union(parts[1]).union(parts[2])
