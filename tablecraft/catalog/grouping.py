"""Aggregation and grouping."""

import pandas as pd
from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.operators import aggregate as op
from tablecraft.operators import reshape
from tablecraft.plans.quantiles import percentiles

c = F.col


def r(column, digits=4):
    return F.round(column, digits)


@query("""SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean,
min(o_totalprice) AS low, max(o_totalprice) AS high, arg_min(o_totalprice, o_orderkey) AS first, arg_max(o_totalprice, o_orderkey) AS last
FROM orders GROUP BY 1""")
def agg_basic(t):
    v = "o_totalprice"
    return t.orders.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), r(F.sum(v), 2).alias("total"), r(F.avg(v)).alias("mean"), F.min(v).alias("low"),
        F.max(v).alias("high"), F.min_by(v, "o_orderkey").alias("first"), F.max_by(v, "o_orderkey").alias("last"))


@query("SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY ALL")
def agg_median(t):
    out = op.median(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return out.withColumn("median", r("median"))


@query("""SELECT event_type, round(quantile_cont(value, 0.1), 4) AS p10, round(quantile_cont(value, 0.9), 4) AS p90,
round(quantile_cont(value, 0.99), 4) AS p99 FROM events GROUP BY 1""")
def agg_percentile(t):
    out = percentiles(t.events, ["event_type"], "value", {"p10": 0.1, "p90": 0.9, "p99": 0.99})
    return out.select("event_type", *[r(p).alias(p) for p in ("p10", "p90", "p99")])


@query("""SELECT c_mktsegment, round(stddev_samp(c_acctbal), 4) AS std, round(var_samp(c_acctbal), 2) AS var,
round(stddev_pop(c_acctbal), 4) AS std0, round(var_pop(c_acctbal), 2) AS var0 FROM customer GROUP BY 1""")
def agg_std_var(t):
    v = "c_acctbal"
    return t.customer.groupBy("c_mktsegment").agg(
        r(F.stddev(v)).alias("std"), r(F.variance(v), 2).alias("var"),
        r(F.stddev_pop(v)).alias("std0"), r(F.var_pop(v), 2).alias("var0"))


@query("""SELECT l_suppkey, round(avg(abs(l_quantity - m)), 6) AS mad FROM lineitem
JOIN (SELECT l_suppkey, avg(l_quantity) AS m FROM lineitem GROUP BY 1) USING (l_suppkey) GROUP BY 1""")
def agg_mad(t):
    return op.mean_abs_deviation(t.lineitem, ["l_suppkey"], "l_quantity").withColumn("mad", r("mad", 6))


@query("SELECT event_type, round(product(1 + value / 1000000), 6) AS growth FROM events GROUP BY 1")
def agg_product(t):
    return t.events.groupBy("event_type").agg(r(F.product(1 + c("value") / 1000000), 6).alias("growth"))


@query("""SELECT o_custkey, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest
FROM orders GROUP BY 1""")
def agg_argmin_argmax(t):
    rank = F.struct("o_totalprice", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", rank).alias("cheapest"),
                                             F.max_by("o_orderkey", rank).alias("dearest"))


@query("""SELECT l_orderkey, bool_or(l_quantity > 45) AS any_big, bool_and(l_discount < 0.08) AS all_cheap FROM lineitem GROUP BY 1""")
def agg_any_all(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.bool_or(c("l_quantity") > 45).alias("any_big"),
                                                F.bool_and(c("l_discount") < 0.08).alias("all_cheap"))


@query("""SELECT count_if(l_quantity > 24)::BIGINT AS many, count_if(l_discount = 0 AND l_tax > 0.02)::BIGINT AS plain, count(*) AS n FROM lineitem""")
def agg_count_if(t):
    return t.lineitem.agg(F.count_if(c("l_quantity") > 24).alias("many"),
                          F.count_if((c("l_discount") == 0) & (c("l_tax") > 0.02)).alias("plain"), F.count("*").alias("n"))


_GAPPY = "CASE WHEN event_id % 7 = 0 OR event_type = 'signup' THEN NULL ELSE value END"


@query(f"""SELECT event_type, round(coalesce(sum(v), 0), 2) AS total, max(v) AS high, round(avg(v), 4) AS mean, count(v) AS n
FROM (SELECT event_type, {_GAPPY} AS v FROM events) GROUP BY 1""")
def agg_nan_skipping(t):
    gappy = F.when((c("event_id") % 7 != 0) & (c("event_type") != "signup"), c("value"))
    return t.events.select("event_type", gappy.alias("v")).groupBy("event_type").agg(
        r(op.nansum("v"), 2).alias("total"), F.max("v").alias("high"), r(F.avg("v")).alias("mean"), F.count("v").alias("n"))


@query("""SELECT p_brand, min(p_retailprice) AS low, round(median(p_retailprice), 4) AS median, max(p_retailprice) AS high,
count(DISTINCT p_type) AS kinds FROM part GROUP BY 1""")
def agg_multi(t):
    v = "p_retailprice"
    basic = t.part.groupBy("p_brand").agg(F.min(v).alias("low"), F.max(v).alias("high"),
                                          F.count_distinct("p_type").alias("kinds"))
    middle = op.median(t.part, ["p_brand"], v).withColumn("median", r("median"))
    return basic.join(middle, "p_brand")


@query("""SELECT l_shipmode_key, round(sum(l_quantity), 2) AS l_quantity_sum, count(l_tax) AS l_tax_count, max(l_tax) AS l_tax_max
FROM (SELECT l_suppkey % 10 AS l_shipmode_key, l_quantity, l_tax FROM lineitem) GROUP BY 1""")
def agg_by_column(t):
    keyed = t.lineitem.withColumn("l_shipmode_key", c("l_suppkey") % 10)
    out = op.aggregate_by_column(keyed, ["l_shipmode_key"], {"l_quantity": ["sum"], "l_tax": ["count", "max"]})
    return out.withColumn("l_quantity_sum", r("l_quantity_sum", 2))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round((l_quantity + l_discount + l_tax) / 3, 6) AS mean,
greatest(l_quantity, l_discount, l_tax) AS high FROM lineitem""")
def row_wise_agg(t):
    parts = [c("l_quantity"), c("l_discount"), c("l_tax")]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             r(sum(parts[1:], parts[0]) / 3, 6).alias("mean"), F.greatest(*parts).alias("high"))


@query("""SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING stddev_samp(o_totalprice) > 130000)""")
def group_filter(t):
    return op.group_filter(t.orders, ["o_custkey"], [F.stddev("o_totalprice").alias("sd")], "sd > 130000")


@query("""SELECT o_orderkey, o_custkey, round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS centered,
round(avg(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS mean FROM orders""")
def group_transform(t):
    v, m = "o_totalprice", c("_m")
    return op.group_transform(t.orders.select("o_orderkey", "o_custkey", v), ["o_custkey"], [F.avg(v).alias("_m")],
                              {"centered": r(c(v) - m, 6), "mean": r(m, 6)}).drop(v)


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, round(1000000 * l_quantity / sum(l_extendedprice) OVER (PARTITION BY l_returnflag), 8) AS share
FROM lineitem""")
def group_apply(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice")
    out = op.group_transform(lines, ["l_returnflag"], [F.sum("l_extendedprice").alias("_s")],
                             {"share": r(1000000 * c("l_quantity") / c("_s"), 8)})
    return out.drop("l_quantity", "l_extendedprice")


@query("""SELECT o_custkey, round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders GROUP BY 1""", name="group_apply_pandas")
def group_apply_pandas(t):
    def spread(group: pd.DataFrame) -> pd.DataFrame:
        price = group["o_totalprice"]
        return pd.DataFrame({"o_custkey": group["o_custkey"].iloc[:1], "spread": [price.max() - price.min()]})

    out = op.group_apply(t.orders.select("o_custkey", "o_totalprice"), ["o_custkey"], spread,
                         "o_custkey long, spread double")
    return out.withColumn("spread", r("spread", 2))


@query("""SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'slow' END AS pace, count(*) AS n,
round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1""")
def group_by_mapping(t):
    pace = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "slow", "5-LOW": "slow"}
    return op.group_by_mapping(t.orders, "o_orderpriority", pace, "pace", F.count("*").alias("n"),
                               r(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT lower(p_type) AS kind, p_size % 2 = 0 AS even, count(*) AS n, round(avg(p_retailprice), 4) AS mean FROM part GROUP BY ALL""")
def group_by_function(t):
    return t.part.groupBy(F.lower("p_type").alias("kind"), (c("p_size") % 2 == 0).alias("even")).agg(
        F.count("*").alias("n"), r(F.avg("p_retailprice")).alias("mean"))


@query("SELECT quality, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def group_by_external(t):
    return op.group_by_external(t.documents, t.labels, "doc_id", "quality",
                                F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


_DESCRIBE = """count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min,
round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, max(v) AS max"""


def rounded_describe(df):
    return df.withColumns({x: r(x) for x in ("mean", "std", "p25", "p50", "p75")})


@query(f"SELECT o_orderpriority, {_DESCRIBE} FROM (SELECT *, o_totalprice AS v FROM orders) GROUP BY 1")
def group_describe(t):
    return rounded_describe(op.group_describe(t.orders, ["o_orderpriority"], "o_totalprice"))


@query("SELECT source, lang, count(*) AS n_rows, 5 AS n_columns FROM documents GROUP BY ALL")
def group_shapes(t):
    return t.documents.groupBy("source", "lang").agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(t.documents.columns)))


@query("""SELECT lang, source, count(*) AS n, count(*) / (SELECT count(*) FROM documents WHERE source <> 'src0') AS share
FROM documents WHERE source <> 'src0' GROUP BY ALL""")
def value_counts(t):
    known = t.documents.withColumn("source", F.when(c("source") != "src0", c("source")))
    return op.value_counts(known, ["lang", "source"], normalize=True)


@query("""SELECT o_orderpriority, coalesce(sum(o_totalprice) FILTER (d = 1990), 0) AS "1990s", coalesce(sum(o_totalprice) FILTER (d = 2000), 0) AS "2000s"
FROM (SELECT o_orderpriority, round(sum(o_totalprice), 2) AS o_totalprice, 10 * (year(o_orderdate) // 10) AS d FROM orders GROUP BY ALL) GROUP BY 1""")
def decade_counts(t):
    decade = F.concat((10 * F.floor(F.year("o_orderdate") / 10)).cast("string"), F.lit("s"))
    orders = t.orders.select("o_orderpriority", "o_totalprice", decade.alias("decade"))
    decades = sorted({*reshape.pivot_values(orders, "decade"), "1990s", "2000s"})
    return orders.groupBy("o_orderpriority").pivot("decade", decades).agg(r(F.sum("o_totalprice"), 2)).fillna(0.0)


@query("""SELECT CAST(i AS BIGINT) AS p_size, count(p_partkey) AS n FROM (SELECT unnest(range(0, 64)) AS i) LEFT JOIN part ON p_size = i GROUP BY 1""")
def scatter_add(t):
    return op.scatter_add(t.part, "p_size", 64)
