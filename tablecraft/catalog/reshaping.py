"""Reshaping, ordered operations and missing values."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.operators import aggregate, missing, ordered, reshape
from tablecraft.plans.ordering import running

c = F.col


@query("""SELECT o_orderpriority, round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS "F",
round(avg(o_totalprice) FILTER (o_orderstatus = 'O'), 4) AS "O", round(avg(o_totalprice) FILTER (o_orderstatus = 'P'), 4) AS "P"
FROM orders GROUP BY 1""")
def pivot_mean(t):
    return reshape.pivot_table(t.orders, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"],
                               F.round(F.avg("o_totalprice"), 4))


@query("""SELECT l_returnflag, CASE WHEN l_quantity <= 10 THEN '(0, 10]' WHEN l_quantity <= 30 THEN '(10, 30]' ELSE '(30, 50]' END AS bin,
round(sum(l_extendedprice) FILTER (l_linestatus = 'F'), 2) AS "F_sum", round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 4) AS "F_mean",
round(sum(l_extendedprice) FILTER (l_linestatus = 'O'), 2) AS "O_sum", round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 4) AS "O_mean"
FROM lineitem GROUP BY ALL""")
def pivot_multi(t):
    from tablecraft.operators.features import cut
    binned = t.lineitem.withColumn("bin", cut(c("l_quantity"), [0, 10, 30, 50]))
    v = "l_extendedprice"
    return reshape.pivot_table(binned, ["l_returnflag", "bin"], "l_linestatus", ["F", "O"],
                               F.round(F.sum(v), 2).alias("sum"), F.round(F.avg(v), 4).alias("mean"))


@query("""SELECT CASE GROUPING(l_returnflag) WHEN 1 THEN 'All' ELSE l_returnflag END AS l_returnflag,
round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 4) AS "F", round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 4) AS "O",
round(avg(l_extendedprice), 4) AS "All" FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01'
GROUP BY GROUPING SETS ((l_returnflag), ())""")
def pivot_margins(t):
    late = t.lineitem.filter(c("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
    return reshape.pivot_margins(late, "l_returnflag", "l_linestatus", ["F", "O"],
                                 F.round(F.avg("l_extendedprice"), 4))


_WIDE = """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price, CAST(o_custkey AS DOUBLE) AS cust FROM orders"""


def _wide(t):
    return t.orders.select("o_orderkey", F.when(c("o_orderkey") % 5 != 0, c("o_totalprice")).alias("price"),
                           c("o_custkey").cast("double").alias("cust"))


@query(f"""WITH w AS ({_WIDE}) SELECT o_orderkey, 'price' AS variable, price AS value FROM w UNION ALL SELECT o_orderkey, 'cust', cust FROM w""")
def melt_long(t):
    return reshape.melt_long(_wide(t), ["o_orderkey"], ["price", "cust"])


@query(f"""WITH w AS ({_WIDE}) SELECT o_orderkey, 'price' AS variable, price AS value FROM w WHERE price IS NOT NULL UNION ALL SELECT o_orderkey, 'cust', cust FROM w""")
def stack_level(t):
    return reshape.melt_long(_wide(t), ["o_orderkey"], ["price", "cust"], drop_null=True)


@query("""SELECT c_nationkey, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS "AUTOMOBILE", count(*) FILTER (c_mktsegment = 'BUILDING') AS "BUILDING",
count(*) FILTER (c_mktsegment = 'FURNITURE') AS "FURNITURE", count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS "HOUSEHOLD",
count(*) FILTER (c_mktsegment = 'MACHINERY') AS "MACHINERY" FROM customer GROUP BY 1""")
def unstack_level(t):
    keyed = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    levels = reshape.pivot_values(keyed, "c_mktsegment")
    return reshape.pivot_table(keyed, ["c_nationkey"], "c_mktsegment", levels, F.first("n")).fillna(0)


@query("""SELECT c_custkey, n FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders
WHERE o_totalprice > 400000 GROUP BY 1) USING (c_custkey)""")
def reindex_keys(t):
    counts = (t.orders.filter("o_totalprice > 400000").groupBy(c("o_custkey").alias("c_custkey"))
              .agg(F.count("*").alias("n")))
    return reshape.reindex_keys(counts, t.customer.select("c_custkey"))


# ordered operations

@query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
SELECT event_id, user_id, CASE WHEN value IS NOT NULL THEN round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2) END AS running,
CASE WHEN value IS NOT NULL THEN round(sum(value) OVER (ORDER BY ts, event_id), 2) END AS running_all FROM e""")
def cumulative_sum(t):
    events = t.events.select("event_id", "user_id", "ts", F.when(c("event_id") % 7 != 0, c("value")).alias("value"))
    by_user = running(events, ["user_id"], ["ts", "event_id"], {"running": ("sum", "value")})
    both = running(by_user, [], ["ts", "event_id"], {"running_all": ("sum", "value")})
    return both.select("event_id", "user_id", F.round("running", 2).alias("running"),
                       F.round("running_all", 2).alias("running_all"))


@query("""SELECT event_id, round(exp(sum(ln(1 + value / 100000)) OVER (PARTITION BY user_id ORDER BY ts, event_id)), 9) AS growth FROM events""")
def cumulative_product(t):
    events = t.events.select("event_id", "user_id", "ts", (1 + c("value") / 100000).alias("factor"))
    out = running(events, ["user_id"], ["ts", "event_id"], {"growth": ("product", "factor")})
    return out.select("event_id", F.round("growth", 9).alias("growth"))


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS)
OVER (PARTITION BY user_id ORDER BY ts, event_id) AS filled FROM events""")
def forward_fill(t):
    events = t.events.select("event_id", "user_id", "ts", F.when(c("event_id") % 3 == 0, c("value")).alias("gappy"))
    return running(events, ["user_id"], ["ts", "event_id"], {"filled": ("last", "gappy")}).select(
        "event_id", "user_id", "filled")


@query("""SELECT event_id, coalesce(a, b, k) AS a, coalesce(b, k) AS b, k FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value END AS a,
CASE WHEN event_id % 3 = 0 THEN value + 1 END AS b, CASE WHEN event_id % 5 <> 0 THEN value + 2 END AS k FROM events)""")
def row_backfill(t):
    events = t.events.select("event_id", F.when(c("event_id") % 2 == 0, c("value")).alias("a"),
                             F.when(c("event_id") % 3 == 0, c("value") + 1).alias("b"),
                             F.when(c("event_id") % 5 != 0, c("value") + 2).alias("k"))
    return missing.row_backfill(events, ["a", "b", "k"])


@query("""SELECT o_custkey, o_orderkey, o_totalprice, place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS place FROM orders) WHERE place <= 3""")
def top_k_per_group(t):
    return ordered.top_k_per_group(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"],
                                   [F.desc("o_totalprice"), "o_orderkey"], 3, "place")


@query("""SELECT p_brand, mean, rank() OVER (ORDER BY mean DESC NULLS LAST) AS place FROM (
SELECT p_brand, round(avg(CASE WHEN p_brand NOT LIKE '%3' THEN p_retailprice END), 1) AS mean FROM part GROUP BY 1)""")
def rank_results(t):
    price = F.when(~c("p_brand").endswith("3"), c("p_retailprice"))
    scores = t.part.groupBy("p_brand").agg(F.round(F.avg(price), 1).alias("mean"))
    return ordered.rank_results(scores, "mean", "place")


# missing values

_GAPS = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 10 < 6 THEN NULL ELSE c_nationkey END AS nation FROM customer"""


def gappy_customers(t):
    k = c("c_custkey")
    return t.customer.select("c_custkey", F.when(k % 7 != 0, c("c_acctbal")).alias("bal"),
                             F.when(k % 3 != 0, c("c_mktsegment")).alias("seg"),
                             F.when(k % 10 >= 6, c("c_nationkey")).alias("nation"))


@query(f"SELECT c_custkey, bal IS NULL AS bal_missing, seg IS NOT NULL AS seg_present FROM ({_GAPS})")
def null_mask(t):
    return gappy_customers(t).select("c_custkey", c("bal").isNull().alias("bal_missing"),
                                     c("seg").isNotNull().alias("seg_present"))


@query(f"SELECT * FROM ({_GAPS}) WHERE bal IS NOT NULL AND seg IS NOT NULL AND nation IS NOT NULL")
def drop_null_rows(t):
    return gappy_customers(t).dropna("any")


@query(f"SELECT c_custkey, bal, seg FROM ({_GAPS})")
def drop_null_columns(t):
    rows = gappy_customers(t)
    return missing.drop_null_columns(rows, thresh=rows.count() // 2)


@query(f"SELECT c_custkey, coalesce(bal, 0) AS bal, coalesce(seg, 'NONE') AS seg, coalesce(nation, -1) AS nation FROM ({_GAPS})")
def fill_constant(t):
    return gappy_customers(t).fillna({"bal": 0.0, "seg": "NONE", "nation": -1})


def _rate(of, frame):
    return f"""SELECT '{of}' AS "column", count(*) - count({of}) AS missing, round_even(100.0 * (count(*) - count({of})) / count(*), 0)::DOUBLE AS percent FROM ({frame})"""


@query(" UNION ALL ".join(_rate(x, _GAPS) for x in ("bal", "seg", "nation")))
def missing_rate(t):
    return missing.missing_rate(gappy_customers(t))


_TRAIN, _TEST = f"SELECT * FROM ({_GAPS}) WHERE bal >= 0 OR bal IS NULL", f"SELECT * FROM ({_GAPS}) WHERE bal < 0"


@query("WITH a AS (" + " UNION ALL ".join(_rate(x, _TRAIN) for x in ("bal", "seg", "nation")) + "), b AS ("
       + " UNION ALL ".join(_rate(x, _TEST) for x in ("bal", "seg", "nation"))
       + """) SELECT "column", a.percent AS train, b.percent AS test FROM (SELECT * FROM a WHERE missing > 0) a FULL JOIN (SELECT * FROM b WHERE missing > 0) b USING ("column")""")
def missing_rate_two(t):
    rows = gappy_customers(t)
    return missing.missing_rate_two(rows.filter("bal >= 0 OR bal IS NULL"), rows.filter("bal < 0"))


@query(f"SELECT c_custkey, bal, seg FROM ({_GAPS})")
def drop_high_missing(t):
    return missing.drop_high_missing(gappy_customers(t), 0.5)


@query("""WITH d AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders),
m AS (SELECT o_custkey, p AS m FROM (SELECT o_custkey, p, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, p) AS r
FROM d WHERE p IS NOT NULL GROUP BY o_custkey, p) WHERE r = 1)
SELECT o_orderkey, o_custkey, coalesce(p, m) AS p FROM d LEFT JOIN m USING (o_custkey)""")
def impute_group_mode(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(c("o_orderkey") % 4 != 0, c("o_orderpriority")).alias("p"))
    return aggregate.fill_group_mode(rows, ["o_custkey"], "p")


@query(f"""WITH g AS ({_GAPS}) SELECT c_custkey, round(coalesce(bal, (SELECT avg(bal) FROM g)), 4) AS bal,
coalesce(seg, (SELECT seg FROM g WHERE seg IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, seg LIMIT 1)) AS seg,
coalesce(nation, (SELECT median(nation) FROM g)) AS nation FROM g""")
def impute_mean_median(t):
    rows = gappy_customers(t).withColumn("nation", c("nation").cast("double"))
    return missing.impute_mean_median(rows, {"bal": "mean", "seg": "mode", "nation": "median"}).withColumn(
        "bal", F.round("bal", 4))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, CASE WHEN (l_orderkey + l_linenumber) % 7 = 1 THEN NULL ELSE l_extendedprice END AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, round(coalesce(p, a + b * l_quantity), 2) AS l_extendedprice FROM d,
(SELECT regr_slope(p, l_quantity) AS b, regr_intercept(p, l_quantity) AS a FROM d)""")
def impute_iterative(t):
    k = c("l_orderkey") + c("l_linenumber")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                              F.when(k % 7 != 1, c("l_extendedprice")).alias("l_extendedprice"))
    out = missing.IterativeImputer(["l_quantity", "l_extendedprice"]).fit(lines).transform(lines)
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 2))


@query("""WITH d AS (SELECT p_partkey, p_partkey / 40.0::DOUBLE AS spot, p_size::DOUBLE AS p_size, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price FROM part),
n AS (SELECT a.p_partkey, b.price, row_number() OVER (PARTITION BY a.p_partkey ORDER BY round(sqrt((a.spot - b.spot) ** 2 + (a.p_size - b.p_size) ** 2), 9), b.p_partkey) AS place
FROM d a JOIN d b ON a.price IS NULL AND b.price IS NOT NULL)
SELECT p_partkey, spot, p_size, round(coalesce(price, (SELECT avg(n.price) FROM n WHERE n.p_partkey = d.p_partkey AND place <= 5)), 4) AS price FROM d""")
def impute_knn(t):
    rows = t.part.select("p_partkey", (c("p_partkey") / F.lit(40.0)).alias("spot"), c("p_size").cast("double").alias("p_size"),
                         F.when(c("p_partkey") % 7 != 0, c("p_retailprice")).alias("price"))
    return missing.impute_knn(rows, "p_partkey", ["spot", "p_size", "price"], 5).withColumn("price", F.round("price", 4))


@query(name="impute_iterative_many")
def impute_iterative_many(t):
    k = c("l_orderkey") + c("l_linenumber")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                              F.when(k % 5 != 0, c("l_quantity")).alias("l_quantity"),
                              F.when(k % 7 != 1, c("l_extendedprice")).alias("l_extendedprice"), "l_discount")
    imputer = missing.IterativeImputer(["l_quantity", "l_extendedprice", "l_discount"])
    return imputer.fit(lines).transform(lines)


@query("""SELECT event_id, event_type, CASE WHEN value < 5 THEN 5 ELSE value END AS at_limit,
CASE WHEN value < 5 THEN 5 * ((event_id % 100) / 100.0) ELSE value END :: DOUBLE AS spread FROM events""")
def censored_fill(t):
    low, limit = c("value") < 5, F.lit(5.0)
    share = (c("event_id") % 100) / F.lit(100.0)
    return t.events.select("event_id", "event_type", missing.censored_fill(c("value"), low, limit).alias("at_limit"),
                           missing.censored_fill(c("value"), low, limit, share).alias("spread"))
