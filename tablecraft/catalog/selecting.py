"""Projection, filters, positions and ordering."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.operators import select as op
from tablecraft.plans.ordering import row_index as number_rows


@query("SELECT o_orderkey, o_totalprice FROM orders")
def project(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def drop_columns(t):
    return t.customer.drop("c_name", "c_acctbal")


@query("SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def drop_rows_by_key(t):
    building = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return op.drop_rows_by_key(t.orders, building, "o_custkey")


@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def select_by_dtype(t):
    return op.select_by_dtype(t.part, "numeric")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice * (1 - l_discount) AS net,
l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""")
def derive_column(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (t.lineitem.withColumns({"net": net, "gross": net * (1 + F.col("l_tax"))})
            .select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "net", "gross"))


@query("SELECT c_custkey, CASE WHEN (CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END) > 0 THEN 1 ELSE 0 END AS has_balance FROM customer")
def flag_positive(t):
    balance = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
    return t.customer.select("c_custkey", op.flag_positive(balance).alias("has_balance"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size FROM part")
def cast_to_category(t):
    return t.part.select("p_partkey", F.col("p_size").cast("string").alias("p_size"))


@query("""SELECT * FROM lineitem WHERE (l_discount >= 0.05 AND l_discount <= 0.07 AND l_quantity < 24)
OR NOT (l_returnflag = 'N' OR l_tax > 0.0)""")
def mask_filter(t):
    c = F.col
    cheap = (c("l_discount") >= 0.05) & (c("l_discount") <= 0.07) & (c("l_quantity") < 24)
    return t.lineitem.filter(cheap | ~((c("l_returnflag") == "N") | (c("l_tax") > 0.0)))


@query("""SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def isin_lookup(t):
    debtors = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return op.isin_lookup(t.orders, debtors, "o_custkey")


@query("SELECT p_brand, p_partkey FROM part WHERE p_brand BETWEEN 'Brand#12' AND 'Brand#3'")
def label_range(t):
    return t.part.filter(F.col("p_brand").between("Brand#12", "Brand#3")).select("p_brand", "p_partkey")


@query("""SELECT o_orderkey, o_totalprice, CAST(row_index AS BIGINT) AS row_index FROM (
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey DESC) - 1 AS row_index FROM orders)
WHERE row_index >= 2 AND row_index < (SELECT count(*) // 2 FROM orders) AND (row_index - 2) % 3 = 0""")
def position_range(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return op.position_range(orders, ["o_totalprice", "o_orderkey"], 2, orders.count() // 2, 3, reverse=True)


@query("""SELECT n_regionkey, n_name, p_year, round(sum(o_totalprice), 2) AS total FROM (
SELECT n_regionkey, n_name, year(o_orderdate) AS p_year, o_totalprice FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
WHERE n_regionkey IN (1, 3) AND p_year = 1997 GROUP BY ALL""")
def level_slice(t):
    keyed = (t.orders.filter((F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderdate") < "1998-01-01"))
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(t.nation.filter("n_regionkey IN (1, 3)"), F.col("c_nationkey") == F.col("n_nationkey"))
             .withColumn("p_year", F.year("o_orderdate").cast("long")))
    return keyed.groupBy("n_regionkey", "n_name", "p_year").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT * FROM part ORDER BY p_partkey LIMIT 5")
def head_rows(t):
    return t.part.orderBy("p_partkey").limit(5)


@query("SELECT * FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort_rows(t):
    return t.customer.orderBy(F.asc_nulls_last("c_mktsegment"), F.desc_nulls_last("c_acctbal"), "c_custkey")


@query("""SELECT s_suppkey, position, row_number() OVER (ORDER BY s_acctbal, position) - 1 AS rank
FROM (SELECT *, row_number() OVER (ORDER BY s_suppkey) - 1 AS position FROM supplier)""")
def argsort_rows(t):
    return op.argsort_rows(t.supplier, ["s_suppkey"], ["s_acctbal"]).select("s_suppkey", "position", "rank")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("""WITH s AS (SELECT l_returnflag AS f, CAST(count(*) AS DOUBLE) AS n, sum(l_quantity) AS q, max(l_extendedprice) AS top FROM lineitem GROUP BY 1)
SELECT 'n' AS key, sum(n) FILTER (f = 'A') AS "A", sum(n) FILTER (f = 'N') AS "N", sum(n) FILTER (f = 'R') AS "R" FROM s
UNION ALL SELECT 'q', sum(q) FILTER (f = 'A'), sum(q) FILTER (f = 'N'), sum(q) FILTER (f = 'R') FROM s
UNION ALL SELECT 'top', sum(top) FILTER (f = 'A'), sum(top) FILTER (f = 'N'), sum(top) FILTER (f = 'R') FROM s""")
def transpose_small(t):
    stats = t.lineitem.groupBy("l_returnflag").agg(
        F.count("*").cast("double").alias("n"), F.sum("l_quantity").alias("q"), F.max("l_extendedprice").alias("top"))
    return op.transpose_small(stats, "l_returnflag")


@query("SELECT r_regionkey AS id, r_name AS name FROM region")
def rename_columns(t):
    return t.region.withColumnsRenamed({"r_regionkey": "id", "r_name": "name"})


@query("""SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def row_index(t):
    return number_rows(t.events.select("event_id", "user_id", "ts"), ["ts", "event_id"]).drop("ts")
