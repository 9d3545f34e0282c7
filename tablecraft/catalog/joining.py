"""Joins, alignment and set operations."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.operators import joins as op
from tablecraft.operators import setops
from tablecraft.sources.tables import from_product

c = F.col


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice")


def _customers(t):
    return t.customer.select(c("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")


@query("""SELECT o_custkey, o_orderkey, o_totalprice, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(t):
    return _orders(t).join(_customers(t), "o_custkey")


@query("SELECT * FROM documents JOIN labels USING (doc_id)")
def join_natural(t):
    return op.join_natural(t.documents, t.labels)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_name, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 10""")
def join_renamed_keys(t):
    return (t.lineitem.join(t.part.filter("p_size < 10"), c("l_partkey") == c("p_partkey")).drop("p_partkey")
            .select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "l_quantity"))


_BIG = "(SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000)"
_POOR = "(SELECT c_custkey AS o_custkey, c_acctbal FROM customer WHERE c_acctbal < 2000)"


def _sides(t):
    return (_orders(t).filter("o_totalprice > 300000"),
            t.customer.filter("c_acctbal < 2000").select(c("c_custkey").alias("o_custkey"), "c_acctbal"))


for _how, _word in (("outer", "FULL"), ("left", "LEFT"), ("right", "RIGHT")):
    def _join(t, how=_how):
        a, b = _sides(t)
        return a.join(b, "o_custkey", how)

    query(f"SELECT * FROM {_BIG} {_word} JOIN {_POOR} USING (o_custkey)", name=f"join_{_how}")(_join)


@query("""SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id)""")
def join_on_index(t):
    return t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("""SELECT a.c_custkey, a.c_acctbal AS c_acctbal_left, a.c_nationkey AS c_nationkey_left,
b.c_acctbal AS c_acctbal_right, b.c_nationkey AS c_nationkey_right
FROM customer a JOIN (SELECT o_custkey AS c_custkey, max(o_totalprice) AS c_acctbal, 7 AS c_nationkey FROM orders GROUP BY 1) b USING (c_custkey)""")
def join_suffixes(t):
    spent = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return op.join_suffixes(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"),
                            spent.withColumn("c_nationkey", F.lit(7)), ["c_custkey"], suffixes=("_left", "_right"))


@query("""WITH a AS (SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer),
b AS (SELECT CASE WHEN n_nationkey = 0 THEN NULL ELSE n_nationkey END AS k, n_name FROM nation)
SELECT a.k, c_custkey, n_name FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def join_null_safe(t):
    a = t.customer.select("c_custkey", F.when(c("c_nationkey") % 5 != 0, c("c_nationkey")).alias("k"))
    b = t.nation.select(F.when(c("n_nationkey") != 0, c("n_nationkey")).alias("k"), "n_name")
    return op.join_null_safe(a, b, ["k"])


@query("""SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.n_chars, b.quality, b.toxic
FROM (SELECT doc_id, n_chars FROM documents WHERE lang <> 'en') a FULL JOIN labels b ON a.doc_id = b.doc_id""")
def concat_columns(t):
    return (t.documents.filter("lang <> 'en'").select("doc_id", "n_chars")
            .join(t.labels, "doc_id", "full_outer"))


def _by_year(t, year):
    first, last = f"{year}-01-01", f"{year + 1}-01-01"
    return (t.orders.filter((c("o_orderdate") >= first) & (c("o_orderdate") < last))
            .groupBy("o_custkey", "o_orderpriority").agg(F.sum("o_totalprice").alias("v")))


_YEARS = """WITH a AS (SELECT o_custkey, o_orderpriority, sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1, 2),
b AS (SELECT o_custkey, o_orderpriority, sum(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1, 2) """
_ON = "a FULL JOIN b USING (o_custkey, o_orderpriority)"


@query(_YEARS + f"SELECT o_custkey, o_orderpriority, round(a.v / b.v, 4) AS ratio FROM {_ON}")
def align_binary(t):
    return op.align_binary(_by_year(t, 1997), _by_year(t, 1998), ["o_custkey", "o_orderpriority"], "v", "v",
                           lambda x, y: F.round(F.try_divide(x, y), 4), "ratio")


@query(_YEARS + f"""SELECT o_custkey, o_orderpriority, round(coalesce(a.v, m) + coalesce(b.v, m), 2) AS total
FROM {_ON}, (SELECT avg(v) AS m FROM a)""")
def align_fill(t):
    a = _by_year(t, 1997)
    return op.align_binary(a, _by_year(t, 1998), ["o_custkey", "o_orderpriority"], "v", "v",
                           lambda x, y: F.round(x + y, 2), "total", fill=a.agg(F.avg("v")).scalar())


@query("""SELECT p_partkey, p_size - (SELECT p_size FROM part WHERE p_partkey = 0) AS p_size,
round(p_retailprice - (SELECT p_retailprice FROM part WHERE p_partkey = 0), 2) AS p_retailprice FROM part""")
def subtract_row(t):
    parts = t.part.select("p_partkey", "p_size", "p_retailprice")
    first = parts.orderBy("p_partkey").limit(1)
    return op.subtract_row(parts, first, ["p_size", "p_retailprice"]).withColumn(
        "p_retailprice", F.round("p_retailprice", 2))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_discount - l_tax AS l_discount, l_quantity - l_tax AS l_quantity FROM lineitem""")
def subtract_column(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey",
                             *[(c(x) - c("l_tax")).alias(x) for x in ("l_discount", "l_quantity")])


@query("""SELECT doc_id, source, (SELECT count(*) FROM documents b JOIN labels USING (doc_id) WHERE b.source = a.source) AS matches
FROM documents a WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def pair_equality(t):
    known = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left_semi")
    rest = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left_anti")
    return op.pair_equality(rest, known, "source")


@query("""SELECT l_discount, l_tax, round(sqrt(1 + l_discount) * ln(2 + l_tax) - l_discount * l_tax, 8) AS z
FROM (SELECT DISTINCT l_discount FROM lineitem), (SELECT DISTINCT l_tax FROM lineitem)""")
def outer_grid(t):
    x, y = c("l_discount"), c("l_tax")
    grid = from_product([t.lineitem.select("l_discount"), t.lineitem.select("l_tax")])
    return grid.withColumn("z", F.round(F.sqrt(1 + x) * F.log(2 + y) - x * y, 8))


# set operations

@query("SELECT s_suppkey AS key, s_acctbal AS bal FROM supplier UNION ALL SELECT c_custkey, c_acctbal FROM customer")
def union_all(t):
    return (t.supplier.select(c("s_suppkey").alias("key"), c("s_acctbal").alias("bal"))
            .unionByName(t.customer.select(c("c_acctbal").alias("bal"), c("c_custkey").alias("key"))))


def _two(t):
    a = t.supplier.select(c("s_suppkey").alias("key"), c("s_acctbal").alias("bal"), "s_name")
    b = t.customer.select(c("c_custkey").alias("key"), c("c_acctbal").alias("bal"), "c_mktsegment")
    return a, b


@query("""SELECT s_suppkey AS key, s_acctbal AS bal, s_name, NULL AS c_mktsegment FROM supplier
UNION ALL SELECT c_custkey, c_acctbal, NULL, c_mktsegment FROM customer""")
def union_outer_columns(t):
    a, b = _two(t)
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT s_suppkey AS key, s_acctbal AS bal FROM supplier UNION ALL SELECT c_custkey, c_acctbal FROM customer")
def union_common_columns(t):
    return setops.union_common_columns(*_two(t))


@query("SELECT s_suppkey AS key, s_acctbal AS bal, s_name FROM supplier UNION ALL SELECT c_custkey, c_acctbal, NULL FROM customer")
def union_left_columns(t):
    return setops.union_left_columns(*_two(t))


@query("SELECT 'document' AS src, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark")
def union_tagged(t):
    return setops.union_tagged({"document": t.documents.select(c("doc_id").alias("id"), "text"),
                                "benchmark": t.benchmark.select(c("item_id").alias("id"), "text")})


@query("""SELECT key, bal, row_number() OVER (ORDER BY src, key) - 1 AS row_index FROM (
SELECT 0 AS src, s_suppkey AS key, s_acctbal AS bal FROM supplier UNION ALL SELECT 1, c_custkey, c_acctbal FROM customer)""")
def union_reindexed(t):
    a, b = (x.select("key", "bal") for x in _two(t))
    return setops.union_reindexed([a, b], ["key"])


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def assert_unique_keys(t):
    return setops.assert_unique_keys(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


def _key_sets(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    low = t.orders.filter("o_orderpriority = '5-LOW'").select("o_custkey")
    return urgent, low


_URGENT = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
_LOW = "SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'"


@query(f"{_URGENT} INTERSECT {_LOW}")
def keys_intersect(t):
    a, b = _key_sets(t)
    return a.intersect(b)


@query(f"{_URGENT} UNION {_LOW}")
def keys_union(t):
    a, b = _key_sets(t)
    return a.union(b).distinct()


@query(f"({_URGENT} EXCEPT {_LOW}) UNION ALL ({_LOW} EXCEPT {_URGENT})")
def keys_symdiff(t):
    return setops.keys_symdiff(*_key_sets(t))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def distinct_values(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("""SELECT lang, source, text FROM (SELECT lang, source, text, row_number() OVER (PARTITION BY lang, source, text) AS r FROM documents) WHERE r > 1
UNION ALL SELECT l_returnflag, l_linestatus, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) FROM (
SELECT l_returnflag, l_linestatus, l_quantity, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity) AS r FROM lineitem) WHERE r > 1""")
def duplicate_rows(t):
    texts = setops.duplicate_rows(t.documents.select("lang", "source", "text"))
    lines = setops.duplicate_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity"))
    return texts.union(lines.select("l_returnflag", "l_linestatus", c("l_quantity").cast("int").cast("string")))
