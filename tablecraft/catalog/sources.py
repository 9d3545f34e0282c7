"""Sources, sinks and built tables."""

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.plans.lineage import materialize, remove_folder, scratch_folder
from tablecraft.sources import tables as src


def _scratch(t):
    return scratch_folder(t.spark, "csv")


def _kept(t, rows, path):
    """The rows as read back, without the files they were read from."""
    rows = materialize(rows)
    remove_folder(t.spark, path)
    return rows


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_totalprice > 1000""")
def scan_csv(t):
    path = _scratch(t)
    src.sink_csv(t.orders, path)
    return _kept(t, src.scan_csv(t.spark, path, t.orders.schema).filter("o_totalprice > 1000"), path)


@query("SELECT doc_id, lang, source, text, n_chars FROM documents")
def sink_csv(t):
    path = _scratch(t)
    src.sink_csv(t.documents, path)
    return _kept(t, src.scan_csv(t.spark, path, t.documents.schema, multiline=True), path)


@query("SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'")
def scan_parquet(t):
    return (t.lineitem.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
            .select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"))


@query("""WITH a AS (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
b AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS o_custkey, round(a.v, 2) AS urgent_total, b.v AS finished
FROM a FULL JOIN b ON a.k = b.k""")
def from_columns(t):
    urgent = (t.orders.filter("o_orderpriority = '1-URGENT'").groupBy("o_custkey")
              .agg(F.round(F.sum("o_totalprice"), 2).alias("v")))
    finished = t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("v"))
    return src.from_columns({"urgent_total": urgent, "finished": finished}, "o_custkey")


@query("""SELECT p_brand, p_size, o_orderpriority FROM (SELECT DISTINCT p_brand FROM part),
(SELECT DISTINCT p_size FROM part), (SELECT DISTINCT o_orderpriority FROM orders)""")
def from_product(t):
    return src.from_product([t.part.select("p_brand"), t.part.select("p_size"),
                             t.orders.select("o_orderpriority")])


@query("""SELECT n, 2.0 * n / 5 AS x FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) FROM orders), 5)) AS n)""")
def number_sequence(t):
    top = t.orders.agg(F.max("o_orderkey")).first()[0]
    steps = src.number_sequence(t.spark, 0, top, 5)
    count = (top + 4) // 5
    spaced = src.even_spaced(t.spark, 0.0, 2.0 * (count - 1), count)
    return (steps.withColumn("at", F.expr("n div 5"))
            .join(spaced.withColumn("at", F.expr("cast(x / 2 as bigint)")), "at").select("n", "x"))


def _draws(seed):
    return f"""SELECT o_orderkey, (third * third + second) % 2147483647 AS draw FROM (SELECT *, (second * 48271 + first) % 2147483647 AS third FROM (
SELECT *, (first * first + {seed}) % 2147483647 AS second FROM (SELECT o_orderkey, (o_orderkey % 2147483647 * 48271 + {seed}) % 2147483647 AS first FROM orders)))"""


@query("SELECT o_orderkey, round(a.draw / 2147483647.0::DOUBLE, 9) AS uniform, round(sqrt(-2 * ln(1 - b.draw / 2147483647.0::DOUBLE)) "
       "* cos(2 * pi() * (d.draw / 2147483647.0::DOUBLE)), 6) AS normal, floor(e.draw / 2147483647.0::DOUBLE * 10)::BIGINT AS integer FROM "
       + " JOIN ".join(f"({_draws(42 + i)}) {name}" + (" USING (o_orderkey)" if i else "") for i, name in enumerate("abde")))
def random_columns(t):
    out = src.random_columns(t.orders.select("o_orderkey"), "o_orderkey", seed=42)
    return out.withColumns({"uniform": F.round("uniform", 9), "normal": F.round("normal", 6)})


@query("SELECT c_custkey, 5 AS five, 3.14 :: DOUBLE AS pi, 'none' AS tag FROM customer")
def scalar_fill(t):
    return t.customer.select("c_custkey", F.lit(5).alias("five"), F.lit(3.14).alias("pi"), F.lit("none").alias("tag"))
