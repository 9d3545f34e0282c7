"""Hop distances in graphs given as member lists (who shares a list is connected).

Lists are kept as (member, list) rows. A hop goes member -> list -> member, so the
pairs inside a list are never written down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.groups import SIZE, join_back
from tablecraft.plans.lineage import materialize
from tablecraft.plans.ordering import row_index

#: Members of a list, or lists of a node, that are met at a time.
BLOCK = 10_000


def comembership(df: DataFrame, member: str, group: str) -> DataFrame:
    """Distinct (node, list_id) rows of lists with two members or more, and the list size."""
    rows = materialize(df.select(F.col(member).alias("node"), F.col(group).alias("list_id")).dropna().distinct())
    sizes = rows.groupBy("list_id").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sized = materialize(sizes.withColumn(SIZE, F.col("members")))
    return join_back(rows, sized, ["list_id"], how="inner").select("node", "list_id", "members")


def edges_as_lists(edges: DataFrame) -> DataFrame:
    """Undirected edges (src, dst) as lists of two."""
    name = F.concat_ws("|", F.least("src", "dst").cast("string"), F.greatest("src", "dst").cast("string"))
    pairs = edges.filter("src <> dst").select("src", "dst", name.alias("list_id"))
    return pairs.select(F.explode(F.array("src", "dst")).alias("node"), "list_id").distinct()


def _dealt(rows: DataFrame, key: str, other: str) -> DataFrame:
    """The rows with ``blocks`` of their key and their own ``block``, so that no block of a key has much more than ``BLOCK`` rows."""
    sizes = materialize(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    return materialize(join_back(rows, sizes, [key], how="inner").withColumn("block", F.pmod(F.xxhash64(other), "blocks").cast("int")))


def _spread(marks: DataFrame, dealt: DataFrame, key: str, other: str) -> DataFrame:
    """Marks (key, word, bits) handed on to whatever shares a row with the key: (other, word, bits), combined before they are shuffled."""
    blocks = dealt.select(key, "blocks").distinct()
    asked = marks.join(blocks, key).select(key, "word", "bits", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    return asked.join(dealt.select(key, "block", other), [key, "block"]).groupBy(other, "word").agg(F.bit_or("bits").alias("bits"))


def _unseen(found: DataFrame, seen: list[DataFrame], key: str) -> DataFrame:
    """The bits of ``found`` that no earlier step had; earlier steps are read, not written again."""
    rows = found.select(key, "word", "bits", F.lit(0).cast("long").alias("old"))
    for step in seen:
        rows = rows.unionAll(step.select(key, "word", F.lit(0).cast("long").alias("bits"), F.col("bits").alias("old")))
    new = rows.groupBy(key, "word").agg(F.bit_or("bits").alias("bits"), F.bit_or("old").alias("old"))
    return materialize(new.select(key, "word", F.col("bits").bitwiseAND(F.bitwise_not("old")).alias("bits")).where("bits <> 0"))


def hops(lists: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """(src, dst, hops, previous) for every node a source can reach.

    Breadth first from all sources at once: a node or list carries one bit for each source, 64 to a row, and a step hands bits on and
    combines them; a bit enters a node or list once, at its smallest distance. Long lists, and nodes in many lists, are met in blocks.
    ``previous`` is the smallest neighbour one hop closer, found at the end. Without ``sources`` every node is one,
    and the result has a row per connected pair; name the sources for large graphs.
    """
    lists = materialize(lists.select("node", "list_id").dropna().distinct())
    by_node, by_list = _dealt(lists, "node", "list_id"), _dealt(lists, "list_id", "node")
    start = (lists.select("node") if sources is None else sources.toDF("node")).distinct()
    named = materialize(row_index(start, ["node"], "at").select(
        "node", F.floor(F.col("at") / 64).alias("word"), F.pmod("at", F.lit(64)).cast("int").alias("bit")))
    front = materialize(named.groupBy("node", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    reached, opened = [front], []
    while front.limit(1).count():
        opened.append(_unseen(_spread(front, by_node, "node", "list_id"), opened, "list_id"))
        front = _unseen(_spread(opened[-1], by_list, "list_id", "node"), reached, "node")
        reached.append(front)
    return _with_previous(_pairs(reached, named, "node").withColumnRenamed("node", "dst"), _pairs(opened, named, "list_id"), lists)


def _pairs(steps: list[DataFrame], named: DataFrame, key: str) -> DataFrame:
    """(src, key, hops): the bits of all steps one by one."""
    rows = None
    for n, step in enumerate(steps):
        part = step.withColumn("hops", F.lit(n))
        rows = part if rows is None else rows.unionAll(part)
    bit = F.explode(F.expr("filter(sequence(0, 63), b -> (shiftrightunsigned(bits, b) & 1) = 1)")).alias("bit")
    return rows.select(key, "word", "hops", bit).join(named.withColumnRenamed("node", "src"), ["word", "bit"]).select("src", key, "hops")


def _with_previous(reached: DataFrame, opened: DataFrame, lists: DataFrame) -> DataFrame:
    """A list is opened at the distance of its nearest members, the smallest of which is what comes before its farther members."""
    reached, opened = materialize(reached), materialize(opened)
    member = lists.withColumnRenamed("node", "dst")
    nearest = reached.join(member, "dst").join(opened, ["src", "list_id", "hops"]).groupBy("src", "list_id", "hops").agg(F.min("dst").alias("previous"))
    before = nearest.join(member, "list_id").groupBy("src", "dst", (F.col("hops") + 1).alias("hops")).agg(F.min("previous").alias("previous"))
    return reached.join(before, ["src", "dst", "hops"], "left").select("src", "dst", "hops", "previous")
