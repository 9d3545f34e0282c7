"""Positions and running values in a given order, without a one-task window.

Rows are range-partitioned by (keys, order) so that even one huge group spreads
over many tasks, numbered inside their partition, and written once to the
checkpoint folder. Partition totals (one row per partition) carry the state over
partition borders. The order columns must identify a row, otherwise ties are
numbered arbitrarily (but once, since the numbering is written down).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.plans.lineage import materialize

PART, POS = "_part", "_row_in_part"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def ranged(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows in global order over partitions, with partition number and position in it."""
    number = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_number", number)
    return materialize(rows.select(
        *df.columns,
        F.shiftright("_number", _ROW_BITS).alias(PART),
        F.col("_number").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(POS)))


def _offsets(rows: DataFrame) -> DataFrame:
    """First global position of each partition; as many rows as there are partitions."""
    sizes = sorted(rows.groupBy(PART).count().collect())
    start, out = 0, []
    for part, size in sizes:
        out.append((part, start))
        start += size
    return rows.sparkSession.createDataFrame(out, f"{PART} long, _start long")


def row_index(df: DataFrame, order: list[Column | str], name: str = "row_index") -> DataFrame:
    """Add the position 0..n-1 of each row in the given order."""
    rows = ranged(df, order)
    return (rows.join(F.broadcast(_offsets(rows)), PART)
            .select(*df.columns, (F.col("_start") + F.col(POS)).alias(name)))


def _local(kind: str, value: Column, window) -> Column:
    if kind == "count":
        return F.row_number().over(window).cast("long")
    if kind == "last":
        return F.last(value, ignorenulls=True).over(window)
    return F.when(value.isNotNull(), {"sum": F.sum, "product": F.product}[kind](value).over(window))


def _total(kind: str, value: Column) -> Column:
    if kind == "count":
        return F.count(F.lit(1))
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), F.col(POS)))
    return {"sum": F.sum, "product": F.product}[kind](value)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carry)
    if kind == "product":
        return F.coalesce(carry * local, local)
    return F.coalesce(carry + local, local)


def running(df: DataFrame, keys: list[str], order: list[Column | str],
            outputs: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Running values per group. ``outputs``: name -> (sum|product|count|last, column).

    A sum or product skips missing values and is missing beside them; the last value is the last known.
    Every group is cut at partition borders and the totals are carried over them, so its size does not matter.
    """
    values = {n: (k, F.col(c) if c else F.lit(1)) for n, (k, c) in outputs.items()}
    rows = ranged(df, [*keys, *order])
    window = Window.partitionBy(*keys, PART).orderBy(POS)
    frame = window.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[_local(k, v, window if k == "count" else frame).alias(n)
                               for n, (k, v) in values.items()])

    # one row per (group, partition); a group has at most as many as there are partitions
    totals = rows.groupBy(*keys, PART).agg(*[_total(k, v).alias(n) for n, (k, v) in values.items()])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = {n: (F.last(n, ignorenulls=True) if k == "last" else
                   F.product(n) if k == "product" else F.sum(n)).over(before)
               for n, (k, _) in values.items()}
    carry = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col(PART).alias("_key_part"),
        F.count(F.lit(1)).over(before).alias("_earlier"),
        *[c.alias(f"_carry_{n}") for n, c in carried.items()],
    ).filter("_earlier > 0")  # only the first group of a partition: never more rows than partitions
    match = local[PART] == carry["_key_part"]
    for k in keys:
        match = match & local[k].eqNullSafe(carry[f"_key_{k}"])
    return (local.join(F.broadcast(carry), match, "left")
            .select(*df.columns, *[_combine(k, F.col(f"_carry_{n}"), F.col(n)).alias(n)
                                   for n, (k, _) in values.items()]))


def group_position(df: DataFrame, keys: list[str], order: list[Column | str],
                   name: str = "position") -> DataFrame:
    """Add the 1-based position of each row inside its group."""
    return running(df, keys, order, {name: ("count", None)})
