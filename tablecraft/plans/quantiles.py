"""Exact, linearly interpolated percentiles that never hold a large group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.groups import join_back
from tablecraft.plans.lineage import materialize
from tablecraft.plans.ordering import running

#: Rows of a group that one task may hold; larger groups are narrowed down first.
LARGE = 200_000
#: A sketch's ranks are off by one part in this many of a group at most.
ACCURACY = 10_000


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """One row per group with the named percentiles (0..1) of ``value``.

    A group of at most ``LARGE`` rows is aggregated directly. In a larger one, a mergeable sketch brackets
    each wanted position, the rows below the bracket are counted, and those inside are all that is left to look at.
    What is known of large groups goes to the rows by broadcast, as there are at most one per ``LARGE`` rows: no row is
    shuffled before it is counted.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    grouped = keys or ["_all"]
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
    sizes = rows.groupBy(*grouped).agg(F.count(F.lit(1)).alias("_size"))
    least, most = sizes.agg(F.min("_size"), F.max("_size")).first()
    if (most or 0) <= LARGE:
        return _direct(rows, grouped, shares).select(*keys, *shares)
    large = materialize(sizes.where(F.col("_size") > LARGE))
    beside = join_back(rows, F.broadcast(large), grouped)
    found = _narrowed(beside.where("_size is not null"), large, grouped, shares)
    if least <= LARGE:
        found = found.unionByName(_direct(beside.where("_size is null"), grouped, shares))
    return found.select(*keys, *shares)


def _direct(rows: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    wanted = F.percentile("_v", F.array(*[F.lit(float(q)) for q in shares.values()]))
    found = rows.groupBy(*keys).agg(wanted.alias("_p"))
    return found.select(*keys, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(shares)])


def _narrowed(rows: DataFrame, large: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """(keys, shares) for the rows (keys, _size, _v) of large groups: the few values inside the brackets are counted in order across partitions."""
    reach = 2 / ACCURACY
    ends = [(q - reach if q > reach else None, q + reach if q < 1 - reach else None) for q in shares.values()]
    asked = sorted({at for pair in ends for at in pair if at is not None})
    sketch = F.percentile_approx("_v", F.array(*[F.lit(at) for at in asked]), ACCURACY) if asked else F.lit(None)
    brackets = materialize(rows.groupBy(*keys).agg(sketch.alias("_ends")))
    beside = join_back(rows, F.broadcast(brackets), keys)

    def end(at: float | None) -> Column:
        return F.get("_ends", F.lit(asked.index(at)))

    below = [F.lit(False) if low is None else F.col("_v") < end(low) for low, _ in ends]
    inside = [~under & (F.lit(True) if high is None else F.col("_v") <= end(high)) for under, (_, high) in zip(below, ends)]
    places = F.array(*[F.when(fits, F.lit(i)) for i, fits in enumerate(inside)])
    kept = beside.where(reduce(lambda a, b: a | b, inside)).select(*keys, "_v", F.explode(F.array_compact(places)).alias("_share"))
    counts = kept.groupBy(*keys, "_share", "_v").agg(F.count(F.lit(1)).alias("_n"))
    under = materialize(join_back(beside.groupBy(*keys).agg(F.array(*[F.count_if(b) for b in below]).alias("_below")), F.broadcast(large), keys))
    seen = join_back(running(counts, [*keys, "_share"], ["_v"], {"_seen": ("sum", "_n")}), F.broadcast(under), keys)
    seen = seen.withColumn("_seen", F.col("_seen") + F.get("_below", "_share"))
    spot = (F.col("_size") - 1) * F.get(F.array(*[F.lit(float(q)) for q in shares.values()]), "_share")
    picks = seen.groupBy(*keys, "_share", "_size").agg(*[
        F.min(F.when(F.col("_seen") > at, F.col("_v"))).cast("double").alias(n) for n, at in (("_a", F.floor(spot)), ("_b", F.ceil(spot)))])
    share = F.col("_a") + (F.col("_b") - F.col("_a")) * (spot - F.floor(spot))
    return picks.groupBy(*keys).agg(*[F.max(F.when(F.col("_share") == i, share)).alias(n) for i, n in enumerate(shares)])
