"""Near copies by 64-bit similarity fingerprints, found with sharded BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.bktree import Forest, roots_of
from tablecraft.llm.components import components
from tablecraft.llm.textual import octets
from tablecraft.plans.lineage import materialize

#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
HASHED = 1 << 14
#: Fingerprints in a shard's tree.
SHARD = 16_384


def fingerprint(text: bytes, words: int = 4) -> int:
    """Bit by bit what over half of the shingles' hashes have set; signed, as Spark's long."""
    import xxhash

    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        starts, ends = [0], [len(joined)]
    else:
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        last = np.cumsum(sizes + 1) - 1
        ends = last[words - 1:].tolist()
        starts = (last - sizes)[:len(ends)].tolist()
    total, ones, digest = len(ends), np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for i in range(0, total, HASHED):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i:i + HASHED], ends[i:i + HASHED])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > total))
    return value - (1 << 64) if value >> 63 else value


def fingerprints(text: str, words: int = 4) -> Column:
    """Fingerprint of a text column as a long; a missing or empty text has the fingerprint zero."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, words) for t in batch], dtype="int64")

    return of(octets(text))


def _bands(radius: int) -> list[Column]:
    """Keys of which two fingerprints within the radius share one at least.

    Of radius + 2 blocks of bits, two at least are equal in both; each pair of blocks is a key.
    """
    blocks, low = radius + 2, 0
    pieces = []
    for i in range(blocks):
        wide = 64 // blocks + (i < 64 % blocks)
        pieces.append((F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << wide) - 1).cast("long")), wide))
        low += wide
    return [F.lit(n).cast("long") * (1 << 48) + a * (1 << wide) + b
            for n, ((a, _), (b, wide)) in enumerate(combinations(pieces, 2))]


def linked_prints(prints: DataFrame, radius: int = 4, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within the radius, as stars, not as all pairs.

    Each fingerprint meets only those that share a band key. A key with more than ``shard``
    fingerprints is cut into blocks; each block is a shard with a tree of its own, and the tree is
    sent to the other blocks of that key, so that no task holds more than two blocks. A shard's
    links are joined inside the task: it emits for each fingerprint the smallest one it hangs from.
    """
    keyed = prints.select("fp", F.explode(F.array(*_bands(radius))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    cut = F.ceil(F.col("size") / shard).cast("int")
    cells = (
        keyed.join(sizes, "key").withColumn("cut", cut)
        .withColumn("own", F.pmod(F.xxhash64("fp"), "cut").cast("int"))
        .withColumn("other", F.explode(F.expr("case when cut = 1 then array(0) else sequence(0, cut - 1) end")))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp",
                (F.col("own") <= F.col("other")).alias("tree"), (F.col("own") >= F.col("other")).alias("query")))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_cells(batches, "cell"):
            cell, fp = rows["cell"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
            tree, query = np.flatnonzero(rows["tree"]), np.flatnonzero(rows["query"])
            forest = Forest(cell[tree], fp[tree])
            found = ((query[q], tree[n]) for q, n in forest.search(cell[query], fp[query], radius))
            root = roots_of(len(fp), found)
            moved = np.flatnonzero(root != np.arange(len(fp)))
            yield pd.DataFrame({"a": fp[moved].view(np.int64), "b": fp[root[moved]].view(np.int64)})

    return (cells.repartition("cell").sortWithinPartitions("cell")
            .mapInPandas(search, "a long, b long").where("a <> b").distinct())


def whole_cells(batches: Iterator[pd.DataFrame], key: str, rows: int = 1 << 16) -> Iterator[pd.DataFrame]:
    """Regroup the sorted rows of a partition into frames that end where a key's rows end."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += len(batch)
        if count < rows:
            continue
        frame = pd.concat(held, ignore_index=True)
        keys = frame[key].to_numpy()
        end = int(np.searchsorted(keys, keys[-1]))
        if end:
            yield frame.iloc[:end]
        held, count = [frame.iloc[end:].reset_index(drop=True)], len(frame) - end
    if count:
        yield pd.concat(held, ignore_index=True)


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id, copy (false for the one row that stays), row_hash.

    Texts whose fingerprints differ in at most ``radius`` bits are linked; a component is what
    links reach, and component_id the smallest key in it (missing keys do not count; null if all
    are missing). A text without words, or a missing one, has the fingerprint zero and is linked
    like any other. Repeated rows each get their row; the row that stays has the component's
    smallest key, ties going to the smallest row_hash, a hash of the whole row; of rows that agree in
    all columns all have copy = false, and the caller keeps one. Other columns do not matter.
    """
    narrow = materialize(docs.select(
        F.col(key).alias("id"), F.xxhash64(*[F.col(c) for c in docs.columns]).alias("row_hash"),
        fingerprints(text, words).alias("fp")))
    first = F.min(F.struct(F.col("id").isNull().alias("gone"), "id", "row_hash")).alias("first")
    prints = narrow.groupBy("fp").agg(first)
    roots = components(linked_prints(prints.select("fp"), radius))
    merged = prints.join(roots, prints.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    best = merged.groupBy("root").agg(F.min("first").alias("best"))
    named = merged.join(best, "root").select("fp", "best")
    kept = (F.col("id").eqNullSafe(F.col("best.id"))) & (F.col("row_hash") == F.col("best.row_hash"))
    return narrow.join(named, "fp").select(
        F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("best.id").alias("component_id"), (~kept).alias("copy"), "row_hash")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """The documents without near copies: one row of each component stays, whole and with all its columns.

    Rows that agree in all columns count as one row. An empty table stays empty.
    """
    stay = near_copies(docs, key, text, words, radius).where("not copy").select(
        F.col(key).alias("kept_id"), F.col("row_hash").alias("kept_hash")).distinct()
    hashed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                         F.xxhash64(*[F.col(c) for c in docs.columns]).alias("hash"), F.col(key).alias("id"))
    found = hashed.join(stay, (F.col("hash") == F.col("kept_hash")) & F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    return found.groupBy("hash", "id").agg(F.first("row").alias("row")).select("row.*")
