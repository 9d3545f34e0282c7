"""Near copies by one-permutation hashing with optimal densification, banded buckets and stars, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.components import components
from tablecraft.llm.simhash import whole_cells
from tablecraft.llm.skew import join_sized
from tablecraft.llm.textual import octets
from tablecraft.plans.lineage import materialize, release, remove_folder, scratch_folder

#: Bins of the one permutation (by the high bits of a hash), and bins in a band.
BIN_BITS, BAND = 7, 4
BINS = 1 << BIN_BITS
#: Two sets meet only if that many of the 128 bins agree. At a similarity of 0.8 that is over five deviations below the mean.
AGREEING = 77
#: Words whose hashes a task remembers.
REMEMBERED = 500_000
#: Documents that are confirmed against one copy of a star's centre.
STAR = 256
#: Members, or rows outside of the centre's class, that one cell of a bucket or family holds.
BLOCK = 1024

_PROBES = np.stack([np.random.default_rng(i).permutation(BINS) for i in range(BINS)])
_BORDERS = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Shingles:
    """Sets of word shingles as sorted distinct 64-bit hashes; a word is hashed once for all texts of a task."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def of(self, text: bytes) -> np.ndarray:
        from xxhash import xxh64_intdigest

        found = text.lower().split()
        if not found:
            return np.empty(0, dtype=np.uint64)
        new = set(found).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, set(found)
            self.known.update((w, xxh64_intdigest(w)) for w in new)
        hashes = np.fromiter(map(self.known.__getitem__, found), dtype=np.uint64, count=len(found))
        size = min(self.words, len(found))
        many = len(found) - size + 1
        shingle = np.full(many, size, dtype=np.uint64)
        for i in range(size):
            shingle = _mixed(shingle * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + many])
        return np.unique(shingle)


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin. An empty bin takes that of the first full one in an order of its own, which is optimal densification."""
    at = np.minimum(np.searchsorted(hashes, _BORDERS), len(hashes) - 1)
    values = hashes[at]
    full = values >> np.uint64(64 - BIN_BITS) == np.arange(BINS, dtype=np.uint64)
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _PROBES[empty]
        values[empty] = values[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return values


def bands_of(bins: np.ndarray) -> np.ndarray:
    """A key for each band of bins."""
    keys = np.arange(BINS // BAND, dtype=np.uint64)
    for column in bins.reshape(-1, BAND).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """True if the sets share at least ``percent`` of 100 of their union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(id, row, text, digest, n, keys, bins): the text compressed, its set as a 128-bit digest, its bands, and a byte of each bin."""
    narrow = docs.select(F.col(key).alias("id"), F.monotonically_increasing_id().alias("row"), octets(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        from zstandard import ZstdCompressor

        shingles, none, compress = Shingles(words), np.empty(0, dtype=np.int64), ZstdCompressor(level=3).compress
        for batch in batches:
            texts, digest, n, keys, bins = [], [], [], [], []
            for value in batch.column(2):
                value = value.as_py()
                found = shingles.of(value)
                texts.append(compress(value))
                least = bins_of(found) if len(found) else None
                digest.append(xxh3_128_digest(found.tobytes()))
                n.append(len(found))
                keys.append(none if least is None else bands_of(least))
                bins.append(b"" if least is None else least.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, "binary"), pa.array(digest, "binary"), pa.array(n, "int64"), pa.array(keys, pa.list_(pa.int64())), pa.array(bins, "binary")],
                ["id", "row", "text", "digest", "n", "keys", "bins"])

    return narrow.mapInArrow(sketch, f"id {kind}, row bigint, text binary, digest binary, n bigint, keys array<bigint>, bins binary")


def _promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, degree) of the pairs whose sizes allow the similarity and whose bins agree often enough; a has ``degree`` pairs before that."""
    facts = sets.select("node", "n", "bins")
    degrees = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    centre = facts.join(degrees, facts.node == degrees.a).select("a", "degree", F.col("n").alias("n_a"), F.col("bins").alias("bins_a"))
    both = join_sized(pairs.join(facts, pairs.b == facts.node).drop("node"), centre, "a", "degree")
    sized = both.where(100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a"))

    @F.pandas_udf("boolean")
    def close(left: pd.Series, right: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(-1, BINS) for s in (left, right))
        return pd.Series((a == b).sum(axis=1) >= AGREEING)

    return sized.where(close("bins_a", "bins")).select("a", "b", "degree")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets; ``degree`` bounds the pairs of an a.

    A star's centre is sent to as many cells as its members need; a task reads a cell's rows one by one, the centre first,
    and holds one set and the row at hand.
    """
    copies = F.ceil(F.col("degree") / STAR).cast("int")
    members = pairs.select("a", "b", F.pmod(F.xxhash64("b"), copies).cast("int").alias("copy"))
    centres = members.select("a", "copy").distinct()
    rows = members.join(texts, members.b == texts.row).select("a", "copy", "b", "text").unionAll(
        centres.join(texts, centres.a == texts.row).select("a", "copy", F.lit(-1).cast("long").alias("b"), "text"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        shingles, centre, cell, whole = Shingles(words), None, None, ZstdDecompressor().decompress
        for batch in batches:
            a, copy, b = (batch.column(i).to_pylist() for i in range(3))
            linked = []
            for i, value in enumerate(batch.column(3)):
                found = shingles.of(whole(value.as_py()))
                if b[i] < 0:
                    centre, cell = found, (a[i], copy[i])
                elif cell == (a[i], copy[i]) and similar(centre, found, percent):
                    linked.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in linked], "int64") for c in (a, b)], ["a", "b"])

    return rows.repartition("a", "copy").sortWithinPartitions("a", "copy", "b").mapInArrow(check, "a bigint, b bigint")


def _cells(shared: DataFrame, sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Buckets that stars have not settled, as cells (cell, node, root, n, bins, outside) of bounded size.

    A bucket is settled if all its members are in one class, or if it holds no more than its centre and one other. In the others a
    link can be missing only where one end at least is outside of the centre's class; these rows visit all blocks of members.
    """
    rooted = shared.join(classes, shared.node == classes.member, "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct("node", "root"))
    # the centre is the smallest node
    buckets = rooted.groupBy("key").agg(F.count("*").alias("size"), first.alias("first"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = materialize(buckets.where("size > 2 and low < high").select("key", "size", F.col("first.root").alias("inner")))
    placed = materialize(join_sized(rooted, open_, "key", "size").withColumn("outside", F.col("root") != F.col("inner")))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own, all_of = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    as_member = placed.select("key", "node", "root", all_of.alias("lane"), own.alias("block"), F.lit(False).alias("outside"))
    as_outside = placed.where("outside").select("key", "node", "root", own.alias("lane"), all_of.alias("block"), F.lit(True).alias("outside"))
    both = as_member.unionAll(as_outside).select(F.xxhash64("key", "lane", "block").alias("cell"), "node", "root", "outside")
    return both.join(sets.select("node", "n", "bins"), "node")


def _families(cells: DataFrame, percent: int) -> DataFrame:
    """(family, member): sets that could be linked to a set of another class, as sizes and bins allow it.

    The candidates of a cell form trees, and a tree's smallest set names its family; so both ends of every candidate are in a family together, and the
    trees of a family in many buckets mostly have one name. A task emits a row for each set in a tree, never the pairs.
    """

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_cells(batches, "cell"):
            cell, found = frame["cell"].to_numpy(), []
            cuts = np.r_[0, np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)]
            nodes, sizes, roots, outside = (frame[c].to_numpy() for c in ("node", "n", "root", "outside"))
            bins = np.frombuffer(b"".join(frame["bins"]), dtype=np.uint8).reshape(-1, BINS)
            for low, high in zip(cuts[:-1], cuts[1:]):
                member = low + np.flatnonzero(~outside[low:high])
                n, table, forest = sizes[member], bins[member], Forest()
                for i in low + np.flatnonzero(outside[low:high]):
                    fits = (100 * np.minimum(n, sizes[i]) >= percent * np.maximum(n, sizes[i])) & (roots[member] != roots[i])
                    near = member[fits][(table[fits] == bins[i]).sum(axis=1) >= AGREEING]
                    for b in nodes[near].tolist():
                        forest.join(int(nodes[i]), b)
                found.extend(forest.members())
            yield pd.DataFrame(found, columns=["family", "member"], dtype="int64")

    return materialize(cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(pick, "family bigint, member bigint").distinct())


class Forest:
    """Classes that grow by joining two members at a time."""

    def __init__(self):
        self.above: dict = {}

    def root(self, node):
        path = []
        while self.above.get(node, node) != node:
            path.append(node)
            node = self.above[node]
        self.above.update(dict.fromkeys(path, node))
        return node

    def join(self, a, b) -> bool:
        """True if the two were in different classes."""
        a, b = sorted((self.root(a), self.root(b)))
        self.above[b] = a
        return a != b

    def members(self) -> list[tuple]:
        """(root, member) of all that were joined; a root is the smallest member."""
        return [(self.root(node), node) for node in {*self.above, *self.above.values()}]


def _settled(families: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between the classes of a family, on full sets.

    A large family is cut into blocks, and each pair of blocks is a cell. A task holds the sets of a cell as one table of shingles; a row outside of the cell's
    largest class is held against all others at once, by adding up its shingles along the table. It emits a forest of the links.
    """
    rows = families.join(classes.withColumnRenamed("root", "known"), "member", "left").withColumn("known", F.coalesce("known", "member"))
    sizes = rows.groupBy("family").agg(F.count("*").alias("size"))
    cut = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("member"), cut).cast("int")
    placed = join_sized(rows, materialize(sizes), "family", "size").select(
        "family", "member", "known", own.alias("own"), F.explode(F.sequence(F.lit(0), cut - 1)).alias("other"))
    cells = placed.select(F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "member", "known")
    held = cells.join(texts, cells.member == texts.row).select("cell", "member", "known", "text")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        whole, shingles, current, members, known, sets = ZstdDecompressor().decompress, Shingles(words), None, [], [], []
        for batch in batches:
            found = []
            for cell, member, root, text in zip(*(batch.column(i) for i in range(3)), batch.column(3)):
                if cell.as_py() != current:
                    found.extend(_linked(members, known, sets, percent))
                    current, members, known, sets = cell.as_py(), [], [], []
                members.append(member.as_py())
                known.append(root.as_py())
                sets.append(shingles.of(whole(text.as_py())))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], "int64") for i in (0, 1)], ["a", "b"])
        found = list(_linked(members, known, sets, percent))
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], "int64") for i in (0, 1)], ["a", "b"])

    return held.repartition("cell").sortWithinPartitions("cell", "member").mapInArrow(settle, "a bigint, b bigint")


def _linked(members: list[int], known: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A forest of the links between classes of some sets."""
    if len(set(known)) < 2:
        return
    sizes, forest = np.array([len(s) for s in sets]), Forest()
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    starts, has = np.r_[0, np.cumsum(sizes)[:-1]], np.zeros(len(values), dtype=np.int32)
    roots, counts = np.unique(known, return_counts=True)
    known = np.array(known)
    for i in np.flatnonzero(known != roots[counts.argmax()]):
        mine = column[starts[i]:starts[i] + sizes[i]]
        has[mine] = 1
        both = np.add.reduceat(has[column], starts)
        has[mine] = 0
        for j in np.flatnonzero((100 * both >= percent * (sizes + sizes[i] - both)) & (known != known[i])):
            if forest.join(known[i], known[j]):
                yield members[i], members[j]


def linked_sets(sets: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Classes (member, root) of the distinct sets (node, n, keys, bins) that are linked; sets without a link are left out.

    First every bucket is a star: its smallest node is held against the others. In buckets whose members are then in more than one class,
    sets whose bins allow a link to another class form families, and families are settled whole; so two linked sets that share a
    band end in one class either way.
    """
    keyed = sets.where("n > 0").select("node", F.explode("keys").alias("key"))
    stars = materialize(keyed.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("size")).where("size > 1"))
    shared = materialize(join_sized(keyed, stars, "key", "size").select("key", "node", "a"))
    pairs = materialize(shared.where("node <> a").select("a", F.col("node").alias("b")).distinct())
    pairs = materialize(_promising(pairs, sets, percent))
    release(sets.sparkSession)
    links = materialize(_confirmed(pairs, texts, words, percent))
    classes = _one_step(links)
    families = _families(_cells(shared, sets, classes), percent)
    return _classes(links.unionAll(_settled(families, classes, texts, words, percent)))


def _one_step(links: DataFrame) -> DataFrame:
    """(member, root): for each linked set the smallest of itself and what it is linked to.

    Sets of one root are in one class; a class may have several roots, which costs work later but no links.
    """
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("link"))
    near = both.groupBy(F.col("link.a").alias("member")).agg(F.min("link.b").alias("near"))
    return materialize(near.select("member", F.least("member", "near").alias("root")))


def _classes(links: DataFrame) -> DataFrame:
    classes = materialize(components(links).withColumnRenamed("node", "member"))
    release(links.sparkSession)  # the rounds leave many small files behind
    return classes


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: key, n_shingles, component_id, kept.

    A row's set is its distinct shingles of ``words`` lower-cased (A-Z) words, a text with fewer words being one shingle. Rows are linked if their sets share at
    least ``percent`` of 100 of their union; a component is what links reach, component_id its smallest key, and kept tells the row whose key that is.
    A missing or empty text, or one without words, has no shingles and is linked with nothing. Missing keys are not component ids unless all keys of a component
    are missing, and then all its rows are kept; repeated rows each get their row, with the same values. Other columns do not matter, and an empty table gives an empty one.
    Very long texts are held one at a time in a task. Equal sets are compared once, by a 128-bit digest; all other links are confirmed on the full sets, shingles being 64-bit hashes.
    Two sets at the threshold share no band with a probability of 5e-8.
    """
    spark = docs.sparkSession
    scratch = scratch_folder(spark, "minhash")
    _sketches(docs, key, text, words).write.parquet(scratch)
    sketches = spark.read.parquet(scratch)
    narrow = sketches.select("id", "digest", "n")
    first = F.min(F.struct(F.col("id").isNull().alias("gone"), "id")).alias("first")
    sets = materialize(sketches.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("node"), first, F.count("*").alias("rows"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bins").alias("bins")))
    classes = linked_sets(sets, sketches.select("row", "text"), words, percent)
    merged = sets.select("digest", "node", "first", "rows").join(classes, sets.node == classes.member, "left").select(
        "digest", "first", "rows", F.coalesce("root", "node").alias("root"))
    best = merged.groupBy("root").agg(F.min("first").alias("best"), F.count("*").alias("sets"))
    named = join_sized(merged, materialize(best), "root", "sets").select("digest", "rows", F.col("best.id").alias("component_id"))
    linked = join_sized(narrow.where("n > 0"), materialize(named), "digest", "rows").select("id", "n", "component_id")
    alone = narrow.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    done = materialize(linked.unionAll(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
    remove_folder(spark, scratch)
    return done


SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM worded
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), least_of AS (
  SELECT a, min(b) AS low FROM reached GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, least(doc_id, coalesce(low, doc_id)) = doc_id AS kept
FROM sets LEFT JOIN least_of ON a = doc_id
"""
