"""Merkle manifest of a dataset: a content-addressed store of digest-to-children records, and proofs by descent."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.simhash import whole_cells
from tablecraft.plans.lineage import materialize
from tablecraft.plans.ordering import group_position, row_index

#: A segment of the tree has two to this power of nodes at its foot; its records are read and walked together.
SEGMENT_BITS = 10
#: Columns that a leaf covers, in this order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")

RECORD = "grp string, seg bigint, digest string, children array<string>"
REACHED = "grp string, rank bigint, digest string, proof array<string>"


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def framed(value: Column) -> Column:
    """A value as its byte count, a colon and its bytes; a missing one as a dash, which no count begins with."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[framed(columns[c]) for c in COVERED]).cast("binary"), 256)


def _group(value: Column) -> Column:
    """Groups as strings that sort as the groups do, a missing one first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


# the store

def _levels(digests: list[str], levels: int | None) -> Iterator[tuple[str, list[str]]]:
    """Parent and children, level by level, until ``levels`` are done or one node is left; last the node at the top alone."""
    done = 0
    while len(digests) > 1 if levels is None else done < levels:
        runs = [digests[i:i + 2] for i in range(0, len(digests), 2)]
        digests = [digest_of(*run) for run in runs]
        yield from zip(digests, runs)
        done += 1
    yield digests[0], None


def _segments(nodes: DataFrame, bits: int) -> DataFrame:
    """Records of all segments of nodes (grp, rank, digest). A record without children names the segment's top."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_cells(batches, "cell"):
            out = []
            for a, b in _cells(rows):
                grp, seg = rows["grp"].iat[a], int(rows["seg"].iat[a])
                # a short first segment is the group's only one; any other is part of a taller tree
                levels = bits if seg or b - a == 1 << bits else None
                out.extend((grp, seg, parent, run) for parent, run in _levels(rows["digest"].iloc[a:b].tolist(), levels))
            yield pd.DataFrame(out, columns=["grp", "seg", "digest", "children"])

    dealt = nodes.select(*_place(bits), "grp", "rank", "digest").repartition("cell").sortWithinPartitions("cell", "rank")
    return dealt.mapInPandas(build, RECORD)


def _place(bits: int) -> list[Column]:
    seg = F.shiftright("rank", bits)
    return [F.concat("grp", F.lit("/"), seg.cast("string")).alias("cell"), seg.alias("seg")]


def _cells(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    cell = rows["cell"].to_numpy()
    cuts = np.r_[0, np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)]
    return zip(cuts[:-1].tolist(), cuts[1:].tolist())


def grow(nodes: DataFrame, bits: int = SEGMENT_BITS) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """The trees over (grp, rank, digest), one a group: layers of (nodes, records) from the foot, and the tops (grp, rank, digest)."""
    layers = []
    while True:
        records = materialize(_segments(nodes, bits))
        layers.append((nodes, records.where("children is not null")))
        nodes = records.where("children is null").select("grp", F.col("seg").alias("rank"), "digest")
        if not nodes.where("rank > 0").limit(1).count():
            return layers, nodes


# descent

def _walk(rows: pd.DataFrame, a: int, b: int, bits: int) -> tuple[list[int], list[tuple[str, list[str]]], list[str]]:
    """Requests of one segment (row numbers), for each the node reached and its path upwards inside the segment, and the path above.

    From the top, a binary digit of the request's rank selects the child at each level; the other child is
    collected with its side, and the collected path is turned round at the end.
    """
    kind, digest, children = rows["kind"].to_numpy()[a:b], rows["digest"].to_numpy()[a:b], rows["children"].to_numpy()[a:b]
    top, above = digest[0], list(children[0])
    store = {digest[i]: children[i] for i in np.flatnonzero(kind == 1)}
    depth, node = 0, top
    while node in store:
        node, depth = store[node][0], depth + 1
    wanted = (a + np.flatnonzero(kind == 2)).tolist()
    rank, found = rows["rank"].to_numpy(), []
    for i in wanted:
        node, path, place = top, [], int(rank[i]) & ((1 << bits) - 1)
        for level in range(depth - 1, -1, -1):
            run, digit = store[node], place >> level & 1
            path.append("" if len(run) == 1 else f"<{run[0]}" if digit else f">{run[1]}")
            node = run[digit]
        found.append((node, path[::-1]))
    return wanted, found, above


def _requests(nodes: DataFrame, records: DataFrame, reached: DataFrame, bits: int, payload: list[str]) -> DataFrame:
    """Segment by segment: the node reached at its top (kind 0), its records (1) and the requests (2); at most 2 ** (bits + 1) rows."""
    of = {c: nodes.schema[c].dataType for c in payload}
    none = [F.lit(None).cast(t).alias(c) for c, t in of.items()]
    cell = F.concat("grp", F.lit("/"), F.col("seg").cast("string")).alias("cell")
    tops = reached.withColumn("seg", F.col("rank")).select(
        cell, "grp", F.lit(0).alias("kind"), "rank", "digest", F.col("proof").alias("children"), *none)
    store = records.select(cell, "grp", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("rank"), "digest", "children", *none)
    asked = nodes.select(_place(bits)[0], "grp", F.lit(2).alias("kind"), "rank", F.lit(None).cast("string").alias("digest"),
                         F.lit(None).cast("array<string>").alias("children"), *payload)
    return tops.unionAll(store).unionAll(asked).repartition("cell").sortWithinPartitions("cell", "kind", "rank")


def descend(layers: list[tuple[DataFrame, DataFrame]], reached: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """From the tops (grp, rank, digest, proof) down to all nodes at the foot of the layers, with their proofs, nearest sibling first.

    An entry of a proof is a sibling's digest behind its side, ``<`` or ``>``, or empty where a node has no sibling.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_cells(batches, "cell"):
            out = []
            for a, b in _cells(rows):
                wanted, found, above = _walk(rows, a, b, bits)
                out.extend((rows["grp"].iat[i], rows["rank"].iat[i], node, path + above) for i, (node, path) in zip(wanted, found))
            yield pd.DataFrame(out, columns=["grp", "rank", "digest", "proof"])

    for nodes, records in reversed(layers):
        reached = _requests(nodes, records, reached, bits, []).mapInPandas(walk, REACHED)
    return reached


def fold(digest: str, proof: list[str]) -> str:
    """The root that a node and its proof give."""
    for step in proof:
        digest = digest_of(digest) if not step else digest_of(step[1:], digest) if step[0] == "<" else digest_of(digest, step[1:])
    return digest


class Manifest:
    """The store of a dataset: leaves in groups, a tree for each group, and a tree over the groups' roots.

    Leaves of a group ascend by key, a missing key first and ties by digest, so repeated rows are leaves side by
    side; groups ascend bytewise, a missing one first. Runs of two nodes become the digest of the two, a last one alone of
    itself, until one is left. Any value may be missing or empty; a long text is hashed in place and never moved; other columns are not covered.
    ``altered`` gives a leaf digest to be checked instead of the stored one, null for none. An empty table has no root and no proofs.
    """

    def __init__(self, docs: DataFrame, key: str = "doc_id", group: str = "lang", altered: dict[str, Column] | None = None,
                 check: Column | None = None, bits: int = SEGMENT_BITS):
        self.bits, self.key, self.kind = bits, key, docs.schema[key].dataType
        named = {c: F.col(c) for c in COVERED}
        changed = F.when(check, leaf_digest({**named, **altered})) if altered else F.lit(None).cast("string")
        narrow = docs.select(F.col(key).alias("id"), _group(F.col(group)).alias("grp"), leaf_digest(named).alias("digest"),
                             changed.alias("altered"), F.monotonically_increasing_id().alias("row"))
        placed = group_position(materialize(narrow), ["grp"], ["id", "digest", "row"], "rank")
        # keys travel as strings: beside rows that have none, integers would become floating-point numbers in the tasks
        self.leaves = materialize(placed.select("grp", (F.col("rank") - 1).alias("rank"), "digest", F.col("id").cast("string").alias("id"), "altered"))
        self.layers, self.subroots = grow(self.leaves, bits)
        top = row_index(self.subroots.select("digest", F.col("grp").alias("name")), ["name"], "rank")
        self.groups = materialize(top.select(F.lit("").alias("grp"), "rank", "digest", "name"))
        self.group_layers, self.root = grow(self.groups, bits)

    def records(self) -> DataFrame:
        """The store: (digest, children), one row for each digest."""
        parts = [records.select("digest", "children") for _, records in [*self.layers, *self.group_layers]]
        for part in parts[1:]:
            parts[0] = parts[0].unionAll(part)
        return parts[0].dropDuplicates(["digest"])

    def prove(self, paths: bool = False) -> DataFrame:
        """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified [, proof].

        The leaf is the one that its request reaches from the root. ``folded_root`` is worked out from the altered leaf where there is one, else
        from the leaf, and the siblings of the proof; ``verified`` tells whether it is the root.
        """
        bits = self.bits
        start = self.root.withColumn("proof", F.lit([]).cast("array<string>"))
        at_groups = descend(self.group_layers, start, bits).withColumnRenamed("proof", "path").drop("grp", "digest")
        # the group's path goes down with its length in front, so that the subroot can be told on the way
        tops = (self.groups.join(at_groups, "rank").select(
            F.col("name").alias("grp"), F.lit(0).cast("long").alias("rank"), "digest",
            F.concat(F.array(F.concat(F.lit("="), "digest")), "path").alias("proof")))
        reached = descend(self.layers[1:], tops, bits)
        schema = ("id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
                  + ", proof array<string>" * paths)

        def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in whole_cells(batches, "cell"):
                out = []
                for a, b in _cells(rows):
                    wanted, found, above = _walk(rows, a, b, bits)
                    at = next(i for i, step in enumerate(above) if step.startswith("="))
                    subroot, above = above[at][1:], above[:at] + above[at + 1:]
                    tail, known = "".join(step[1:] for step in above), {}
                    root = fold(rows["digest"].iat[a], above)
                    for i, (leaf, path) in zip(wanted, found):
                        altered = rows["altered"].iat[i]
                        top = fold(altered if isinstance(altered, str) else leaf, path)
                        if top not in known:
                            known[top] = fold(top, above)
                        row = (rows["id"].iat[i], leaf, subroot, root, digest_of(*[s[1:] for s in path], tail), known[top], known[top] == root)
                        out.append(row + (path + above,) * paths)
                yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

        nodes, records = self.layers[0]
        found = _requests(nodes, records, reached, bits, ["id", "altered"]).mapInPandas(finish, schema)
        return found.select(F.col("id").cast(self.kind).alias(self.key), *[c for c in found.columns if c != "id"])


def audit(docs: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """Proofs of all documents, of which one in seven (by crc32 of the id) is checked with n_chars raised by one."""
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return Manifest(docs, altered={"n_chars": F.col("n_chars") + 1}, check=seventh, bits=bits).prove()


SQL = r"""
WITH RECURSIVE given AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
      || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
      || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || CASE WHEN n_chars IS NULL THEN '-'
      ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || tail) END AS altered
  FROM given
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, rank AS idx, leaf AS digest, count(*) OVER (PARTITION BY lang) AS many FROM ranked
  UNION ALL
  SELECT lang, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(many) + 1) // 2
  FROM nodes WHERE many > 1 GROUP BY lang, level, idx // 2
), subroots AS (
  SELECT lang, digest AS subroot, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE many = 1
), upper AS (
  SELECT 0 AS level, place AS idx, subroot AS digest, count(*) OVER () AS many FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(many) + 1) // 2
  FROM upper WHERE many > 1 GROUP BY level, idx // 2
), steps AS (
  SELECT r.doc_id, r.lang, r.rank, n.level AS step, n.idx % 2 AS side, sibling.digest AS other
  FROM ranked r JOIN nodes n ON n.lang IS NOT DISTINCT FROM r.lang AND n.idx = r.rank >> n.level AND n.many > 1
  LEFT JOIN nodes sibling ON sibling.lang IS NOT DISTINCT FROM n.lang AND sibling.level = n.level AND sibling.idx = xor(n.idx, 1)
  UNION ALL
  SELECT r.doc_id, r.lang, r.rank, s.depth + u.level, u.idx % 2, sibling.digest
  FROM ranked r JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang JOIN upper u ON u.idx = s.place >> u.level AND u.many > 1
  LEFT JOIN upper sibling ON sibling.level = u.level AND sibling.idx = xor(u.idx, 1)
), proofs AS (
  SELECT lang, rank, sha256(string_agg(other, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY lang, rank
), folds AS (
  SELECT lang, rank, 0 AS step, coalesce(altered, leaf) AS digest FROM ranked
  UNION ALL
  SELECT f.lang, f.rank, f.step + 1, sha256(CASE WHEN s.other IS NULL THEN f.digest WHEN s.side = 0 THEN f.digest || s.other ELSE s.other || f.digest END)
  FROM folds f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.rank = f.rank AND s.step = f.step
), folded AS (
  SELECT lang, rank, arg_max(digest, step) AS folded_root FROM folds GROUP BY lang, rank
)
SELECT r.doc_id, r.leaf, s.subroot, u.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = u.digest AS verified
FROM ranked r JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.lang JOIN upper u ON u.many = 1
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM r.lang AND p.rank = r.rank
JOIN folded f ON f.lang IS NOT DISTINCT FROM r.lang AND f.rank = r.rank
"""
