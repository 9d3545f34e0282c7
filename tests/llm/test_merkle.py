"""Merkle manifests against a plain tree in Python."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tablecraft.llm.merkle import Manifest, audit, fold

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp int, rank string, extra map<string,int>, `a.b` int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else None))
        at >>= 1
    return out


def plain(rows):
    """What the query returns, by keeping whole trees."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for rows_of in groups.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    upper = tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, row in enumerate(groups[g]):
            steps = path(trees[g], at) + path(upper, place)
            now = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)
            for side, other in steps:
                now = h(now) if other is None else h(other, now) if side else h(now, other)
            root = upper[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, h(*[o for _, o in steps if o]), now, now == root))
    return sorted(out, key=repr)


def some(count, seed=3, langs=("en", "fr", "", "=x/1", "é", None)):
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        lang = pick.choice(langs) if pick.random() < 0.6 else langs[0]
        rows.append((i, pick.choice(["a", "b:c", None, ""]), lang, pick.choice([None, 5, 0]), pick.choice([None, "", "x" * 50, "é\n", "z"]), 1, "r", {"a": 1}, 2))
    return rows


@pytest.mark.parametrize("count, bits", [(1, 10), (2, 1), (3, 2), (9, 1), (200, 2), (200, 10)])
def test_rows_equal_a_plain_tree(spark, rows, count, bits):
    given = some(count)
    if count > 2:
        given += [given[0], given[0], (None, "a", "en", 1, "t", 1, "r", None, 2), (1 << 60, None, None, None, None, None, None, None, None)]
    assert rows(audit(spark.createDataFrame(given, SCHEMA), bits)) == plain(given)


def test_only_changed_rows_fail(spark):
    given = some(300, langs=("en",))
    found = {r.doc_id: r for r in audit(spark.createDataFrame(given, SCHEMA), 3).collect()}
    for row in given:
        changed = zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
        assert found[row[0]].verified == (not changed)


def test_proofs_fold_to_the_root_and_records_are_content_addressed(spark):
    given = some(120) + [(7, "a", "en", 1, "same", 1, "r", None, 2)] * 40
    manifest = Manifest(spark.createDataFrame(given, SCHEMA), bits=2)
    proofs = manifest.prove(paths=True).collect()
    assert len(proofs) == 160 and all(fold(p.leaf, p.proof) == p.root and p.verified for p in proofs)
    store = {r.digest: r.children for r in manifest.records().collect()}
    assert all(h(*children) == digest for digest, children in store.items())
    node = proofs[0].root
    while node in store:
        node = store[node][0]
    assert node in {p.leaf for p in proofs}


def test_altered_columns_are_chosen_by_the_caller(spark):
    given = spark.createDataFrame(some(30), SCHEMA)
    found = Manifest(given, altered={"text": F.lit("forged")}, check=F.col("doc_id") < 10).prove().collect()
    assert {r.doc_id for r in found if not r.verified} == set(range(10))


def test_empty_table(spark):
    assert audit(spark.createDataFrame([], SCHEMA)).count() == 0
