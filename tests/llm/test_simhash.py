"""SimHash near copies against brute force."""

import random

import numpy as np
import xxhash

from tablecraft.llm.bktree import Forest, roots_of
from tablecraft.llm.components import components
from tablecraft.llm.simhash import drop_near_copies, fingerprint, linked_prints, near_copies

SCHEMA = "doc_id long, text string, lang string, fp string"


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=4):
    """Smallest index reachable, by comparing all pairs."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= radius and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


def texts(seed=1):
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdefgh", k=4)) for _ in range(300)]
    base = [" ".join(pick.choices(words, k=n)) for n in (3, 4, 5, 40, 200, 1000)]
    out = [None, "", " \t\n", "One two", "one TWO", "ÄB c d e", "äb c d e"] + base
    for text in base[3:]:
        for _ in range(12):
            parts = text.split()
            parts[pick.randrange(len(parts))] = pick.choice(words)
            out.append(" ".join(parts))
    return out + base


def test_fingerprint_equals_definition():
    for text in texts():
        assert fingerprint((text or "").encode()) % (1 << 64) == plain(text)


def test_near_copies_equal_brute_force(spark):
    rows = [(i, t, "en", "clash") for i, t in enumerate(texts())]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in near_copies(spark.createDataFrame(rows, SCHEMA)).collect()}
    prints = [plain(t) for _, t, _, _ in rows]
    want = classes(prints)
    assert found == {i: (f"{prints[i]:016x}", want[i]) for i in range(len(rows))}


def test_one_row_of_each_component_stays_whole(spark):
    rows = [(i, t, "en", "clash") for i, t in enumerate(texts())] + [(0, None, "en", "clash"), (None, "One two", None, None)]
    kept = drop_near_copies(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "lang", "fp"]
    want = classes([plain(t) for _, t, _, _ in rows])
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r for r in want if r < len(rows) - 2})


def test_empty_and_all_missing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert near_copies(none).count() == 0 and drop_near_copies(none).count() == 0
    lost = spark.createDataFrame([(None, "a b c d", "x", "y")] * 3, SCHEMA)
    assert [r.component_id for r in near_copies(lost).collect()] == [None] * 3
    assert drop_near_copies(lost).count() == 1


def test_trees_find_all_pairs_within_the_radius():
    pick = np.random.default_rng(5)
    centres = pick.integers(0, 1 << 63, 5, dtype=np.uint64)
    prints = np.concatenate([centres[pick.integers(0, 5, 600)] ^ (np.uint64(1) << pick.integers(0, 64, 600).astype(np.uint64))
                             ^ (np.uint64(1) << pick.integers(0, 64, 600).astype(np.uint64)), centres, centres])
    shard = pick.integers(0, 3, len(prints))
    found = set()
    for q, n in Forest(shard, prints).search(shard, prints, 3):
        found |= set(zip(q.tolist(), n.tolist()))
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    want = np.argwhere((apart <= 3) & (shard[:, None] == shard[None, :]))
    assert found == set(map(tuple, want.tolist()))
    assert list(roots_of(6, iter([(np.array([5, 3]), np.array([3, 1])), (np.array([0]), np.array([2]))]))) == [0, 1, 0, 1, 4, 1]


def test_links_across_the_blocks_of_a_hot_key(spark):
    pick = random.Random(3)
    prints = sorted({sum(1 << b for b in pick.sample(range(62), 3)) for _ in range(400)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.node: r.root for r in components(linked_prints(df, 4, shard=16)).collect()}
    want = classes(prints)
    assert {p: roots.get(p, p) for p in prints} == {p: prints[want[i]] for i, p in enumerate(prints)}


def test_components_of_a_long_chain(spark):
    pick = list(range(120))
    random.Random(2).shuffle(pick)
    edges = [(pick[i], pick[i + 1]) for i in range(119)] + [(500, 501), (7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(120)}, 500: 500, 501: 500}
