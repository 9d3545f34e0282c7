"""One-permutation near copies against all pairs."""

import random

import numpy as np
import pytest

from tablecraft.llm import minhash
from tablecraft.llm.minhash import BINS, Shingles, bands_of, bins_of, near_copies, similar

SCHEMA = "doc_id long, text string, n long, row string, component_id map<string,int>, `a.b` int"


def plain_set(text, words):
    found = (text or "").encode().lower().split()
    size = min(words, len(found))
    return {b" ".join(found[i:i + size]) for i in range(len(found) - size + 1)} if found else set()


def plain(given, words, percent=80):
    """(id, size, smallest id reachable, kept) by comparing all pairs."""
    sets = [plain_set(t, words) for _, t in given]
    root = list(range(len(given)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    low = {}
    for i, (key, _) in enumerate(given):
        if key is not None:
            low[top(i)] = min(low.get(top(i), key), key)
    return sorted(((key, len(sets[i]), low.get(top(i)), key == low.get(top(i))) for i, (key, _) in enumerate(given)), key=repr)


def texts(seed=1, copies=25):
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdefgh", k=4)) for _ in range(400)]
    out = [None, "", " \t\n", "one", "ONE", "one two", "One TWO\t", "Äb c d", "äb c d"]
    for size in (5, 6, 12, 40, 150, 800):
        base = pick.choices(words, k=size)
        for _ in range(copies):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, size // 14))):
                copy[pick.randrange(size)] = pick.choice(words)
            out.append(" ".join(copy))
    return out


def rows_of(spark, given):
    return spark.createDataFrame([(k, t, 7, "clash", {"a": 1}, 2) for k, t in given], SCHEMA)


def found(frame):
    assert frame.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("words", [2, 5])
def test_rows_equal_all_pairs(spark, words):
    given = list(enumerate(texts(words))) + [(3, "one"), (None, "one two"), (1 << 60, None)]
    random.Random(1).shuffle(given)
    assert found(near_copies(rows_of(spark, given), words=words)) == plain(given, words)


def test_rows_equal_all_pairs_when_stars_and_cells_are_small(spark, monkeypatch):
    """Copies of a lost original: the smallest of a bucket is not linked to most, so families and blocks have to find the links."""
    pick = random.Random(5)
    words = ["".join(pick.choices("abcdefgh", k=5)) for _ in range(500)]
    base, given = pick.choices(words, k=120), []
    for i in range(150):
        copy = list(base)
        for _ in range(pick.randint(4, 9)):
            copy[pick.randrange(120)] = pick.choice(words)
        given.append((i, " ".join(copy)))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "STAR", 4)
    want = plain(given, 2)
    assert 1 < len({r[2] for r in want}) < 150
    assert found(near_copies(rows_of(spark, given), words=2)) == want


def test_a_chain_has_one_component(spark):
    words = [f"w{i}" for i in range(300)]
    given = [(i, " ".join(words[4 * i:4 * i + 60])) for i in range(50)]
    assert found(near_copies(rows_of(spark, given), words=2)) == plain(given, 2)


def test_many_equal_rows_and_lost_keys(spark):
    given = [(i % 40, "the same old text again") for i in range(4000)] + [(None, "lost one two three")] * 3 + [(77, "alone here")]
    got = found(near_copies(rows_of(spark, given), words=2))
    assert len(got) == 4004 and {r[2] for r in got} == {0, None, 77}
    assert all(r[3] == (r[0] == r[2]) for r in got)


def test_empty_table(spark):
    assert near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bins_estimate_the_similarity_of_small_and_large_sets():
    pick = np.random.default_rng(2)
    for size in (5, 10, 60, 128, 1000, 20_000):
        equal, linked = [], 0
        for _ in range(60):
            pool = pick.integers(0, 1 << 63, size + size // 4, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(pool[:size]), np.unique(pool)
            x, y = bins_of(a), bins_of(b)
            equal.append((x.astype(np.uint8) == y.astype(np.uint8)).sum())
            linked += bool((bands_of(x) == bands_of(y)).any())
            assert similar(a, b, 80) == (100 * len(a) >= 80 * len(b))
        assert linked == 60 and min(equal) >= minhash.AGREEING
        assert abs(np.mean(equal) / BINS - size / (size + size // 4)) < 0.05


def test_sets_equal_the_definition_whatever_is_remembered(monkeypatch):
    monkeypatch.setattr(minhash, "REMEMBERED", 50)
    for words in (1, 2, 5):
        shingles, sets = Shingles(words), {}
        for text in texts():
            hashes = shingles.of((text or "").encode())
            assert len(hashes) == len(plain_set(text, words)) and (hashes[1:] > hashes[:-1]).all()
            sets[hashes.tobytes()] = sets.get(hashes.tobytes(), set()) | {frozenset(plain_set(text, words))}
        assert all(len(s) == 1 for s in sets.values())
