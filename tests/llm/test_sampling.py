"""Sampled segmentations: exact round trips, reproducibility, and frequencies against all segmentations enumerated."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tablecraft.llm.resources import tokenizer_file
from tablecraft.llm.sampling import BLANK, PieceTable, Sampler, decode, digest, encode

PATH = tokenizer_file("piece_bpe_32k.model")


def texts():
    pick = random.Random(3)
    odd = [" ", "  ", "\n", "\t", "▁", "é", "é", "日本", "😀", "\x00", "　", "<0x41>", "<s>", "</s>", "<unk>", "the", "Word", ".", "ﬁ", "﻿", "\U000e0001"]
    return [None, "", " ", "▁", "a", " lead", "trail ", "two  blanks"] + ["".join(pick.choices(odd, k=pick.randint(1, 30))) for _ in range(200)] + [
        "long words and more " * 3000, "x" * 20_000, "日" * 5_000]


def test_decoding_is_lossless_and_draws_are_reproducible(spark):
    rows = [(i, t, [1]) for i, t in enumerate(texts())] + [(None, "no key", None), (3, "a", [2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    coded = encode(df, PATH)
    back = decode(coded, PATH).collect()
    assert [(r.doc_id, r.text) for r in back] == [(i, t or "") for i, t, _ in rows]
    again = {(r.doc_id, tuple(r.ids)) for r in encode(df.repartition(5), PATH).collect()}
    assert again == {(r.doc_id, tuple(r.ids)) for r in coded.collect()}
    other = {(r.doc_id, tuple(r.ids)) for r in encode(df, PATH, seed=2).collect()}
    assert other != again
    summed = digest(df, PATH).collect()
    assert all(r.lossless for r in summed) and {(r.doc_id, r.n_pieces) for r in summed} == {(i, len(x)) for i, x in again}


def segmentations(table, text):
    if not text:
        return [((), 1.0)]
    out = []
    for j in range(1, len(text) + 1):
        known = table.weights.get(text[:j])
        if known:
            out += [((known[0], *rest), known[1] * w) for rest, w in segmentations(table, text[j:])]
    return out


@pytest.mark.parametrize("word", ["the", "where", "tion", "aa"])
def test_draws_follow_the_weights(word):
    sampler, n = Sampler(PATH), 20_000
    found = Counter(tuple(x.tolist()) for x in sampler.encode([word.encode()] * n, np.random.default_rng(1).integers(0, 2**62, n).tolist()))
    every = segmentations(sampler.table, BLANK + word)
    whole = sum(w for _, w in every)
    assert set(found) <= {ids for ids, _ in every}
    for ids, w in every:
        share = w / whole
        assert abs(found[ids] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4
    assert PieceTable(PATH).decode(every[0][0]) == word


def test_no_rows(spark):
    assert digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_words_are_cut_where_no_piece_spans_two_neighbours():
    """All words of a block are cut together; a word's units are those of the plain rule, and its draw is the one it has alone."""
    sampler = Sampler(PATH)
    table = sampler.table
    spanned = {p[i:i + 2] for p in table.weights for i in range(len(p) - 1)}
    words = list(dict.fromkeys(w for t in texts() if t for w in t.replace(BLANK, "\udc81")[:500].split(" ")))
    sampler.lattices.learn(words)
    node = {v: u for u, v in sampler.lattices.units.items()}
    ends, many = sampler.lattices.units_of(np.arange(len(words)))
    for word, places in zip(words, np.split(ends, np.cumsum(many)[:-1])):
        text, want = BLANK + word, [BLANK]
        for a, b in zip(text, text[1:]):
            if a + b in spanned:
                want[-1] += b
            else:
                want.append(b)
        assert [node[i] for i in places.tolist()] == want
    block = ["the words of it", "", "日本 où", "the"]
    alone = [next(Sampler(PATH).encode([t.encode()], [7])).tolist() for t in block]
    assert [x.tolist() for x in sampler.encode([t.encode() for t in block], [7] * 4)] == alone
