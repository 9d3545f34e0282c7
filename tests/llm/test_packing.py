"""Tokens and packing against the tokenizer itself and against the definition."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecraft.llm.packing import ChunkTokenizer, best_fit, pack, pack_documents
from tablecraft.llm.resources import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")


def texts():
    pick = random.Random(9)
    odd = ["a b", "x\u0085y", "é ́e", "<|endoftext|> a", "a <|startoftext|>b", "don't I'LL we 've", "１２３ ٣", "😀👍🏽", "​ z", "﻿", "ﬁ ĳ",
           "\x00 a\x00b", " x", "a\r\nb\x0bc\x0cd", "\x1c\x1d\x1e\x1f", "###$$$ %%%", "İstanbul ẞ ΑΣ σ"]
    mixed = ["".join(pick.choices(odd + [" ", "\n", "word", "."], k=12)) for _ in range(60)]
    return [None, "", " \n"] + odd + mixed + [" ".join(pick.choices(["alpha", "beta", "gamma,", "x"], k=n)) for n in (3, 400, 2047, 2048, 9000)]


def tokens(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def test_chunks_give_the_tokens_of_the_whole_text():
    chunked = ChunkTokenizer(PATH)
    for t in texts():
        assert np.frombuffer(chunked.encode((t or "").encode()), "<u4").tolist() + [0] == tokens(t), repr(t)


def test_letters_that_end_in_a_mark_once_normalised():
    """U+0130 in lower case, and U+0958 and U+FB2A composed, end in a combining mark, which joins the marks behind it."""
    chunked = ChunkTokenizer(PATH)
    for t in ["BELED\u0130YES\u0130.", "\u0130,", "\u0130", "\u0958.", "x\u0958!?", "\ufb2a.", "\ufb2ax.", "\u00c9COLE.", "\u039f\u03a3.", "stra\u00dfe,"]:
        assert np.frombuffer(chunked.encode(t.encode()), "<u4").tolist() + [0] == tokens(t), ascii(t)


def check(rows, size):
    """Every sequence is full from offset 0 without gaps and within the size."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= size
    return len(by)


def test_pack_documents(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts())] + [(None, "no id", None, None), (0, None, "x", 0), (2**60 + 1, "big", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item string, length long")
    got = pack_documents(df, PATH, ids=True).collect()
    want = sorted(((i, n, s, t[s:s + 2048]) for i, x, *_ in rows for t in [tokens(x)] for n, s in enumerate(range(0, len(t), 2048))), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == want
    assert all(r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    total = sum(len(w[3]) for w in want)
    assert check(got, 2048) <= math.ceil(total / 2048) + 1


@pytest.mark.parametrize("kind", ["mixed", "halves", "large", "tiny"])
def test_rounds_of_groups(spark, kind):
    pick = random.Random(6)
    low, high = {"mixed": (1, 100), "halves": (51, 51), "large": (60, 100), "tiny": (1, 3)}[kind]
    lengths = [pick.randint(low, high) for _ in range(3000)]
    df = spark.createDataFrame([(n,) for n in lengths], "length long").repartition(20)
    n = check(pack(df, 100, bits=6, slack=2).collect(), 100)
    least = max(math.ceil(sum(lengths) / 100), sum(x > 50 for x in lengths))
    assert n <= least * 1.06 + 1  # groups of 64 items only


def test_best_fit_and_empty(spark):
    bins, offsets = best_fit(np.array([5, 5, 10, 3, 2]), 10)
    assert bins.tolist() == [1, 1, 0, 2, 2] and offsets.tolist() == [0, 5, 0, 0, 3]
    none = pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert none.count() == 0 and none.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
