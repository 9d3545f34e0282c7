"""Quality measures against plain Python, and host rates against the formula."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tablecraft.llm.quality import beta_prior, judge, keep_good, measures


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {i + k for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def texts():
    pick = random.Random(7)
    out = [None, "", " \t\n\x0b\x0c\r", "a b c d e", "a b c d e a b c d e", "x " * 40, "é😀 #*$ %&|<>\n\n#*$\n \n#*$", " one word ", "a\nb\nb\n b\nb "]
    out += ["".join(pick.choices(["a ", "b ", "c\n", "#", " ", "dd ", "\r\n"], k=pick.randint(0, 80))) for _ in range(150)]
    return out + ["word and again " * 20_000, " ".join(str(i) for i in range(50_000))]


def test_measures_equal_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "i int, t string")
    for r in df.select("i", measures("t").alias("m")).collect():
        assert (r.m.n_words, r.m.word_chars, r.m.n_symbols, r.m.n_dup_lines, r.m.n_repeat_words) == plain(texts()[r.i]), texts()[r.i]


GOOD = "number {} tells a calm and plain story of seven small boats upon the wide lake".format


def corpus():
    rows = [(i, GOOD(i), f"good{i % 6}", "x") for i in range(120)]
    rows += [(1000 + i, "far too short", "bad", "x") for i in range(80)] + [(1100, GOOD("a"), "bad", "x")]
    rows += [(1200 + i, "short too", "small", "x") for i in range(1)] + [(1201, GOOD("b"), "small", "x"), (None, GOOD("c"), None, None), (1300, None, None, None)]
    return rows + [rows[0], rows[0]]


def test_bad_hosts_lose_all_documents_and_small_ones_do_not(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, source string, bad string")
    judged = judge(df).collect()
    assert len(judged) == len(corpus())
    kept = {r.doc_id for r in judged if r.kept}
    assert kept == {i for i in range(120)} | {1201, None}
    assert not next(r for r in judged if r.doc_id == 1100).base_failed
    stay = keep_good(df)
    assert stay.columns == df.columns and sorted((r.doc_id for r in stay.collect()), key=str) == sorted(
        [i for i, *_ in corpus() if i in kept and i != 1300], key=str)


def test_prior_follows_the_moments():
    assert beta_prior(0, 0, 0, 0.0) == (1.0, 1.0) and beta_prior(3, 10, 10, 10.0) == (1.0, 1.0)
    n, failed = [100, 200, 50], [10, 60, 20]
    mean = sum(failed) / sum(n)
    spread = sum(f * f / m for f, m in zip(failed, n)) / sum(n) - mean**2 - mean * (1 - mean) * 3 / sum(n)
    a, b = beta_prior(3, sum(n), sum(failed), sum(f * f / m for f, m in zip(failed, n)))
    assert a / (a + b) == pytest.approx(mean) and a + b == pytest.approx(mean * (1 - mean) / spread - 1)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert judge(none).count() == 0 and keep_good(none).count() == 0 and none.select(F.lit(1)).count() == 0
