"""Scalar functions against Python and pandas."""

import random
import textwrap
import unicodedata

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablecraft.functions import arrays as ar
from tablecraft.functions import dates as dt
from tablecraft.functions import mathx as mx
from tablecraft.functions import strings as sx

WORDS = ["river", "Stone", "", "  two words88 ", "ÉCOLE été", "-42", "Hello World", "123", "²", "a", "x_y", "They'Re", "\t\n", "ABC", "lower case", "\u00a0x\u2003", "\u2003"]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(i, w) for i, w in enumerate(WORDS)] + [(99, None)], "i int, s string")


def both(words, column, function):
    got = {r.i: r.x for r in words.select("i", column.alias("x")).collect()}
    assert got.pop(99) is None
    assert [got[i] for i in range(len(WORDS))] == [function(w) for w in WORDS]


s = "s"


@pytest.mark.parametrize("name", ["islower", "isupper", "isalpha", "isalnum", "isdecimal", "isdigit", "isnumeric", "isspace", "istitle"])
def test_predicates(words, name):
    both(words, sx.predicate(F.col(s), name), lambda w: getattr(w, name)())


def test_case_and_padding(words):
    both(words, sx.capitalize(F.col(s)), str.capitalize)
    both(words, sx.swapcase(F.col(s)), str.swapcase)
    for width in (4, 7, 8):
        both(words, sx.center(F.col(s), width, "*"), lambda w: w.center(width, "*"))
        both(words, sx.ljust(F.col(s), width), lambda w: w.ljust(width))
        both(words, sx.rjust(F.col(s), width, "."), lambda w: w.rjust(width, "."))
        both(words, sx.zfill(F.col(s), width), lambda w: w.zfill(width))


def test_search_and_split(words):
    both(words, sx.strip(F.col(s)), str.strip)
    both(words, sx.lstrip(F.col(s)), str.lstrip)
    both(words, sx.rstrip(F.col(s)), str.rstrip)
    both(words, sx.find(F.col(s), "l"), lambda w: w.find("l"))
    both(words, sx.rfind(F.col(s), "l"), lambda w: w.rfind("l"))
    both(words, F.array(*sx.partition(F.col(s), " "))[2], lambda w: w.partition(" ")[2])
    for n in range(3):
        both(words, sx.rpartition(F.col(s), "e")[n], lambda w: w.rpartition("e")[n])
        both(words, sx.partition(F.col(s), "l")[n], lambda w: w.partition("l")[n])
    both(words, sx.join_chars(F.col(s), "-"), "-".join)
    both(words, sx.normalize_nfkd(F.col(s)), lambda w: unicodedata.normalize("NFKD", w))
    both(words, sx.wrap(F.col(s), 6), lambda w: "\n".join(textwrap.wrap(w, 6)))


def test_lines_are_filled_as_by_a_plain_fold(spark):
    """Random texts against the standard library, with words that are longer than a line and hyphens."""
    pick = random.Random(3)
    parts = ["a", "bcd", "efghi", "x" * 9, "y" * 14, "z" * 30, "ab-cd", "12-34", "a-b", "é", "漢字", ".", "well-known,"]
    for width in (5, 12, 20):
        short = [p for p in parts if "-" not in p or len(p) <= width]
        texts = ["".join(pick.choice(short) + pick.choice([" ", "  ", "\n", " \r\n"]) for _ in range(pick.randint(0, 60))) for _ in range(300)]
        texts = [t.lstrip() for t in texts] + ["", " ", "\n" * 50]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
        got = {r.i: r.x for r in df.select("i", sx.wrap(F.col("s"), width).alias("x")).collect()}
        for i, t in enumerate(texts):
            assert got[i] == "\n".join(textwrap.wrap(t, width)), (t, width)


def test_index_fails_when_absent(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert df.select(sx.index(F.col(s), "c"), sx.rindex(F.col(s), "a")).first()[:] == (2, 0)
    with pytest.raises(Exception, match="substring not found"):
        df.select(sx.index(F.col(s), "x")).collect()


def test_extract_and_dummies(spark, rows):
    df = spark.createDataFrame([("a", "B|C|D"), ("b", "B|D"), ("c", "A.C"), ("d", None)], "n string, info string")
    assert df.select(sx.extract(F.col("info"), "(C)")).collect()[1][0] is None
    got = sx.get_dummies(df, "info", "|", ["n"])
    assert got.columns == ["n", "A.C", "B", "C", "D"]
    assert rows(got) == [("a", 0, 1, 1, 1), ("b", 0, 1, 0, 1), ("c", 1, 0, 0, 0), ("d", 0, 0, 0, 0)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAB éß12 -+", max_size=8), min_size=1, max_size=20), st.integers(1, 9))
def test_padding_property(spark, texts, width):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r for r in df.select("i", sx.center(F.col(s), width).alias("c"), sx.zfill(F.col(s), width).alias("z")).collect()}
    for i, t in enumerate(texts):
        assert (got[i].c, got[i].z) == (t.center(width), t.zfill(width))


def test_mixed_dates(spark):
    texts = ["4th of July, 2015", "2015-Jul-6", "07-07-2015", "20150708", "21st June, 2020", "2020-06-21", "nonsense", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [str(r[0]) for r in df.select(dt.parse_mixed(F.col("t"))).collect()] == [
        "2015-07-04", "2015-07-06", "2015-07-07", "2015-07-08", "2020-06-21", "2020-06-21", "None", "None"]


def test_floor_division_and_remainder(spark):
    pairs = [(7, 3), (-7, 3), (7, -3), (-7, -3), (5, 0)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = df.select(mx.floor_div(F.col("a"), F.col("b")), mx.floor_mod(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(a // b, a % b) if b else (None, None) for a, b in pairs]


def test_arrays(spark):
    x = [5.0, 1.0, 4.0, 2.0, 3.0, 9.0, 7.0]
    df = spark.createDataFrame([(x,)], "x array<double>")
    c = F.col("x")
    got = df.select(ar.take_slice(c, 1, 6, 2), ar.take_slice(c, -3, -1), ar.pick(c, [0, -1]), ar.argsort(c), ar.argmax(c),
                    ar.argmin(c), ar.norm(c), ar.mean(c), *ar.split_at(c, [2, 5])).first()
    assert got[0] == x[1:6:2] and got[1] == x[-3:-1] and got[2] == [5.0, 7.0]
    assert got[3] == list(np.argsort(x)) and (got[4], got[5]) == (5, 1)
    assert got[6] == pytest.approx(np.linalg.norm(x)) and got[7] == pytest.approx(np.mean(x))
    assert list(got[8:]) == [x[:2], x[2:5], x[5:]]


def test_cyclic_wraps(spark):
    sin, cos = spark.range(1).select(*dt.cyclic(F.lit(12), 12)).first()
    assert sin == pytest.approx(0, abs=1e-12) and cos == pytest.approx(1)
    assert pd.Timestamp("2015-07-04").day_name() == spark.range(1).select(
        dt.weekday_name(F.lit("2015-07-04").cast("date"))).first()[0]
