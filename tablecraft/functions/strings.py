"""String methods with the results of their dataframe namesakes; missing stays missing."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablecraft.operators.reshape import pivot_values

CASED = r"[\p{Lu}\p{Ll}\p{Lt}]"
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"


def capitalize(s: Column) -> Column:
    return F.concat(F.upper(F.substr(s, F.lit(1), F.lit(1))), F.lower(F.substr(s, F.lit(2))))


def swapcase(s: Column) -> Column:
    return F.array_join(F.transform(F.split(s, ""), lambda x: F.when(x == F.upper(x), F.lower(x)).otherwise(F.upper(x))), "")


def ljust(s: Column, width: int, fill: str = " ") -> Column:
    return F.when(F.length(s) < width, F.rpad(s, width, fill)).otherwise(s)


def rjust(s: Column, width: int, fill: str = " ") -> Column:
    return F.when(F.length(s) < width, F.lpad(s, width, fill)).otherwise(s)


def center(s: Column, width: int, fill: str = " ") -> Column:
    """Extra space goes right, except to the left when both gap and width are odd."""
    gap = F.lit(width) - F.length(s)
    left = F.floor(gap / 2) + gap.bitwiseAND(F.lit(width)).bitwiseAND(F.lit(1))
    padded = F.concat(F.repeat(F.lit(fill), left.cast("int")), s, F.repeat(F.lit(fill), (gap - left).cast("int")))
    return F.when(gap > 0, padded).otherwise(s)


def zfill(s: Column, width: int) -> Column:
    """Zeros go after a leading sign."""
    sign = F.regexp_extract(s, r"^([+-]?)", 1)
    body = F.substr(s, F.length(sign) + 1)
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), F.lit(width) - F.length(s)))
    return F.concat(sign, zeros, body)


def lstrip(s: Column) -> Column:
    return F.regexp_replace(s, rf"\A{SPACE}+", "")


def rstrip(s: Column) -> Column:
    return F.regexp_replace(s, rf"{SPACE}+\z", "")


def strip(s: Column) -> Column:
    return lstrip(rstrip(s))


def find(s: Column, part: str) -> Column:
    """0-based first position, -1 if absent."""
    return F.instr(s, F.lit(part)) - 1


def rfind(s: Column, part: str) -> Column:
    back = F.instr(F.reverse(s), F.lit(part[::-1]))
    return F.when(back == 0, -1).otherwise(F.length(s) - back - (len(part) - 1))


def index(s: Column, part: str) -> Column:
    """Like find, but an absent part is an error."""
    return F.when(find(s, part) >= 0, find(s, part)).when(
        s.isNotNull(), F.raise_error(F.lit("substring not found")).cast("int"))


def rindex(s: Column, part: str) -> Column:
    return F.when(rfind(s, part) >= 0, rfind(s, part)).when(
        s.isNotNull(), F.raise_error(F.lit("substring not found")).cast("int"))


PREDICATES = {
    "isalpha": r"\A\p{L}+\z",
    "isalnum": r"\A[\p{L}\p{N}]+\z",
    "isdecimal": r"\A\p{Nd}+\z",
    "isdigit": r"\A[\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}-\x{2079}\x{2080}-\x{2089}]+\z",
    "isnumeric": r"\A\p{N}+\z",
    "isspace": rf"\A{SPACE}+\z",
}


def predicate(s: Column, name: str) -> Column:
    if name == "islower":
        return s.rlike(r"\p{Ll}") & ~s.rlike(r"[\p{Lu}\p{Lt}]")
    if name == "isupper":
        return s.rlike(r"\p{Lu}") & ~s.rlike(r"[\p{Ll}\p{Lt}]")
    if name == "istitle":
        return s.rlike(r"\p{Lu}") & ~s.rlike(rf"(^|[^{CASED[1:-1]}])\p{{Ll}}") & ~s.rlike(rf"{CASED}\p{{Lu}}")
    return s.rlike(PREDICATES[name])


def partition(s: Column, sep: str) -> list[Column]:
    """Before, separator and after, split at the first separator."""
    at = F.instr(s, F.lit(sep))
    found = at > 0
    return [F.when(found, F.substr(s, F.lit(1), at - 1)).otherwise(s),
            F.when(found, F.lit(sep)).when(s.isNotNull(), F.lit("")),
            F.when(found, F.substr(s, at + len(sep))).when(s.isNotNull(), F.lit(""))]


def rpartition(s: Column, sep: str) -> list[Column]:
    """Before, separator and after, split at the last separator."""
    at = rfind(s, sep)
    found = at >= 0
    return [F.when(found, F.substr(s, F.lit(1), at)).when(s.isNotNull(), F.lit("")),
            F.when(found, F.lit(sep)).when(s.isNotNull(), F.lit("")),
            F.when(found, F.substr(s, at + len(sep) + 1)).otherwise(s)]


def slice_replace(s: Column, start: int, stop: int, new: str) -> Column:
    return F.concat(F.substr(s, F.lit(1), F.lit(start)), F.lit(new), F.substr(s, F.lit(stop + 1)))


def match(s: Column, pattern: str) -> Column:
    return s.rlike(rf"\A(?:{pattern})")


def extract(s: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, missing without a match."""
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, group))


def findall(s: Column, pattern: str) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), 0)


def join_chars(s: Column, sep: str) -> Column:
    """Put a separator between the characters."""
    return F.array_join(F.split(s, ""), sep)


@F.pandas_udf(StringType())
def normalize_nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def wrap(s: Column, width: int) -> Column:
    """Break lines between words, or behind a hyphen between letters, so that none is longer than ``width``.

    A line takes as many words as fit. A word that is longer than a line fills up the line before it and is cut. Each blank character
    counts as one space; those at a break are dropped, unless they
    fill the line exactly before an overlong word. One pass of a regular expression, so a long text costs no more a line than a short one.
    """
    behind_hyphen = r"(?<=\p{L}{2}-)(?=\p{L}-?\p{L})|(?<=\p{L}-\p{L}-)(?=\p{L}-?\p{L})"
    # as much as fits before a break, unless an overlong word follows; else the whole width
    line = rf"(?:^| *)((?>.{{0,{width - 1}}}[^ ](?= |$|{behind_hyphen}))(?! *[^ ]{{{width + 1}}})|.{{{width}}}(?:(?<! )|(?! ))|.{{0,{width - 1}}}[^ ](?= ))"
    blanks = F.translate(s, "\t\n\x0b\x0c\r", " " * 5)
    lines = F.filter(F.regexp_extract_all(blanks, F.lit(line), 1), lambda x: x.rlike(r"[^\p{Z}\s\x1c-\x1f\x85]"))
    return F.when(s.isNotNull(), F.array_join(lines, "\n"))


def get_dummies(df: DataFrame, column: str, sep: str, keep: list[str]) -> DataFrame:
    """A 0/1 column per token, in sorted order of the tokens."""
    tokens = F.split(F.col(column), F.concat(F.lit(r"\Q"), F.lit(sep), F.lit(r"\E")))
    known = pivot_values(df.select(F.explode(tokens).alias("token")), "token")
    return df.withColumn("_t", tokens).select(
        *keep, *[F.coalesce(F.array_contains("_t", k), F.lit(False)).cast("int").alias(k) for k in known if k])
