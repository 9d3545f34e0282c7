"""Words and columns that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what separates words, in Java's and Python's regular expressions.
BLANKS = r"[\x20\x09-\x0D]+"


def whole(column: str) -> Column:
    """The whole text as a string; a missing text is the empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def octets(column: str) -> Column:
    """The whole text as UTF-8 bytes, which Python tasks read without decoding."""
    return whole(column).cast("binary")


def held_out(key: str, folds: int) -> Column:
    """True where crc32 of the id as text is divisible by ``folds``; a row without id is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
