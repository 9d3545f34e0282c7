"""Vector operations on array columns, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def take_slice(x: Column, start: int, stop: int | None = None, step: int = 1) -> Column:
    """x[start:stop:step] with negative positions counted from the end."""
    size = F.size(x)
    first = F.lit(start) if start >= 0 else size + start
    last = size if stop is None else (F.lit(stop) if stop >= 0 else size + stop)
    return F.filter(x, lambda v, i: (i >= first) & (i < last) & ((i - first) % step == 0))


def pick(x: Column, positions: list[int]) -> Column:
    """Values at 0-based positions (negative from the end), in the given order."""
    return F.array(*[F.get(x, F.lit(p)) if p >= 0 else F.element_at(x, p) for p in positions])


def split_at(x: Column, cuts: list[int]) -> list[Column]:
    edges = [0, *cuts]
    return [take_slice(x, a, b) for a, b in zip(edges, [*cuts, None])]


def argsort(x: Column) -> Column:
    """0-based positions in ascending order of value."""
    pairs = F.transform(x, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    return F.transform(F.array_sort(pairs), lambda p: p["i"])


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double"))


def mean(x: Column) -> Column:
    return F.try_divide(total(x), F.size(x))


def argmax(x: Column) -> Column:
    return F.array_position(x, F.array_max(x)) - 1


def argmin(x: Column) -> Column:
    return F.array_position(x, F.array_min(x)) - 1


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def normalize(x: Column) -> Column:
    """Unit length; the zero vector stays as it is."""
    size = norm(x)
    return F.transform(x, lambda v: F.coalesce(F.try_divide(v.cast("double"), size), F.lit(0.0)))
