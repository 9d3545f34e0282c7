"""Row and column selection where the order or the null rule needs care."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tablecraft.plans.groups import is_small
from tablecraft.plans.ordering import row_index

TRANSPOSE_ROWS = 500


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the 'numeric' or 'string' columns."""
    wanted = {"numeric": NumericType, "string": StringType}[kind]
    return [f.name for f in df.schema if isinstance(f.dataType, wanted)]


def select_by_dtype(df: DataFrame, kind: str, keep: list[str] = ()) -> DataFrame:
    names = [c for c in columns_of(df, kind) if c not in keep]
    return df.select(*keep, *names)


def drop_rows_by_key(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not among ``keys``."""
    return df.join(keys, on, "left_anti")


def isin_lookup(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``; Spark broadcasts the keys if they turn out small."""
    return df.join(keys, on, "left_semi")


def flag_positive(value: Column) -> Column:
    return F.when(value > 0, 1).otherwise(0)


def position_range(df: DataFrame, order: list, start: int = 0, stop: int | None = None,
                   step: int = 1, reverse: bool = False) -> DataFrame:
    """Rows by position, end excluded; ``order`` must identify a row."""
    rows = row_index(df, [F.col(c).desc() for c in order] if reverse else order)
    inside = F.col("row_index") >= start
    if stop is not None:
        inside = inside & (F.col("row_index") < stop)
    return rows.filter(inside & ((F.col("row_index") - start) % step == 0))


def argsort_rows(df: DataFrame, position: list, by: list) -> DataFrame:
    """Original position of each row, listed by its rank in the order ``by``."""
    return row_index(row_index(df, position, "position"), [*by, "position"], "rank")


def transpose_small(df: DataFrame, key: str, most: int = TRANSPOSE_ROWS) -> DataFrame:
    """Rows become columns; refused for more than ``most`` rows, as each is a column of the plan."""
    if not is_small(df, most):
        raise ValueError(f"more than {most} rows cannot become columns")
    return df.transpose(F.col(key))
