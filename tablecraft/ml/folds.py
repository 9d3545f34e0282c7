"""Splitting rows for validation: by hash of the row key, so a rerun gives the same split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.ordering import group_position, row_index

GRAIN = 1_000_000


def hash_bucket(key: Column | str, buckets: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)).cast("int")


def split_holdout(df: DataFrame, share: float, key: str | None = None, seed: int = 0,
                  bucket: Column | None = None, buckets: int = GRAIN) -> tuple[DataFrame, DataFrame]:
    """(train, test); ``share`` of the buckets is test. Buckets come from the key or a given rule."""
    at = hash_bucket(key, buckets, seed) if bucket is None else bucket
    test = at < int(round(share * buckets))
    return df.filter(~test), df.filter(test)


def shuffle_rows(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Rows in an order that looks random and is the same each time."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key)


def kfold_assign(df: DataFrame, folds: int, key: str | None = None, seed: int = 0,
                 bucket: Column | None = None, name: str = "fold") -> DataFrame:
    at = hash_bucket(key, folds, seed) if bucket is None else F.pmod(bucket, F.lit(folds)).cast("int")
    return df.withColumn(name, at)


def kfold_stratified(df: DataFrame, folds: int, label: str, order: list[str], name: str = "fold") -> DataFrame:
    """Deal the rows of each class to the folds in turn."""
    placed = group_position(df, [label], order, "_nth")
    return placed.withColumn(name, ((F.col("_nth") - 1) % folds).cast("int")).drop("_nth")


def leave_one_out(df: DataFrame, order: list[str], name: str = "fold") -> DataFrame:
    return row_index(df, order, name)
