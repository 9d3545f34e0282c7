"""Reading, writing and building tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tablecraft.plans.lineage import materialize
from tablecraft.plans.ordering import row_index

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, multiline: bool = False) -> DataFrame:
    """CSV with a header. Give a schema: inference reads the whole file twice.

    NaN in floating columns becomes NULL, the only missing value used here. Set
    ``multiline`` only for texts with line breaks: such a file cannot be split.
    """
    reader = spark.read.option("header", True).option("timestampFormat", STAMP)
    reader = reader.option("escape", '"').option("multiLine", multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return nan_to_null(reader.csv(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def sink_csv(df: DataFrame, path: str) -> None:
    """Write a header and rows, no row number; one file per partition."""
    (df.write.mode("errorifexists").option("header", True).option("timestampFormat", STAMP)
     .option("escape", '"').csv(path))


def from_columns(columns: dict[str, DataFrame], key: str) -> DataFrame:
    """One table from keyed columns; a key missing from a column gives NULL there."""
    parts = [df.select(key, F.col([c for c in df.columns if c != key][0]).alias(name))
             for name, df in columns.items()]
    return reduce(lambda a, b: a.join(b, key, "full_outer"), parts)


def from_product(levels: list[DataFrame]) -> DataFrame:
    """Every combination of the distinct values of one-column tables.

    Combination number i is decoded into one level position per table, so the work
    is a distributed range plus equi-joins on positions that occur equally often;
    a level table is broadcast only after counting it.
    """
    spark = levels[0].sparkSession
    indexed, sizes = [], []
    for n, level in enumerate(levels):
        name = level.columns[0]
        values = materialize(row_index(level.distinct(), [name], f"_at{n}"))
        indexed.append(values)
        sizes.append(values.count())
    total = reduce(lambda a, b: a * b, sizes, 1)
    rows = spark.range(total)
    step = total
    for n, size in enumerate(sizes):
        step = step // size if size else 0
        rows = rows.withColumn(f"_at{n}", F.expr(f"(id div {step}L) % {size}L") if step else F.lit(0))
    for n, (values, size) in enumerate(zip(indexed, sizes)):
        rows = rows.join(values, f"_at{n}")
    return rows.select(*[level.columns[0] for level in levels])


def number_sequence(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "n") -> DataFrame:
    """start, start + step, ... before stop."""
    return spark.range(start, stop, step).withColumnRenamed("id", name)


def even_spaced(spark: SparkSession, low: float, high: float, count: int, name: str = "x") -> DataFrame:
    """``count`` values from low to high, both ends included."""
    width = (high - low) / (count - 1) if count > 1 else 0.0
    return spark.range(count).select((F.lit(low) + F.col("id") * F.lit(width)).alias(name))


PRIME = 2147483647


def _draw(key: str, seed: int) -> Column:
    """A whole number below ``PRIME`` from an integer key: two rounds of squaring, which 64 bits hold exactly."""
    first = (F.pmod(F.col(key).cast("long"), F.lit(PRIME)) * 48271 + seed) % PRIME
    second = (first * first + seed) % PRIME
    third = (second * 48271 + first) % PRIME
    return (third * third + second) % PRIME


def random_columns(df: DataFrame, key: str, seed: int, below: int = 10) -> DataFrame:
    """Add seeded uniform, normal and integer columns that depend on the row's key alone.

    The same key gives the same values however the rows are partitioned, and when a task runs again.
    """
    share = [_draw(key, seed + i) / F.lit(float(PRIME)) for i in range(4)]
    return df.withColumns({
        "uniform": share[0], "normal": F.sqrt(-2 * F.log(1 - share[1])) * F.cos(2 * math.pi * share[2]),
        "integer": F.floor(share[3] * below)})
