"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scale(vector: Column, factor: float) -> Column:
    return F.transform(vector, lambda x: x * factor)


def add(a: Column, b: Column) -> Column:
    """Element-wise sum; different lengths are an error."""
    wrong = F.raise_error(F.lit("vectors differ in length")).cast("array<double>")
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: x + y)).otherwise(wrong)


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def mean(vector: Column) -> Column:
    return total(vector) / F.size(vector)


def std(vector: Column) -> Column:
    """Population deviation."""
    m = mean(vector)
    return F.sqrt(total(F.transform(vector, lambda x: (x - m) * (x - m))) / F.size(vector))


def gather(vector: Column, positions: Column) -> Column:
    """Elements at the given positions (from 0); a position past the end gives null."""
    return F.transform(positions, lambda i: F.get(vector, i))


def transpose(matrix: Column) -> Column:
    """Rows to columns of a rectangular array of arrays."""
    return F.transform(
        F.sequence(F.lit(0), F.size(F.get(matrix, F.lit(0))) - 1), lambda j: F.transform(matrix, lambda row: F.get(row, j))
    )


def by_position(df: DataFrame, vector: str) -> DataFrame:
    """Sum, mean, deviation, extremes per position over all rows."""
    return (
        df.select(F.posexplode(vector).alias("pos", "x"))
        .groupBy("pos")
        .agg(
            F.sum("x").alias("total"),
            F.avg("x").alias("mean"),
            F.stddev_pop("x").alias("std"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
        )
    )
