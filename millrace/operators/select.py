"""Row and column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def label_range(df: DataFrame, key: str, first, last) -> DataFrame:
    """Rows by key label; unlike positions, a label range includes both ends."""
    return df.filter(F.col(key).between(first, last))


def drop_labels(df: DataFrame, key: str, labels: Sequence, columns: Sequence[str] = ()) -> DataFrame:
    """Without the rows with these keys and without these columns."""
    return df.filter(F.col(key).isNull() | ~F.col(key).isin(list(labels))).drop(*columns)


def is_truthy(column: str | Column, kind: T.DataType) -> Column:
    """Python's idea of truth: null, 0, '', false and empty collections are not."""
    c = F.col(column) if isinstance(column, str) else column
    if isinstance(kind, T.BooleanType):
        test = c
    elif isinstance(kind, T.NumericType):
        test = c != 0
    elif isinstance(kind, T.StringType):
        test = F.length(c) > 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def drop_falsy(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_truthy(column, df.schema[column].dataType))


@dataclass(frozen=True)
class RangeStep:
    """A filter step described by configuration; use with ``DataFrame.transform``."""

    column: str
    low: float
    high: float

    @classmethod
    def from_config(cls, config: Mapping) -> RangeStep:
        return cls(config["column"], config["min"], config["max"])

    def in_range(self) -> Column:
        return F.col(self.column).between(self.low, self.high)

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.filter(self.in_range())


def to_columnar(df: DataFrame, order: Sequence[str], batch: Column) -> DataFrame:
    """Records to one row of equal-length arrays per ``batch``, in the given order.

    ``batch`` must bound the records per row; one row for a whole table would not.
    """
    fields = list(dict.fromkeys([*order, *df.columns]))
    rows = F.array_sort(F.collect_list(F.struct(*fields)))
    grouped = df.groupBy(batch.alias("batch")).agg(rows.alias("_rows"))
    return grouped.select("batch", *[F.col(f"_rows.{c}").alias(c) for c in df.columns])


def to_records(columnar: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal-length arrays back to one record per position."""
    return columnar.select("batch", F.posexplode(F.arrays_zip(*columns)).alias("pos", "_r")).select(
        "batch", "pos", "_r.*"
    )


def record_at(columnar: DataFrame, columns: Sequence[str], i: int) -> DataFrame:
    """The i-th record of each columnar row."""
    return columnar.select("batch", *[F.get(c, F.lit(i)).alias(c) for c in columns])
