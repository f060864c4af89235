"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import ensure_settings, fresh_path, stage
from millrace.tables import load

#: The six ASCII white-space characters of the class [\x20\x09-\x0D].
SPACES = (" ", "\t", "\n", "\x0b", "\f", "\r")
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(ensure_settings(spark), sf_dir, "documents")


def text_of(column: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def without_spaces(text: Column) -> Column:
    """Delete white space by plain byte replacement, which needs no regular expression."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    Expressions inside lambda functions are not shared by the planner, so a
    value used twice would be computed twice; a one-element array binds it.
    """
    return F.transform(F.array(value), body)[0]


def map_batches(df: DataFrame, fn: Callable[[Iterable], Iterable], schema: str) -> DataFrame:
    """``mapInArrow`` with the schema as text."""
    return df.mapInArrow(fn, schema)


def packed_rows(docs: DataFrame) -> DataFrame:
    """One column ``row`` holding all columns, so that no name of theirs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked_rows(df: DataFrame) -> DataFrame:
    """The columns that ``packed_rows`` has put away, in their order."""
    fields = df.schema["row"].dataType.fieldNames()
    return df.select(*[F.col("row").getField(f).alias(f) for f in fields])


__all__ = [
    "SPACES",
    "SPACE_RUN",
    "bind",
    "documents",
    "fresh_path",
    "load",
    "map_batches",
    "packed_rows",
    "stage",
    "text_of",
    "unpacked_rows",
    "without_spaces",
]
