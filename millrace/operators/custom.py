"""User-defined code: by column, by partition, by group, one row to many."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.operators.skew import salt_of

Step = Callable[[DataFrame], DataFrame]
#: Rows of a user's function that are handed on together.
ROWS_OUT = 10_000


def column_function(function: Callable[[pd.Series], pd.Series], kind: str) -> Callable[[Column], Column]:
    """A vectorised function of one column, for logic that no expression can state."""
    return F.pandas_udf(function, kind)


def arrow_function(function: Callable[[pa.Array], pa.Array], kind: str) -> Callable[[Column], Column]:
    """The same for a function of Arrow columns: a block of long texts need not become a Python object for each text."""
    return F.arrow_udf(function, kind)


def map_partitions(df: DataFrame, setup: Callable[[], object], function: Callable, schema: str) -> DataFrame:
    """Apply ``function(resource, frame)`` to blocks of rows; ``setup`` runs once per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        for batch in batches:
            yield function(resource, batch)

    return df.mapInPandas(run, schema)


def group_combine(
    df: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    combine: Sequence[Column],
    blocks: int = 64,
) -> DataFrame:
    """Split-apply-combine with a function that is declared to be mergeable.

    Every group, that of null keys too, is dealt over ``blocks`` by the row's own
    values; ``partial`` sees one block of a group and ``combine`` merges what it
    gives, so the result doesn't depend on how large a group is.
    """
    dealt = df.withColumn("_block", salt_of(row_id, blocks))
    parts = dealt.groupBy(*keys, "_block").applyInPandas(lambda pdf: partial(pdf.drop(columns="_block")), schema)
    return parts.groupBy(*keys).agg(*combine)


def _slices(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Sorted batches cut where a key changes, with the key of each slice; null and NaN are keys of their own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            column = batch.column(k)
            if pa.types.is_floating(column.type):
                column = pc.if_else(pc.is_nan(column), pa.scalar("nan"), column.cast(pa.string()))
            here, before = column.slice(1), column.slice(0, len(column) - 1)
            other = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before)))
            changed |= other.to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for start, stop in zip(starts, starts[1:], strict=False):
            key = tuple(batch.column(k)[start].as_py() for k in keys)
            yield tuple("nan" if x != x else x for x in key), batch.slice(start, stop - start)


def group_stream(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], function: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], schema: str
) -> DataFrame:
    """Split-apply-combine with any function; each call gets one whole group as a stream.

    ``function`` gets an iterator over Arrow batches of the group, sorted by ``order``,
    and gives rows of ``schema``. Spark sorts on disk, and no group is ever held as a
    whole, so a function that keeps little works on groups of any length. What it
    leaves unread is passed over. Rows of null keys are one group.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for _, group in groupby(_slices(batches, keys), key=lambda part: part[0]):
            yield from function(part for _, part in group)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = rows(batches)
        while block := list(islice(found, ROWS_OUT)):
            columns = zip(*block, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    by_key = df.repartition(*keys) if keys else df.coalesce(1)
    return by_key.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def words(df: DataFrame, text: str, pattern: str = r"[\p{L}\p{M}]+") -> DataFrame:
    """One row per word with its position, letters of any language; a text without words gives one row of nulls."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return df.select("*", F.posexplode_outer(found).alias("pos", "word"))


def run_steps(df: DataFrame, *steps: Step) -> DataFrame:
    """Apply steps from left to right."""
    for step in steps:
        df = df.transform(step)
    return df
