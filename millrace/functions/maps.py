"""Lookups, subsets and merges of map columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def get(m: Column, key: str, default) -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


def subset(m: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: k.isin(list(keys)))


def first_n(m: Column, n: int) -> Column:
    """The first n entries by key; maps have no order of their own."""
    return F.map_from_entries(F.slice(F.array_sort(F.map_entries(m)), 1, n))


def merge(older: Column, newer: Column) -> Column:
    """Union of two maps; for a key in both the newer value wins."""
    kept = F.map_filter(older, lambda k, _: ~F.map_contains_key(newer, k))
    return F.map_concat(kept, newer)


def invert(df: DataFrame, key: str, m: str) -> DataFrame:
    """Values to keys; of several keys with one value the largest wins."""
    pairs = df.select(key, F.explode(m).alias("_k", "_v")).groupBy(key, "_v").agg(F.max("_k").alias("_k"))
    return pairs.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_v", "_k"))).alias("inverted"))


def from_records(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """One map per group; a key that occurs twice in a group is an error."""
    pairs = df.groupBy(group, key).agg(F.max(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit("duplicate key "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(message).cast(df.schema[key].dataType))
    return pairs.withColumn("_k", checked).groupBy(group).agg(
        F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("lookup")
    )
