"""Set comparison, concatenation and deduplication.

First/last rows per key come from ``min_by``/``max_by`` aggregates, which combine
on the map side, so a key with very many copies does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import global_index
from millrace.operators.skew import same_keys


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on exactly one side, with the side they are on."""
    a = left.select(key).distinct().withColumn("side", F.lit("left"))
    b = right.select(key).distinct().withColumn("side", F.lit("right"))
    return a.unionByName(b).groupBy(key).agg(F.min("side").alias("side"), F.count(F.lit(1)).alias("_n")).filter(
        "_n = 1"
    ).drop("_n")


def set_relations(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: is left a subset, a superset, disjoint from or equal to right."""
    a = left.select(key).distinct().withColumn("a", F.lit(1)).withColumn("b", F.lit(0))
    b = right.select(key).distinct().withColumn("a", F.lit(0)).withColumn("b", F.lit(1))
    per_key = a.unionByName(b).groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    counts = per_key.agg(
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("l"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("r"),
        F.count_if(F.col("a") == F.col("b")).alias("c"),
    )
    return counts.select(
        (F.col("l") == 0).alias("is_subset"),
        (F.col("r") == 0).alias("is_superset"),
        (F.col("c") == 0).alias("is_disjoint"),
        ((F.col("l") == 0) & (F.col("r") == 0)).alias("is_equal"),
    )


def concat_rows(frames: Sequence[DataFrame], order: Sequence[str], out: str = "row_id") -> DataFrame:
    """Stack tables, keeping duplicates, and number the rows afresh."""
    stacked = None
    for part, df in enumerate(frames):
        df = df.withColumn("_source", F.lit(part))
        stacked = df if stacked is None else stacked.unionByName(df, allowMissingColumns=True)
    return global_index(stacked, ["_source", *order], out).drop("_source")


def dedup_exact(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One copy of each distinct row, whatever the order of its fields."""
    return (df.select(*columns) if columns else df).distinct()


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """The first or last row per key in the given order.

    The filter on the rank becomes a limit per group before the shuffle, so of a hot
    key each task sends one row.
    """
    by = [F.asc(c) if keep == "first" else F.desc(c) for c in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.filter("_rank = 1").drop("_rank")


def dedup_with_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """``dedup`` plus, on each kept row, how many copies were dropped for it."""
    pick = F.min_by if keep == "first" else F.max_by
    row = pick(F.struct(*df.columns), F.struct(*order)).alias("_r")
    grouped = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return grouped.agg(row, (F.count(F.lit(1)) - 1).alias("dropped")).select("_r.*", "dropped")


def mark_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Flags for "a copy of an earlier row", "a copy of a later row" and "has any copy"."""
    place = F.struct(*order)
    ends = (
        df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"), F.max(place).alias("_last"))
        .filter("_n > 1")
    )
    joined = same_keys(df, ends, keys, "_k_")
    copied = F.col("_n").isNotNull()
    return (
        joined.withColumn("dup_keep_first", copied & (place > F.col("_first")))
        .withColumn("dup_keep_last", copied & (place < F.col("_last")))
        .withColumn("dup_all", copied)
        .na.fill(False, subset=["dup_keep_first", "dup_keep_last"])
        .drop("_n", "_first", "_last")
    )
