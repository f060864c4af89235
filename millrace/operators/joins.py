"""Joins beyond the plain ``DataFrame.join``: key checks, lookups, alignment."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import global_index
from millrace.operators.skew import spread_join
from millrace.session import fresh_path


class JoinKeyError(ValueError):
    """The join keys do not have the promised shape."""


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns a natural join would use; having none is an error, not a cross product."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise JoinKeyError(f"no shared column between {left.columns} and {right.columns}")
    return shared


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    return left.join(right, shared_columns(left, right), how)


def join_on(left: DataFrame, right: DataFrame, pairs: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join with different key names on the two sides; both keys stay."""
    for a, b in pairs.items():
        if a not in left.columns or b not in right.columns:
            raise JoinKeyError(f"join key {a!r} = {b!r} is missing")
    condition = F.lit(True)
    for a, b in pairs.items():
        condition &= left[a] == right[b]
    return left.join(right, condition, how)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def validated_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    validate: str = "many_to_one",
) -> DataFrame:
    """Join after checking which side has unique keys, so a fan-out cannot go unseen."""
    one = {"one_to_one": (left, right), "many_to_one": (right,), "one_to_many": (left,), "many_to_many": ()}
    if validate not in one:
        raise ValueError(f"unknown validate mode {validate!r}")
    for side in one[validate]:
        worst = duplicate_keys(side, on).limit(1).collect()
        if worst:
            raise JoinKeyError(f"{validate}: key {tuple(worst[0][k] for k in on)} occurs {worst[0]['copies']} times")
    return spread_join(left, right, on, how)


def store_sorted(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a frame in buckets of its keys, one sorted file each, and read it back as such.

    Frames stored with the same keys and number of buckets join without moving or
    sorting a row. Choose buckets so that one fits a task (``buckets_for``); each key
    lies in one bucket, so this is for keys with few rows each.
    """
    spark, name = df.sparkSession, f"sorted_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.option("path", fresh_path(spark, "sorted"))
    dealt.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    stored = spark.table(name).select("*")
    # the frame holds the place and layout of the files, so the catalogue need not keep the name
    spark.sql(f"DROP TABLE {name}")
    return stored


def merge_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Merge join of two frames from ``store_sorted``: both are read in order, side by side."""
    return left.hint("merge").join(right, list(keys), how)


def member_of(df: DataFrame, column: str, allowed: DataFrame, allowed_column: str, negate: bool = False) -> DataFrame:
    """Rows whose value is (not) in the reference set; a null is never a member."""
    how = "left_anti" if negate else "left_semi"
    return df.join(allowed, df[column] == allowed[allowed_column], how)


def map_with_default(df: DataFrame, column: str, mapping: Mapping, default, out: str) -> DataFrame:
    """Replace codes by labels from a small dictionary; unknown codes give ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), F.col(column))
    return df.withColumn(out, F.when(F.col(column).isNotNull(), F.coalesce(found, F.lit(default))).otherwise(default))


def lookup(df: DataFrame, column: str, table: DataFrame, key: str, value: str, default, out: str) -> DataFrame:
    """Like ``map_with_default`` for a mapping that lives in a table with unique keys."""
    side = table.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(side, F.col(column) == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce("_value", F.lit(default))).drop("_key", "_value")


def aligned_add(left: DataFrame, right: DataFrame, key: str, value: str, out: str, fill=None) -> DataFrame:
    """Add two keyed series; a key on one side only gives null unless ``fill`` is set."""
    a, b = left.select(key, F.col(value).alias("_a")), right.select(key, F.col(value).alias("_b"))
    x, y = F.col("_a"), F.col("_b")
    if fill is not None:
        x, y = F.coalesce(x, F.lit(fill)), F.coalesce(y, F.lit(fill))
    return a.join(b, key, "outer").select(key, (x + y).alias(out))


def zip_rows(
    left: DataFrame, right: DataFrame, left_order: Sequence[str | Column], right_order: Sequence[str | Column]
) -> DataFrame:
    """Pair rows by position, as long as both sides have one."""
    return global_index(left, left_order).join(global_index(right, right_order), "idx")


def product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every row of one side with every row of the other; the output is the product of both.

    The planner sends the smaller side to all tasks if its size allows, and pairs partitions otherwise.
    """
    return left.crossJoin(right)
