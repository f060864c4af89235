"""Grouping, collecting and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import exact_quantiles


def group_by(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], null_keys: str = "keep") -> DataFrame:
    """Grouped aggregates; ``null_keys="drop"`` leaves groups with a null key out."""
    if null_keys == "drop":
        df = df.na.drop(subset=list(keys))
    return df.groupBy(*keys).agg(*aggs)


def money_sum(column: str | Column) -> Column:
    """Sum of two-decimal amounts, free of the noise of the summing order."""
    return F.round(F.sum(column), 2)


def money_avg(column: str | Column) -> Column:
    return money_sum(column) / F.count(column)


def global_reduce(df: DataFrame, column: str, initial: float = 0.0) -> DataFrame:
    """Sum, product and maximum over all rows with a start value; safe on no rows."""
    return df.agg(
        (F.coalesce(F.sum(column), F.lit(0.0)) + initial).alias("total"),
        F.coalesce(F.product(F.col(column)), F.lit(1.0)).alias("product"),
        F.greatest(F.max(column), F.lit(initial)).alias("largest"),
    )


def top_record(df: DataFrame, by: str, first: str) -> DataFrame:
    """The whole record with the largest ``by``; on ties the smallest ``first``."""
    best = F.max_by(F.struct(*df.columns), F.struct(F.col(by), (-F.col(first)).alias("_first")))
    return df.agg(best.alias("r")).filter("r is not null").select("r.*")


def collect_groups(df: DataFrame, keys: Sequence[str], value: str, page: Column) -> DataFrame:
    """Members of each group as sorted arrays, in pages so that no array is unbounded.

    ``page`` must put a bounded number of distinct values on a page, e.g. a range of ids.
    """
    return (
        df.withColumn("page", page)
        .groupBy(*keys, "page")
        .agg(F.array_sort(F.collect_list(value)).alias("members"))
    )


def pivot_sum(df: DataFrame, rows: str, columns: str, values: Sequence[str], value: str) -> DataFrame:
    """Rows by columns with sums; the listed column values make it one pass, gaps are 0."""
    wide = df.groupBy(rows).pivot(columns, list(values)).agg(money_sum(value))
    return wide.na.fill(0.0, subset=list(values))


def unpivot_row(row: DataFrame, fields: Mapping[str, Mapping[str, str]], name: str = "column") -> DataFrame:
    """Turn a one-row table of statistics into one row per column."""
    structs = [
        F.struct(F.lit(column).alias(name), *[F.col(f"`{src}`").alias(out) for out, src in stats.items()])
        for column, stats in fields.items()
    ]
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """max - min per column, one row per column, in one pass."""
    row = df.agg(*[(F.max(c) - F.min(c)).alias(c) for c in columns])
    return unpivot_row(row, {c: {"value_range": c} for c in columns})


def row_argmax(columns: Sequence[str]) -> Column:
    """Name of the column holding the row's largest value, the first one on ties."""
    ranked = [F.struct(F.col(c).alias("v"), F.lit(-i).alias("i"), F.lit(c).alias("name")) for i, c in enumerate(columns)]
    return F.array_max(F.array(*ranked))["name"]


def first_look(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """One row per column: position, type, rows, known values, and the texts of the first and last ``n`` rows by ``order``.

    Three scans whatever the number of columns: one that counts, and one each for the
    first and last rows, of which every task keeps ``n``. ``order`` should tell the rows apart.
    """
    texts = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])
    rows = df.select(F.struct(*order).alias("_o"), texts.alias("_t"))
    ends = {"_head": F.asc("_o"), "_tail": F.desc("_o")}
    edges = [
        rows.orderBy(place).limit(n).agg(F.sort_array(F.collect_list(F.struct("_o", "_t")))).scalar().alias(name)
        for name, place in ends.items()
    ]
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_k_{c}") for c in df.columns])
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_n").alias("n_rows"),
            F.col(f"_k_{f.name}").alias("n_known"),
            F.col("_head._t").getField(f.name).alias("head"),
            F.col("_tail._t").getField(f.name).alias("tail"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select("*", *edges).select(F.inline(F.array(*cells)))


def profile(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Count, nulls, mean, deviation, quartiles and extremes per numeric column, and
    count, nulls, distinct, most common value and its frequency per text column.

    All numeric columns are one scan, and so are all text columns; the quartiles are
    found by narrowing and scan again.
    """
    out = None
    if numeric:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in numeric]
        long = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
        out = long.groupBy("column").agg(
            F.count("v").alias("n"),
            F.count_if(F.col("v").isNull()).alias("nulls"),
            F.avg("v").alias("mean"),
            F.stddev_samp("v").alias("std"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        )
        quartiles = exact_quantiles(long, ["column"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
        out = out.join(quartiles.drop("n"), "column", "left")
    if text:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in text]
        counts = df.select(F.explode(F.array(*cells)).alias("_c")).groupBy("_c.column", "_c.v").agg(F.count(F.lit(1)).alias("k"))
        known = F.when(F.col("v").isNotNull(), F.col("k"))
        best = F.min(F.when(F.col("v").isNotNull(), F.struct((-F.col("k")).alias("k"), F.col("v"))))
        texts = counts.groupBy("column").agg(
            F.coalesce(F.sum(known), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("k"))), F.lit(0)).alias("nulls"),
            F.count("v").alias("n_unique"),
            best.alias("best"),
        ).select("column", "n", "nulls", "n_unique", F.col("best.v").alias("top"), (-F.col("best.k")).alias("freq"))
        out = texts if out is None else out.unionByName(texts, allowMissingColumns=True)
    return out
