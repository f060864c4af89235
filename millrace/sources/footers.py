"""Profile of parquet files from their footers, read where the tasks run."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COLUMNS = (
    "column string, file_path string, n_rows bigint, encodings string, compressed bigint, uncompressed bigint, "
    "low string, high string"
)


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        for location in batch["file_path"]:
            filesystem, path = fs.FileSystem.from_uri(location)
            meta = pq.read_metadata(path, filesystem=filesystem)
            rows = []
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for i in range(group.num_columns):
                    chunk = group.column(i)
                    stats = chunk.statistics
                    known = stats is not None and stats.has_min_max
                    rows.append(
                        (
                            chunk.path_in_schema,
                            location,
                            group.num_rows,
                            ",".join(sorted(chunk.encodings)),
                            chunk.total_compressed_size,
                            chunk.total_uncompressed_size,
                            str(stats.min) if known else None,
                            str(stats.max) if known else None,
                        )
                    )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])


def column_chunks(df: DataFrame) -> DataFrame:
    """One row per column chunk of the files behind a parquet frame."""
    files = df.inputFiles()
    spark = df.sparkSession
    # Without a shuffle that adaptive execution could merge again: one task per file, at most ten thousand.
    paths = spark.createDataFrame([(f,) for f in files], "file_path string") if files else spark.createDataFrame([], "file_path string")
    return paths.repartition(max(1, min(len(files), 10_000))).mapInPandas(_footers, COLUMNS)


def footer_profile(df: DataFrame) -> DataFrame:
    """Rows, bytes, encodings, least and largest value as text, and share of all compressed bytes per column.

    The extremes are those of the footers' own values, compared as numbers where they are numbers.
    """
    chunks = column_chunks(df)
    per_column = chunks.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("compressed").alias("compressed"),
        F.sum("uncompressed").alias("uncompressed"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("encodings", ","))))), ",").alias(
            "encodings"
        ),
        F.min_by("low", F.struct(F.col("low").try_cast("double"), "low")).alias("low"),
        F.max_by("high", F.struct(F.col("high").try_cast("double"), "high")).alias("high"),
    )
    # one row per column of the table, so a window over all of them is small
    whole = F.sum("compressed").over(Window.partitionBy())
    return per_column.withColumn("share", F.col("compressed") / whole)


def subset_share(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of the compressed bytes a read of only these columns would touch."""
    return profile.filter(F.col("column").isin(list(columns))).agg(F.sum("share").alias("share"))


def zone_map(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A row per file behind a parquet frame: its rows, its bytes, and ``low_x`` and ``high_x`` of the given columns.

    Bounds have the columns' types. They are null where a row group has none, and such a file always matches.
    """
    chunks = column_chunks(df)

    def bound(name: str, side: str, extreme) -> Column:
        own = F.col("column") == name
        unknown = F.count_if(own & F.col(side).isNull())
        value = extreme(F.when(own, F.col(side).cast(df.schema[name].dataType)))
        return F.when(unknown == 0, value).alias(f"{side}_{name}")

    bounds = [bound(c, *side) for c in columns for side in (("low", F.min), ("high", F.max))]
    rows = F.sum(F.when(F.col("column") == columns[0], F.col("n_rows"))).alias("n_rows")
    return chunks.groupBy("file_path").agg(rows, F.sum("compressed").alias("bytes"), *bounds)


def matching(zones: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """The files that can hold rows within all ``ranges`` (column to least and largest value)."""
    for name, (least, most) in ranges.items():
        low, high = F.col(f"low_{name}"), F.col(f"high_{name}")
        zones = zones.filter(low.isNull() | high.isNull() | ((high >= F.lit(least)) & (low <= F.lit(most))))
    return zones


def read_within(spark: SparkSession, schema, zones: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Rows within all ``ranges``; only the files that the zone map leaves are opened.

    Their paths go through the driver, as those of any table that Spark reads.
    """
    files = [r["file_path"] for r in matching(zones, ranges).select("file_path").toLocalIterator()]
    found = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for name, (least, most) in ranges.items():
        found = found.filter(F.col(name).between(F.lit(least), F.lit(most)))
    return found
