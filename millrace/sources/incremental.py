"""Incremental extracts that start after a stored high-water mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "source string, mark string, id string"


def save_mark(df: DataFrame, path: str, source: str, column: str, key: str) -> None:
    """Store the newest value of ``column`` with the keys that were seen at it, a row for each key.

    An empty frame stores nothing. Only rows at the mark itself are listed.
    """
    newest = df.agg(F.max(column).alias("m"))
    at_mark = df.join(newest, F.col(column) == F.col("m")).select(F.col("m").cast("string").alias("mark"), F.col(key).cast("string").alias("id"))
    at_mark.distinct().select(F.lit(source).alias("source"), "mark", "id").write.mode("append").parquet(path)


def last_mark(spark: SparkSession, path: str, source: str) -> tuple[str, DataFrame] | None:
    """The largest mark saved for the source (marks are ISO texts, which sort by time) and the table of all keys seen at it."""
    own = spark.read.schema(MARKS).parquet(path).filter(F.col("source") == source)
    mark = own.agg(F.max("mark").alias("mark")).first()["mark"]
    return None if mark is None else (mark, own.filter(F.col("mark") == mark).select("id"))


def read_mark(spark: SparkSession, path: str, source: str) -> tuple[str, list[str]] | None:
    """``last_mark`` with its keys as a list on the driver, for a look at marks that few rows share."""
    last = last_mark(spark, path, source)
    return None if last is None else (last[0], [r["id"] for r in last[1].filter("id is not null").distinct().collect()])


def since(df: DataFrame, column: str, key: str, mark: tuple[str, DataFrame | list[str]] | None) -> DataFrame:
    """Rows newer than the mark, and rows at the mark whose key was not seen there.

    The comparison is pushed into the scan. A row that comes later with the mark's own time is not lost.
    """
    if mark is None:
        return df
    at, seen = F.lit(mark[0]).cast(df.schema[column].dataType), mark[1]
    if not isinstance(seen, DataFrame):
        seen = df.sparkSession.createDataFrame([(x,) for x in seen], "id string")
    known = seen.select(F.col("id").alias("_seen"))
    newer = df.filter(F.col(column) >= at)
    return newer.join(known, (F.col(key).cast("string") == F.col("_seen")) & (F.col(column) == at), "left_anti")


def write_hours(df: DataFrame, path: str, column: str) -> None:
    """Append an extract below ``day=.../hour=..``, so that one hour is one prefix."""
    at = F.col(column)
    placed = df.withColumn("day", F.date_format(at, "yyyy-MM-dd")).withColumn("hour", F.date_format(at, "HH"))
    placed.hint("rebalance", "day", "hour").write.mode("append").partitionBy("day", "hour").parquet(path)


def read_hour(spark: SparkSession, path: str, schema: str, day: str, hour: int) -> DataFrame:
    """The rows of one hour; nothing outside its prefix is listed. An hour without a prefix has no rows."""
    prefix = f"{path}/day={day}/hour={hour:02d}"
    place = spark._jvm.org.apache.hadoop.fs.Path(prefix)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(prefix)
