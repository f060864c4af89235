"""Database tables read in parallel ranges and written in batches.

Each task opens its own connection, so the database must be one all executors
can reach; an in-process database is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str, table: str, partition_column: str, low: int, high: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a read split into ranges of a numeric column, fetched in bounded blocks."""
    if partitions < 1 or high <= low:
        raise ValueError("a partitioned read needs low < high and at least one partition")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_table(spark: SparkSession, url: str, table: str, partition_column: str, low: int, high: int, partitions: int) -> DataFrame:
    options = read_options(url, table, partition_column, low, high, partitions)
    return spark.read.format("jdbc").options(**options).load()


def read_query(spark: SparkSession, url: str, query: str, fetch_size: int = 10_000) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=query, fetchsize=str(fetch_size)).load()


def write_table(df: DataFrame, url: str, table: str, batch_size: int = 10_000, connections: int = 16, mode: str = "append") -> None:
    """Bulk insert: ``batch_size`` rows per call, at most ``connections`` writers."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections)}
    df.write.format("jdbc").options(**options).mode(mode).save()
