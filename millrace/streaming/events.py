"""Event streams from files, and sinks that may receive a micro-batch twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.load import replace_partitions
from millrace.session import fresh_path

EPOCH = "epoch"


def stream_files(
    spark: SparkSession, path: str, schema, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """An unbounded table of the files that arrive in a folder, with a declared schema.

    ``files_per_batch`` bounds a micro-batch; without it a batch takes all that has arrived.
    """
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; the session's zone is UTC."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def rate_source(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """An endless generated stream for load tests."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def run_batches(
    stream: DataFrame, consume: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Feed everything that has arrived to ``consume``, micro-batch by micro-batch, then stop.

    The checkpoint remembers what was consumed, so the next run goes on from there.
    """
    query = (
        stream.writeStream.foreachBatch(consume)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def epoch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch as its own partition: a repeated batch replaces itself."""

    def consume(batch: DataFrame, epoch: int) -> None:
        replace_partitions(batch.withColumn(EPOCH, F.lit(epoch)), path, [EPOCH])

    return consume


def run_arrivals(
    df: DataFrame,
    slices: Sequence[Column],
    build: Callable[[DataFrame], DataFrame],
    consume: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> None:
    """Let the slices of ``df`` arrive as files one after the other, and consume each on arrival.

    Every run is a new query that goes on from the checkpoint of the one before.
    """
    spark = df.sparkSession
    path, checkpoint = fresh_path(spark, "arrivals"), fresh_path(spark, "checkpoint")
    for part in slices:
        df.filter(part).write.mode("append").parquet(path)
        run_batches(build(stream_files(spark, path, df.schema)), consume, checkpoint, mode)


def collect_arrivals(
    df: DataFrame, slices: Sequence[Column], build: Callable[[DataFrame], DataFrame], schema: str, mode: str = "append"
) -> DataFrame:
    """What a stream over arriving slices emits, with the epoch of each row."""
    path = fresh_path(df.sparkSession, "stream")
    run_arrivals(df, slices, build, epoch_sink(path), mode)
    return df.sparkSession.read.schema(f"{schema}, {EPOCH} int").parquet(path)


def latest(emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last emitted row per key of a stream in update mode."""
    others = [c for c in emitted.columns if c not in (*keys, EPOCH)]
    return emitted.groupBy(*keys).agg(F.max_by(F.struct(*others), EPOCH).alias("_r")).select(*keys, "_r.*")

