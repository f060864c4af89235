"""Exact deduplication against a persistent digest index.

The index is a parquet table bucketed and sorted by the SHA-256 digest of the
text without white space. A batch is reduced to one candidate per digest
(combined before the shuffle, so a text that is a third of all rows is one row
of each map task), the candidates are anti-joined with the index by a
sort-merge join that needs no shuffle of the index, and what is new is appended.

Defined results: a null text is the empty text, and empty texts equal each
other. Of equal texts in a batch the one with the most code points stays, then
the smallest doc_id (null last), then one of the repeated rows. A text that an
earlier batch has put in the index keeps its first holder: the whole group of
the new batch is dropped in its favour. ``group_size`` counts the rows of the
batch. An empty batch leaves the index as it is and gives no rows. Other
columns of the input are ignored by ``add`` and handed through by ``distinct``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fresh_path, packed_rows, stage, text_of, unpacked_rows, without_spaces

INDEX_SCHEMA = "digest binary, holder bigint, n_chars bigint, batch string"
ROWS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 8
LAYOUT = "buckets int"


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def digest_of(text):
    return F.unhex(F.sha2(without_spaces(text).cast("binary"), 256))


class DigestIndex:
    """One bucketed, sorted table of digests; ``open`` finds it again in a later session."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, expected_rows: int = 0) -> DigestIndex:
        """An empty index at ``path`` (a new folder below the shared one if none is given)."""
        return cls._declare(spark, path or fresh_path(spark, "digests"), buckets_for(expected_rows), new=True)

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """The index that was created at ``path``, with the bucket number kept there; another number is refused."""
        stored = spark.read.schema(LAYOUT).parquet(f"{path}/_layout").first()["buckets"]
        if buckets not in (None, stored):
            raise ValueError(f"the index at {path} has {stored} buckets, not {buckets}")
        return cls._declare(spark, path, stored, new=False)

    @classmethod
    def _declare(cls, spark: SparkSession, path: str, buckets: int, new: bool) -> DigestIndex:
        """Declare the table over its folder; a new one keeps its bucket number beside the rows, where a table's reader doesn't look."""
        if new:
            spark.createDataFrame([(buckets,)], LAYOUT).coalesce(1).write.parquet(f"{path}/_layout")
        table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {table} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        index = cls(spark, table)
        index.buckets, index.path = buckets, path
        return index

    def close(self) -> None:
        """Take the table's name out of the catalogue; its folder stays and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rebucket(self, path: str | None = None) -> DigestIndex:
        """The same digests in a new folder, with buckets for their number; this index is closed."""
        rows = self.rows()
        grown = self.create(self.spark, path, rows.count())
        grown._append(rows)
        self.close()
        return grown

    def _append(self, rows: DataFrame) -> None:
        (
            rows.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.table)
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str) -> DataFrame:
        """Append the digests that are new and say for each row of ``docs`` what became of it.

        A batch that is run again under its name adds nothing and gives the same rows.
        """
        rows = stage(
            docs.select("doc_id", text_of().alias("text")).select(
                "doc_id",
                F.length("text").cast("bigint").alias("n_chars"),
                digest_of(F.col("text")).alias("digest"),
                F.monotonically_increasing_id().alias("row_id"),
            ),
            "digest-rows",
        )
        first = F.struct((-F.col("n_chars")).alias("o"), F.isnull("doc_id").alias("u"), "doc_id", "row_id")
        groups = stage(
            rows.groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size")),
            "digest-groups",
        )
        fresh = groups.join(self.rows().hint("merge").select("digest"), "digest", "left_anti").select(
            "digest",
            F.col("first.doc_id").alias("holder"),
            (-F.col("first.o")).alias("n_chars"),
            F.lit(batch).alias("batch"),
        )
        self._append(fresh)
        held = self.rows().hint("merge").select("digest", "holder", "batch")
        verdicts = groups.join(held, "digest").select(
            "digest",
            F.col("holder").alias("keep_id"),
            "group_size",
            F.when(F.col("batch") == batch, F.col("first.row_id")).alias("keep_row"),
        )
        # Read back, both sides are plain exchanges, so that a hot digest's rows can be split among tasks.
        verdicts = stage(verdicts, "digest-verdicts")
        return rows.join(verdicts, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row_id") == F.col("keep_row"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "n_chars",
        )


def deduplicate(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with their fate, against an index that starts empty."""
    index = DigestIndex.create(docs.sparkSession, expected_rows=docs.count())
    found = index.add(docs, "first")  # reads staged rows only
    index.close()
    return found


def distinct(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched to the decision by digest, length and id. Only rows that
    are repeated under one id, which this match cannot tell apart, are combined
    by their digest afterwards.
    """
    verdicts = (
        deduplicate(docs)
        .groupBy("text_sha256", "n_chars", F.col("doc_id").alias("keep_id"))
        .agg(F.max("kept").alias("holds"), (F.count(F.lit(1)) > 1).alias("repeated"))
        .filter("holds")
    )
    rows = packed_rows(docs).select("row", text_of(F.col("row.text")).alias("text"))
    rows = rows.select(
        "row",
        F.lower(F.hex(digest_of(F.col("text")))).alias("sha"),
        F.length("text").cast("bigint").alias("length"),
    )
    kept = rows.join(
        verdicts,
        (F.col("sha") == F.col("text_sha256"))
        & F.col("row.doc_id").eqNullSafe(F.col("keep_id"))
        & (F.col("length") == F.col("n_chars")),
    )
    once = kept.filter("NOT repeated").select("row")
    combined = kept.filter("repeated").groupBy("sha").agg(F.first("row").alias("row")).select("row")
    return unpacked_rows(once.unionByName(combined))
