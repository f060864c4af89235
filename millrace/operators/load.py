"""Loads that may be repeated: partition replacement, upsert, applied-once ledger.

Plain parquet tables have no MERGE, so a change writes the buckets it touches as a
new version, which becomes visible at once. Every step gives the same table when
it runs again, which makes retries safe.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.commits import FOLDER, Conflict, Versions
from millrace.operators.joins import duplicate_keys
from millrace.operators.sets import dedup
from millrace.operators.skew import broadcast_within
from millrace.session import stage

BUCKET = "_bucket"


class LoadRejected(Exception):
    """A batch broke a constraint; the target was not touched."""


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Overwrite exactly the partitions that occur in ``df``; a re-run changes nothing.

    The rebalance hint gives each partition few files, but splits one that is large.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def append(df: DataFrame, path: str, columns: Sequence[str] = ()) -> None:
    """Plain append: running it twice doubles the rows."""
    df.write.mode("append").partitionBy(*columns).parquet(path)


#: Stored bytes of a bucket that the table aims at.
BUCKET_BYTES = 128 << 20
#: A bucket in more pieces, or a table in more folders, is put together by the next change.
MOST_PIECES = 8
MOST_FOLDERS = 32


def stored_bytes(df: DataFrame) -> int:
    """The size of what ``df`` reads, by the planner's estimate (for files, their length)."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # where the planner knows nothing of a source, its rows are counted instead
    return 16 * len(df.columns) * df.count() if size >= 1 << 60 else size


def buckets_for(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets so that each holds about ``bucket_bytes``."""
    return max(1, -(-size // bucket_bytes))


def address(number: Column, buckets: int) -> Column:
    """Linear hashing: the bucket of a hash among ``buckets``, any number.

    With m the largest power of two not above ``buckets``, bucket m + s holds what
    has been split off bucket s. One bucket more moves rows of one bucket only.
    """
    low = 1 << (buckets.bit_length() - 1)
    wide = F.pmod(number, F.lit(2 * low))
    return F.when(wide < buckets, wide).otherwise(F.pmod(number, F.lit(low))).cast("int")


@dataclass(frozen=True)
class KeyedTable:
    """A parquet table with a unique key, stored in hash buckets of that key.

    The number of buckets follows the stored bytes: a change that makes the table
    outgrow its buckets adds some, and only the buckets that are split for them are
    written again, with those that the change touches. A manifest names
    the pieces (folder and bucket) that hold the rows; the pointer names the
    manifest. Changes that find another one committed meanwhile start over from it.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = 1
    bucket_bytes: int = BUCKET_BYTES

    @property
    def versions(self) -> Versions:
        return Versions(self.spark, self.path)

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def _manifest(self, state: dict) -> DataFrame:
        """A row per piece: its folder, bucket, rows and bytes."""
        schema = f"{FOLDER} string, {BUCKET} int, rows bigint, bytes bigint"
        if not state["manifest"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/manifest/{state['manifest']}")

    def _live(self, state: dict, wanted: DataFrame | None = None) -> DataFrame:
        """The table's rows, or those of the buckets in ``wanted``; other pieces are pruned by folder and bucket."""
        pieces = self._manifest(state)
        if wanted is not None:
            pieces = pieces.join(wanted, BUCKET, "left_semi")
        pieces = pieces.filter("rows > 0").select(FOLDER, BUCKET)
        stored = self.versions.read(f"{self.schema}, {BUCKET} int", state["folders"])
        return stored.join(broadcast_within(pieces), [FOLDER, BUCKET], "left_semi").drop(FOLDER, BUCKET)

    def pieces(self) -> DataFrame:
        """Where the rows are: folder, bucket, rows and bytes of each piece."""
        return self._manifest(self.versions.state())

    def read(self) -> DataFrame:
        return self._live(self.versions.state())

    def _untidy(self, state: dict) -> DataFrame:
        """Buckets in too many pieces, and those of the smallest folders if there are too many folders."""
        manifest = self._manifest(state)
        many = manifest.groupBy(BUCKET).count().filter(F.col("count") > MOST_PIECES).select(BUCKET)
        if len(state["folders"]) <= MOST_FOLDERS:
            return many
        sizes = manifest.groupBy(FOLDER).agg(F.sum("bytes").alias("bytes"))
        small = sizes.orderBy("bytes", FOLDER).limit(len(state["folders"]) - MOST_FOLDERS // 2)
        return many.unionByName(manifest.join(small, FOLDER, "left_semi").select(BUCKET)).distinct()

    def _publish(self, state: dict, rows: DataFrame, buckets: int, again: DataFrame | None, load: str | None) -> None:
        """Write ``rows``, then the manifest without the buckets in ``again`` and with the new pieces, then the pointer."""
        placed = rows.withColumn(BUCKET, address(self._hash(), buckets))
        folder = self.versions.write(placed.hint("rebalance", BUCKET), [BUCKET])
        written = self.versions.read(f"{self.schema}, {BUCKET} int", [folder])
        files = written.groupBy(FOLDER, BUCKET, "_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("rows"))
        own = files.groupBy(FOLDER, BUCKET).agg(F.sum("rows").alias("rows"), F.sum("file_size").alias("bytes"))
        kept = self._manifest(state)
        if again is not None:
            kept = kept.join(again, BUCKET, "left_anti")
        name = f"{state['version'] + 1}-{folder}"
        kept.unionByName(own).coalesce(1).write.parquet(f"{self.path}/manifest/{name}")
        # at most MOST_FOLDERS names and one more for each change since the last tidying
        total = self._manifest({"manifest": name}).agg(F.sum("bytes").alias("bytes"), F.collect_set(FOLDER).alias("folders")).first()
        self.versions.commit(
            state["version"] + 1, load, buckets=buckets, manifest=name, folders=sorted(total["folders"]), bytes=total["bytes"] or 0
        )

    def create(self, df: DataFrame) -> KeyedTable:
        last = self.versions.latest()
        state = {"version": -1 if last is None else last, "manifest": None, "folders": []}
        buckets = max(self.buckets, buckets_for(stored_bytes(df), self.bucket_bytes))
        self._publish(state, df, buckets, None, None)
        return self

    def _change(self, rows: DataFrame, replace: bool, load: str | None = None, check: Callable[[DataFrame], None] | None = None) -> None:
        """Add ``rows`` (staged, unique by key); known keys get the new row, or keep theirs."""
        rows = rows.select(*split_schema(self.schema))
        while True:
            state = self.versions.state()
            old = state["buckets"]
            buckets = max(old, buckets_for(state["bytes"] + stored_bytes(rows), self.bucket_bytes))
            touched = rows.select(address(self._hash(), old).alias(BUCKET)).distinct()
            split = self.spark.range(old, buckets).select(address(F.col("id"), old).alias(BUCKET)).distinct()
            again = split.unionByName(self._untidy(state))
            again = (again.unionByName(touched) if replace else again).distinct()
            if check is not None:
                check(self._live(state, touched))
            if replace:
                new = rows
                kept = self._live(state, again).join(rows, list(self.keys), "left_anti")
            else:
                new = rows.join(self._live(state, touched), list(self.keys), "left_anti")
                kept = self._live(state, again)
            try:
                return self._publish(state, kept.unionByName(new), buckets, again, load)
            except Conflict:
                continue

    def upsert(self, changes: DataFrame, order: Sequence[str]) -> None:
        """Insert new keys and replace known ones; of several changes to a key the last wins."""
        self._change(stage(dedup(changes, self.keys, order, keep="last"), "changes"), replace=True)

    def insert_if_absent(self, rows: DataFrame, order: Sequence[str]) -> None:
        """Add rows with unknown keys; known ones stay as they are."""
        self._change(stage(dedup(rows, self.keys, order, keep="first"), "incoming"), replace=False)

    def insert_strict(self, rows: DataFrame, load: str | None = None) -> None:
        """Add rows, or reject the whole batch if any key is repeated or known.

        A named load that was committed before is not tried again, so it may be repeated after its success.
        """
        fresh = stage(rows, "incoming")

        def check(live: DataFrame) -> None:
            if not fresh.join(live, list(self.keys), "left_semi").isEmpty():
                raise LoadRejected("a key of the batch is already in the table")

        if load is not None and self.versions.has(load):
            return
        if not duplicate_keys(fresh, self.keys).isEmpty():
            raise LoadRejected("a key is repeated within the batch")
        self._change(fresh, replace=False, load=load, check=check)

    def drop_unused(self) -> int:
        """Delete the folders that the last version does not use, when nobody reads an earlier one or writes."""
        return self.versions.drop_unused(self.versions.state()["folders"])


def split_schema(schema: str) -> list[str]:
    """The column names of a schema text."""
    return [f.name for f in StructType.fromDDL(schema).fields]


@dataclass(frozen=True)
class Ledger:
    """Events applied at most once each.

    The ledger itself is the only thing written: a balance is the start value plus
    the sum over the ledger, so no crash can separate an effect from its record.
    """

    table: KeyedTable
    account: str
    amount: str

    def apply(self, events: DataFrame, order: Sequence[str]) -> None:
        self.table.insert_if_absent(events, order)

    def balances(self, start: float = 0.0) -> DataFrame:
        total = F.round(F.sum(self.amount), 2) + F.lit(start)
        return self.table.read().groupBy(self.account).agg(
            total.alias("balance"), F.count(F.lit(1)).alias("n_applied")
        )


def atomic_load(batch: DataFrame, path: str, load_id: str, keys: Sequence[str], valid: Column) -> int:
    """Publish a batch only if all of it is valid; otherwise leave the target as it was.

    The rows become visible with the pointer, all at once. A load that is repeated
    takes the place of its earlier self. Loads that run at once get a version each.
    """
    staged = stage(batch, "batch")
    checks = staged.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(valid, F.lit(False))).alias("bad")).first()
    if checks["bad"]:
        raise LoadRejected(f"{checks['bad']} of {checks['n']} rows are not valid")
    if not duplicate_keys(staged, keys).isEmpty():
        raise LoadRejected(f"key {list(keys)} is repeated within the batch")
    versions = Versions(batch.sparkSession, path)
    folder = versions.write(staged)
    while True:
        last = versions.latest()
        try:
            versions.commit(0 if last is None else last + 1, load_id, folder=folder)
            return checks["n"]
        except Conflict:
            continue  # the rows do not depend on other loads, so the next number does


def read_loads(spark: SparkSession, path: str, schema: str, out: str = "load_id") -> DataFrame:
    """The rows of all committed loads, each load by its last version."""
    versions = Versions(spark, path)
    last = versions.log().groupBy(F.col("load").alias(out)).agg(F.max_by("folder", "version").alias(FOLDER))
    if versions.latest() is None:
        return versions.read(schema, []).join(last, FOLDER).drop(FOLDER)
    stored = spark.read.schema(f"{schema}, {FOLDER} string").parquet(f"{path}/data")
    return stored.join(broadcast_within(last), FOLDER).drop(FOLDER)


def with_retry(
    action: Callable[[], object],
    attempts: int = 5,
    base: float = 0.5,
    cap: float = 30.0,
    transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
    sleep: Callable[[float], None] = time.sleep,
):
    """Run an idempotent step again after a transient error, waiting longer each time."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except transient:
            if attempt == attempts:
                raise
            sleep(random.uniform(0, min(cap, base * 2**attempt)))


def backfill(df: DataFrame, path: str, day: str, days: DataFrame) -> None:
    """Load the listed days, each as its own replaceable partition, in one job."""
    replace_partitions(df.join(days.select(day).distinct(), day, "left_semi"), path, [day])
