"""Hot keys: finding them, salting aggregations and joins, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

SALT = "_salt"
HASH = "_hash"
#: Counters of a partition's summary.
COUNTERS = 10_000


def broadcast_within(df: DataFrame, most_bytes: int = 64 << 20) -> DataFrame:
    """Ask for a broadcast if the planner's own estimate of ``df`` is at most ``most_bytes``.

    The estimate comes from file sizes and the plan, so nothing runs while the query is built.
    """
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if estimate <= most_bytes else df


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


class SpaceSaving:
    """At most ``size`` counted keys; ``floor`` bounds the count of every other one.

    A key that comes in counts from the floor on, which is also the most that its
    count may be too high. Keys are 64-bit hashes, taken a batch at a time.
    """

    def __init__(self, size: int = COUNTERS) -> None:
        self.size, self.floor = size, 0
        self.keys, self.counts, self.over = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        new, times = np.unique(keys, return_counts=True)
        both = np.union1d(self.keys, new)
        counts, over = np.full(len(both), self.floor, np.int64), np.full(len(both), self.floor, np.int64)
        at = np.searchsorted(both, self.keys)
        counts[at], over[at] = self.counts, self.over
        counts[np.searchsorted(both, new)] += times
        if len(both) > self.size:
            order = np.argsort(-counts, kind="stable")
            kept = np.sort(order[: self.size])
            self.floor = max(self.floor, int(counts[order[self.size]]))
            both, counts, over = both[kept], counts[kept], over[kept]
        self.keys, self.counts, self.over = both, counts, over


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition's counters, and its floor and rows under no key."""
    summary, rows = SpaceSaving(), 0
    for batch in batches:
        summary.add(batch.column(HASH).to_numpy())
        rows += batch.num_rows
    columns = [
        pa.array([*summary.keys.tolist(), None], pa.int64()),
        pa.array([*(summary.counts - summary.floor).tolist(), summary.floor], pa.int64()),
        pa.array([*(summary.counts - summary.over).tolist(), rows], pa.int64()),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=[HASH, "above", "least"])


def heavy_hitters(df: DataFrame, keys: Sequence[str], at_least: int) -> tuple[DataFrame, int]:
    """The keys with ``at_least`` rows or more, and the number of all rows, without a shuffle of the rows.

    A Space-Saving summary of each partition is merged into ``_hash, most, least``: the
    hash of the key and bounds of its rows. A key with so many rows is never missed. If
    the bounds are too wide to tell (more keys of that size than a summary
    has counters), the keys are counted exactly instead, combined before the shuffle.
    The result has at most ``2 * rows / at_least`` rows.
    """
    hashed = df.select(F.xxhash64(*keys).alias(HASH))
    found = stage(hashed.mapInArrow(_summaries, f"{HASH} bigint, above bigint, least bigint"), "summaries")
    rest = found.filter(F.col(HASH).isNull()).agg(F.sum("above").alias("floor"), F.sum("least").alias("rows")).first()
    floor, rows = rest["floor"] or 0, rest["rows"] or 0
    if 2 * floor > at_least:
        exact = hashed.groupBy(HASH).agg(F.count(F.lit(1)).alias("most")).withColumn("least", F.col("most"))
    else:
        known = found.filter(F.col(HASH).isNotNull())
        exact = known.groupBy(HASH).agg((F.sum("above") + floor).alias("most"), F.sum("least").alias("least"))
    return stage(exact.filter(F.col("most") >= at_least), "heavy-hitters"), rows


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str, how: str = "left") -> DataFrame:
    """Join on equal keys with null equal to null; ``right`` has its keys under ``prefix``, which go."""
    condition = F.lit(True)
    for k in keys:
        condition &= left[k].eqNullSafe(right[f"{prefix}{k}"])
    return left.join(right, condition, how).drop(*[f"{prefix}{k}" for k in keys])


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest group, and rows in all."""
    sizes = key_counts(df, keys).agg(F.max("_rows").alias("largest"), F.sum("_rows").alias("total")).first()
    return sizes["largest"] or 0, sizes["total"] or 0


def collect_pages(
    df: DataFrame, keys: Sequence[str], element: Column, place: Sequence[str | Column], rows_per_page: int, out: str
) -> DataFrame:
    """Elements of each group as sorted arrays of at most ``rows_per_page``, with a number ``page``.

    Every group, that of null keys too, has a page 0 and as many more as it needs;
    numbers are unique in a group but need not be consecutive. Rows are dealt by
    ``place``, columns that tell them apart, so a retried task deals them alike.
    """
    placed = df.withColumn("_place", F.xxhash64(*place))
    sizes = placed.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_page).alias("_pages"), F.min("_place").alias("_least")
    )
    dealt = same_keys(placed, sizes, keys, "_k_", "inner").withColumn(
        # The row with the least place is always on page 0.
        "_deal",
        F.pmod(F.pmod("_place", "_pages") - F.pmod("_least", "_pages"), "_pages"),
    )
    arrays = dealt.groupBy(*keys, "_deal", "_pages").agg(F.array_sort(F.collect_list(element)).alias("_all"))
    # A deal may exceed the limit by chance; it then continues on a further page.
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / rows_per_page).cast("int")),
        lambda i: F.slice("_all", i * rows_per_page + 1, F.lit(rows_per_page)),
    )
    pages = arrays.select(*keys, "_deal", "_pages", F.posexplode(parts).alias("_turn", out))
    return pages.select(*keys, (F.col("_deal") + F.col("_turn") * F.col("_pages")).cast("bigint").alias("page"), out)


def skew_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, keys, the hottest key and the share of rows it holds."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    # largest count first, smallest key on ties
    hottest = F.min(F.struct((-F.col("n")).alias("neg"), F.col(key).alias("key")))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        hottest.alias("h"),
    ).select(
        "n_rows",
        "n_keys",
        F.col("h.key").alias("hot_key"),
        (-F.col("h.neg")).alias("hot_rows"),
        F.when(F.col("n_rows") > 0, -F.col("h.neg") / F.col("n_rows")).otherwise(F.lit(0.0)).alias("hot_share"),
    )


def needs_salting(df: DataFrame, key: str, threshold: float = 0.2) -> DataFrame:
    """One row: ``n_rows``, the hottest key if it holds the share ``threshold`` of them, its rows and share, and ``salt``.

    Only rows of the few keys that a summary can't rule out are counted. An empty
    table never needs salting.
    """
    rows = df.count()
    least = max(1, int(np.ceil(rows * threshold)))
    hot, _ = heavy_hitters(df, [key], least)
    some = df.select(key, F.xxhash64(key).alias(HASH)).join(broadcast_within(hot.select(HASH)), HASH, "left_semi")
    counts = some.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    hottest = F.min(F.struct((-F.col("n")).alias("neg"), F.col(key).alias("key")))
    n_rows = F.lit(rows).cast("bigint")
    return counts.agg(hottest.alias("h")).select(
        n_rows.alias("n_rows"),
        F.col("h.key").alias("hot_key"),
        (-F.col("h.neg")).alias("hot_rows"),
        F.try_divide(-F.col("h.neg"), n_rows).alias("hot_share"),
        F.col("h").isNotNull().alias("salt"),
    )


def salt_of(row_id: Sequence[str | Column], salts: int | Column) -> Column:
    """A salt that depends only on the row, so a retried task gives the same one."""
    buckets = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(*row_id), buckets.cast("bigint")).cast("int")


def salted_sum(df: DataFrame, key: str, value: str, row_id: Sequence[str], salts: int, out: str) -> DataFrame:
    """Sum per key in two stages: first per (key, salt), then per key."""
    partial = (
        df.withColumn(SALT, salt_of(row_id, salts))
        .groupBy(key, SALT)
        .agg(F.sum(value).alias("_part"), F.count(F.lit(1)).alias("_n"))
    )
    return partial.groupBy(key).agg(F.sum("_part").alias(out), F.sum("_n").alias("n_rows"))


def skew_aware_sum(
    df: DataFrame, key: str, value: str, row_id: Sequence[str], out: str, salts: int = 16, threshold: float = 0.2
) -> DataFrame:
    """Profile the key, then take the salted or the plain plan."""
    if needs_salting(df, key, threshold).first()["salt"]:
        return salted_sum(df, key, value, row_id, salts, out)
    return df.groupBy(key).agg(F.sum(value).alias(out), F.count(F.lit(1)).alias("n_rows"))


def spread_join(big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a hot key of ``big`` never is one task.

    Adaptive execution splits a hot key of the left side in inner, left, semi and
    anti joins. It cannot in right and outer joins, which are an inner or left join
    plus the rows of ``other`` whose key ``big`` does not have.
    """
    if how not in ("inner", "left", "right", "outer", "left_semi", "left_anti"):
        raise ValueError(f"unknown kind of join: {how}")
    if how not in ("right", "outer"):
        return big.join(other, list(on), how)
    matched = big.join(other, list(on), "inner" if how == "right" else "left")
    unmatched = other.join(big.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def salted_join(
    big: DataFrame, other: DataFrame, on: Sequence[str], row_id: Sequence[str], how: str = "inner", rows_per_task: int = 2_000_000
) -> DataFrame:
    """Equi-join that spreads each hot key of ``big`` over as many tasks as its rows need.

    For plans without adaptive splitting. A summary names the few hot keys, which
    both sides get by broadcast, so no row moves by the key alone; only rows of hot
    keys are replicated on the other side, once per salt of that key, and rows
    of ``big`` keep one salt each, so no pair is lost or doubled.
    """
    if how not in ("inner", "left", "right", "outer", "left_semi", "left_anti"):
        raise ValueError(f"unknown kind of join: {how}")
    if how in ("right", "outer"):
        matched = salted_join(big, other, on, row_id, "inner" if how == "right" else "left", rows_per_task)
        unmatched = other.join(big.select(*on).distinct(), list(on), "left_anti")
        return matched.unionByName(unmatched, allowMissingColumns=True)
    hot, _ = heavy_hitters(big, on, rows_per_task + 1)
    salts = broadcast_within(hot.select(HASH, F.ceil(F.col("most") / rows_per_task).cast("int").alias("_salts")))
    own = F.xxhash64(*on)
    left = (
        big.withColumn(HASH, own)
        .join(salts, HASH, "left")
        .withColumn(SALT, F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(salt_of(row_id, F.col("_salts"))))
        .drop("_salts", HASH)
    )
    right = (
        other.withColumn(HASH, own)
        .join(salts, HASH, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts", HASH)
    )
    return left.join(right, [*on, SALT], how).drop(SALT)
