"""Positions, running values and gap filling over ordered rows.

A window whose group is one hot key would run in one task. The operators here
first look for such groups. If there is none they use a plain window. If there
is one, rows are range-partitioned by (keys, order), each range works alone, and
a small table carries values from earlier ranges of the same key into later ones:
at most one key continues from one range to the next, so that table never has
more rows than there are ranges.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.operators.skew import broadcast_within, group_sizes
from millrace.session import stage

CHUNK = "_chunk"
ROWS_PER_TASK = 5_000_000
#: Consecutive rows of a key that one window task has, when their windows reach into each other.
ROWS_PER_RUN = 1_000_000


def global_index(
    df: DataFrame, order: Sequence[str | Column], out: str = "idx", start: int = 0, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Number all rows by ``order`` (which must be unique) without a one-task window.

    The rows are counted first, so that a range has about ``rows_per_task`` of them at any size.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = max(1, math.ceil(df.count() / rows_per_task))
    ranged = stage(
        df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()),
        "index",
    )
    part = F.shiftright("_mid", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so this window is as small as the number of ranges
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    position = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn("_part", part)
        .join(broadcast_within(offsets), "_part")
        .withColumn(out, F.col("_offset") + position + F.lit(start))
        .drop("_part", "_mid", "_offset")
    )


def row_slice(
    df: DataFrame, order: Sequence[str | Column], start: int = 0, stop: int | None = None, step: int = 1
) -> DataFrame:
    """Rows [start, stop) by position with a step; out of range gives no rows."""
    indexed = global_index(df, order)
    keep = (F.col("idx") >= start) & (F.pmod(F.col("idx") - start, F.lit(step)) == 0)
    if stop is not None:
        keep &= F.col("idx") < stop
    return indexed.filter(keep)


def row_at(df: DataFrame, order: Sequence[str | Column], position: int) -> DataFrame:
    """One row by position; a position past the end is an error."""
    row = row_slice(df, order, position, position + 1)
    if row.isEmpty():
        raise IndexError(f"row {position} is out of range")
    return row


@dataclass(frozen=True)
class Ordered:
    """Rows with their group keys and order; ``chunked`` if groups are split."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool

    @property
    def group(self) -> list[str]:
        return [CHUNK, *self.keys] if self.chunked else list(self.keys)

    def window(self, backward: bool = False) -> WindowSpec:
        order = [F.col(c).desc() if backward else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.group).orderBy(*order)

    def running(self, backward: bool = False) -> WindowSpec:
        return self.window(backward).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def rows(self) -> DataFrame:
        return self.df.drop(CHUNK)


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> Ordered:
    """Prepare ``df`` for the operators below; ``order`` must be unique within a key."""
    largest, total = group_sizes(df, keys)
    if largest <= rows_per_task:
        return Ordered(df, tuple(keys), tuple(order), False)
    ranges = math.ceil(total / rows_per_task)
    split = df.repartitionByRange(ranges, *keys, *order)
    ranged = stage(split.withColumn(CHUNK, F.spark_partition_id()), "ranges")
    return Ordered(ranged, tuple(keys), tuple(order), True)


def _attach(o: Ordered, totals: DataFrame, fold: Callable[[WindowSpec], Column], backward: bool) -> DataFrame:
    """Join ``_carry``: what the other ranges of the same key hand over."""
    by = Window.partitionBy(*o.keys).orderBy(F.col(CHUNK).desc() if backward else F.col(CHUNK))
    seen = by.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        totals.withColumn("_carry", fold(seen))
        .withColumn("_rank", F.row_number().over(by))
        .filter(F.col("_rank") > 1)
        .select(CHUNK, *[F.col(k).alias(f"_k_{k}") for k in o.keys], "_carry")
        .withColumnRenamed(CHUNK, "_c")
    )
    same = F.col(CHUNK) == F.col("_c")
    for k in o.keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return o.df.join(broadcast_within(carry), same, "left").drop("_c", *[f"_k_{k}" for k in o.keys])


def scan(
    o: Ordered,
    out: str,
    local: Callable[[Ordered], Column],
    total: Column,
    fold: Callable[[WindowSpec], Column],
    merge: Callable[[Column, Column], Column],
    backward: bool = False,
) -> Ordered:
    """Add ``out``: ``local`` within a range, merged with the folded ``total`` of other ranges."""
    if not o.chunked:
        return replace(o, df=o.df.withColumn(out, local(o)))
    totals = o.df.groupBy(*o.group).agg(total.alias("_total"))
    joined = _attach(o, totals, fold, backward)
    df = joined.withColumn("_local", local(o)).withColumn(out, merge(F.col("_local"), F.col("_carry")))
    return replace(o, df=df.drop("_local", "_carry"))


def row_numbers(o: Ordered, out: str = "rn") -> Ordered:
    return scan(
        o,
        out,
        lambda s: F.row_number().over(s.window()).cast("bigint"),
        F.count(F.lit(1)),
        lambda w: F.sum("_total").over(w),
        lambda here, carry: here + F.coalesce(carry, F.lit(0)),
    )


def running_sum(o: Ordered, value: str | Column, out: str) -> Ordered:
    value = F.col(value) if isinstance(value, str) else value
    return scan(
        o,
        out,
        lambda s: F.sum(value).over(s.running()),
        F.sum(value),
        lambda w: F.sum("_total").over(w),
        lambda here, carry: F.coalesce(here + carry, here, carry),
    )


def running_avg(o: Ordered, value: str | Column, out: str) -> Ordered:
    value = F.col(value) if isinstance(value, str) else value
    o = running_sum(o, value, "_rs")
    o = running_sum(o, F.when(value.isNotNull(), 1).otherwise(0), "_rc")
    df = o.df.withColumn(out, F.when(F.col("_rc") > 0, F.col("_rs") / F.col("_rc")))
    return replace(o, df=df.drop("_rs", "_rc"))


def fill(o: Ordered, value: str | Column, out: str, backward: bool = False) -> Ordered:
    """Nearest earlier (or, ``backward``, later) known value."""
    value = F.col(value) if isinstance(value, str) else value
    known = F.when(value.isNotNull(), F.struct(*o.order))
    return scan(
        o,
        out,
        lambda s: F.last(value, ignorenulls=True).over(s.running(backward)),
        (F.min_by if backward else F.max_by)(value, known),
        lambda w: F.last("_total", ignorenulls=True).over(w),
        lambda here, carry: F.coalesce(here, carry),
        backward,
    )


def previous(o: Ordered, value: str, out: str) -> Ordered:
    """Value of the row before, null on the first row of a key."""
    if not o.chunked:
        return replace(o, df=o.df.withColumn(out, F.lag(value).over(o.window())))
    boxed = F.struct(F.col(value).alias("v"))
    return scan(
        o,
        out,
        lambda s: F.struct(
            F.row_number().over(s.window()).alias("rn"), F.lag(value).over(s.window()).alias("v")
        ),
        F.max_by(boxed, F.struct(*o.order)),
        lambda w: F.last("_total").over(w),
        lambda here, carry: F.when(here["rn"] == 1, carry["v"]).otherwise(here["v"]),
    )


def interpolate(o: Ordered, value: str, out: str) -> Ordered:
    """Linear between known neighbours by position; a trailing gap repeats the last
    known value and a leading gap stays null."""
    o = row_numbers(o, "_pos")
    point = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_pos").alias("p")))
    o = fill(o, point, "_prev")
    o = fill(o, point, "_next", backward=True)
    slope = (F.col("_next.v") - F.col("_prev.v")) / (F.col("_next.p") - F.col("_prev.p"))
    between = F.col("_prev.v") + slope * (F.col("_pos") - F.col("_prev.p"))
    estimate = (
        F.when(F.col(value).isNotNull(), F.col(value).cast("double"))
        .when(F.col("_prev").isNull(), F.lit(None).cast("double"))
        .when(F.col("_next").isNull(), F.col("_prev.v").cast("double"))
        .otherwise(between)
    )
    return replace(o, df=o.df.withColumn(out, estimate).drop("_pos", "_prev", "_next"))


HALO = "_halo"


def with_halo(o: Ordered, before: int) -> Ordered:
    """Split groups dealt anew so that a window over the last ``before`` rows stays in its range.

    Rows are numbered, and a range becomes a run of consecutive numbers no shorter
    than ``before``; the last ``before`` rows of a run go to the next run as well, as
    rows marked ``_halo``, which the caller drops when its windows are done.
    """
    numbered = row_numbers(o, "_pos")
    rows_per_run = max(before, ROWS_PER_RUN)
    run = F.floor((F.col("_pos") - 1) / rows_per_run)
    left = rows_per_run - (F.col("_pos") - 1) % rows_per_run  # this row and those after it in the run
    runs = F.when(left <= before, F.array(run, run + 1)).otherwise(F.array(run))
    sent = numbered.df.drop(CHUNK).select("*", run.alias("_run"), F.explode(runs).alias(CHUNK))
    return replace(o, df=sent.withColumn(HALO, F.col(CHUNK) > F.col("_run")).drop("_run", "_pos"))


def moving_avg(o: Ordered, value: str, n: int, out: str) -> Ordered:
    """Average of the last ``n`` rows; early rows use the rows there are."""
    wide = with_halo(o, n - 1) if o.chunked and n > 1 else o
    frame = wide.window().rowsBetween(-(n - 1), Window.currentRow)
    df = wide.df.withColumn(out, F.try_divide(F.sum(value).over(frame), F.count(value).over(frame)))
    if HALO in df.columns:
        df = df.filter(~F.col(HALO)).drop(HALO)
    return replace(o, df=df)


def count_windows(o: Ordered, n: int, aggs: Sequence[Column], out: str = "window_no") -> DataFrame:
    """Aggregate every ``n`` consecutive rows of a key; an incomplete last window gives nothing."""
    o = row_numbers(o, "_pos")
    return (
        o.df.withColumn(out, F.floor((F.col("_pos") - 1) / n))
        .groupBy(*o.keys, out)
        .agg(F.count(F.lit(1)).alias("_n"), *aggs)
        .filter(F.col("_n") == n)
        .drop("_n")
    )


def run_groups(o: Ordered, value: str, aggs: Sequence[Column], out: str = "run_no") -> DataFrame:
    """Aggregate each run of adjacent equal values, numbered from 1 within a key."""
    o = previous(o, value, "_prev")
    o = row_numbers(o, "_pos")
    changed = (F.col("_pos") == 1) | ~F.col(value).eqNullSafe(F.col("_prev"))
    o = running_sum(o, F.when(changed, 1).otherwise(0), out)
    return o.df.groupBy(*o.keys, out, value).agg(*aggs)


def missing_days(df: DataFrame, day: str, start: str | Column, end: str | Column) -> DataFrame:
    """Days between ``start`` and ``end`` that have no row in ``df``."""
    spark = df.sparkSession
    lo = F.lit(start).cast("date") if isinstance(start, str) else start
    hi = F.lit(end).cast("date") if isinstance(end, str) else end
    wanted = spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))).alias(day))
    return wanted.join(df.select(day).distinct(), day, "left_anti")


#: Parts that a range of values is cut into by one pass.
PARTS = 1024


def _first_part(v: Column) -> Column:
    """A number that never falls as the value rises, about 16 for each doubling; NaN comes last, as Spark sorts it."""
    size = F.floor(F.least(F.log2(F.abs(v)), F.lit(2000.0)) * 16) + 20_000
    return F.when(F.isnan(v), F.lit(1 << 40)).when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("bigint")


def _next_part(v: Column, low: Column, high: Column) -> Column:
    """The same by equal parts of the range from ``low`` to ``high``."""
    share = F.try_divide(v.cast("double") - low.cast("double"), high.cast("double") - low.cast("double"))
    return F.coalesce(F.floor(share * PARTS), F.lit(0)).cast("bigint")


def _null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], more: Column, how: str = "inner") -> DataFrame:
    """Join on ``by`` (null equals null) and ``more``; ``right`` has its keys under ``_w_``, which go."""
    for k in by:
        more &= F.col(k).eqNullSafe(F.col(f"_w_{k}"))
    return left.join(right, more, how).drop(*[f"_w_{k}" for k in by])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per key (or of all rows, for no keys).

    Spark's own exact percentile holds all distinct values of a group in one task.
    Here each pass counts the values of a key in parts of its range, combined before
    the shuffle, so what moves is bounded by parts, not by values. Only the part
    that holds a wanted place is looked into by the next pass, until the rows left
    in such parts are few enough to be counted value by value.
    """
    by = list(keys) or ["_all"]
    # without keys all rows have the key 0, written so that the planner keeps it as a key to join by
    group = [*keys] if keys else [F.pmod(F.xxhash64(value), F.lit(1)).alias("_all")]
    known = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"))
    counted = (F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    parts = stage(known.groupBy(*by, _first_part(F.col("_v").cast("double")).alias("_part")).agg(*counted), "value-parts")

    # the places wanted of each key: the two neighbours of each quantile
    sizes = parts.groupBy(*by).agg(F.sum("_rows").alias("n"))
    place = lambda q: (F.col("n") - 1) * F.lit(float(q))
    both = [f(place(q)) for q in quantiles.values() for f in (F.floor, F.ceil)]
    wanted = sizes.select(*by, "n", F.explode(F.array_distinct(F.array(*both))).alias("_place"), F.lit(0).cast("bigint").alias("_base"))

    def located(wanted: DataFrame, parts: DataFrame, within: Sequence[str]) -> DataFrame:
        """The part that holds each place, and how many values come before it."""
        window = Window.partitionBy(*within).orderBy("_part")
        ends = parts.withColumn("_end", F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        renamed = ends.select(*[F.col(k).alias(f"_w_{k}") for k in within], "_rows", "_low", "_high", "_end")
        inside = (F.col("_place") >= F.col("_base") + F.col("_end") - F.col("_rows")) & (F.col("_place") < F.col("_base") + F.col("_end"))
        found = _null_safe(wanted, renamed, within, inside)
        return found.withColumn("_base", F.col("_base") + F.col("_end") - F.col("_rows")).drop("_end")

    # the ranges of one key don't overlap, so the key and the lowest value name a range
    at, done = [*by, "_from"], None
    most = parts.agg(F.sum("_rows")).first()[0] or 0
    # stored, so that the planner knows how small they are: else it would shuffle all rows by key to join them
    places = stage(located(wanted, parts, by), "places")
    while True:
        found = places.filter("_low = _high").select(*by, "n", "_place", F.col("_low").alias("_at"))
        done = found if done is None else done.unionByName(found)
        open_ = places.filter("_low < _high").select(*by, "n", "_place", "_base", "_rows", F.col("_low").alias("_from"), F.col("_high").alias("_to"))
        names = open_.select(*[F.col(k).alias(f"_w_{k}") for k in by], "_from", "_to").distinct()
        rows = _null_safe(known, broadcast_within(names), by, (F.col("_v") >= F.col("_from")) & (F.col("_v") <= F.col("_to")))
        values = rows.groupBy(*at, F.col("_v").alias("_part")).agg(*counted)
        if most <= rows_per_task:
            # no range has more rows than that: its values are counted, and every place is found
            last = located(open_.drop("_rows", "_to"), values, at)
            done = done.unionByName(last.select(*by, "n", "_place", F.col("_low").alias("_at")))
            break
        parts = stage(rows.groupBy(*at, _next_part(F.col("_v"), F.col("_from"), F.col("_to")).alias("_part")).agg(*counted), "value-parts")
        if not parts.groupBy(*at).count().filter("count = 1").limit(1).isEmpty():
            # doubles can't tell the ends of a range apart any more: its values are few
            parts = stage(values, "value-parts")
        places = stage(located(open_.drop("_rows", "_to"), parts, at).drop("_from"), "places")
        most = places.filter("_low < _high").agg(F.max("_rows")).first()[0] or 0

    aggs, results = [F.max("n").alias("n")], []
    for name, q in quantiles.items():
        low, high = f"_lo_{name}", f"_hi_{name}"
        aggs += [F.max(F.when(F.col("_place") == f(place(q)), F.col("_at"))).alias(c) for f, c in ((F.floor, low), (F.ceil, high))]
        share = place(q) - F.floor(place(q))
        results.append((F.col(low) + (F.col(high) - F.col(low)) * share).cast("double").alias(name))
    return done.groupBy(*by).agg(*aggs).select(*keys, *results, "n")
