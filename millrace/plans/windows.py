"""Ordered computations: numbering, running and moving values, gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ordered as O
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.tables import load

KEYS, ORDER = ["user_id"], ["ts", "event_id"]
_OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id"


def _events(spark, folder, *columns):
    return O.ordered(load(spark, folder, "events").select("event_id", "ts", "user_id", *columns), KEYS, ORDER)


def _sparse(spark, folder):
    return O.ordered(D.sparse_events(spark, folder).select("event_id", "ts", "user_id", "value"), KEYS, ORDER)


def _cents(column):
    """Amounts as whole cents, whose running sums are exact in any order."""
    return F.round(F.col(column) * 100).cast("bigint")


@query(
    "enumerate_rows",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""",
)
def enumerate_rows(spark, folder):
    """Number all rows from 0, and each customer's rows from 1."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    numbered = O.global_index(orders, ["o_orderdate", "o_orderkey"])
    per_key = O.row_numbers(O.ordered(numbered, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    return per_key.rows().select("o_orderkey", "idx", "rn")


@query(
    "running_total",
    f"""SELECT event_id, sum(round(value * 100)::BIGINT) {_OVER} ROWS UNBOUNDED PRECEDING) / 100 AS running,
               count(*) {_OVER} ROWS UNBOUNDED PRECEDING) AS seen FROM events""",
)
def running_total(spark, folder):
    o = O.running_sum(_events(spark, folder, "value"), _cents("value"), "cents")
    o = O.row_numbers(o, "seen")
    return o.rows().select("event_id", (F.col("cents") / 100).alias("running"), "seen")


@query(
    "running_avg",
    f"""SELECT event_id, sum(round(value * 100)::BIGINT) {_OVER} ROWS UNBOUNDED PRECEDING)
               / count(*) {_OVER} ROWS UNBOUNDED PRECEDING) / 100 AS average FROM events""",
)
def running_avg(spark, folder):
    o = O.running_avg(_events(spark, folder, "value"), _cents("value"), "avg_cents")
    return o.rows().select("event_id", (F.col("avg_cents") / 100).alias("average"))


@query(
    "moving_avg",
    f"""SELECT event_id, round(avg(value) {_OVER} ROWS 4 PRECEDING), 6) AS average FROM events""",
)
def moving_avg(spark, folder):
    """Average of the last five events of the user; the first events use fewer."""
    o = O.moving_avg(_events(spark, folder, "value"), "value", 5, "average")
    return o.rows().select("event_id", F.round("average", 6).alias("average"))


@query(
    "count_tumbling",
    """SELECT user_id, window_no, round(sum(value), 2) AS total FROM (
         SELECT user_id, value, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 5 AS window_no
         FROM events) GROUP BY ALL HAVING count(*) = 5""",
)
def count_tumbling(spark, folder):
    """One total for every five events of a user; a begun window is held back."""
    return O.count_windows(_events(spark, folder, "value"), 5, [F.round(F.sum("value"), 2).alias("total")])


@query(
    "ffill",
    f"""WITH {D.SPARSE_EVENTS} SELECT event_id, last_value(value IGNORE NULLS) {_OVER} ROWS UNBOUNDED PRECEDING) AS filled
        FROM sparse""",
)
def ffill(spark, folder):
    return O.fill(_sparse(spark, folder), "value", "filled").rows().select("event_id", "filled")


@query(
    "bfill",
    f"""WITH {D.SPARSE_EVENTS} SELECT event_id, first_value(value IGNORE NULLS) {_OVER}
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled,
        coalesce(last_value(value IGNORE NULLS) {_OVER} ROWS UNBOUNDED PRECEDING),
          first_value(value IGNORE NULLS) {_OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS both_ways
        FROM sparse""",
)
def bfill(spark, folder):
    """Backward fill, and forward fill with the leading gap filled backward."""
    o = O.fill(_sparse(spark, folder), "value", "filled", backward=True)
    o = O.fill(o, "value", "forward")
    return o.rows().select("event_id", "filled", F.coalesce("forward", "filled").alias("both_ways"))


@query(
    "interpolate",
    f"""WITH {D.SPARSE_EVENTS},
       p AS (SELECT *, row_number() {_OVER}) AS pos FROM sparse),
       n AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {_OVER} ROWS UNBOUNDED PRECEDING) AS p0,
               last_value(value IGNORE NULLS) {_OVER} ROWS UNBOUNDED PRECEDING) AS v0,
               first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) {_OVER}
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
               first_value(value IGNORE NULLS) {_OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1 FROM p)
       SELECT event_id, round(CASE WHEN value IS NOT NULL THEN value WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL THEN v0
         ELSE v0 + (v1 - v0) / (p1 - p0) * (pos - p0) END, 6) AS filled FROM n""",
)
def interpolate(spark, folder):
    o = O.interpolate(_sparse(spark, folder), "value", "filled")
    return o.rows().select("event_id", F.round("filled", 6).alias("filled"))


@query(
    "missing_days",
    """SELECT strftime(d, '%Y-%m-%d') AS day FROM (
         SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY))::DATE AS d)
       WHERE d NOT IN (SELECT ts::DATE FROM events WHERE day(ts) % 6 <> 0)""",
)
def missing_days(spark, folder):
    """Days to backfill: those of the schedule with no events (every sixth is left out)."""
    events = load(spark, folder, "events").filter(F.dayofmonth("ts") % 6 != 0)
    days = events.select(F.to_date("ts").alias("day"))
    gaps = O.missing_days(days, "day", "2023-12-25", "2024-02-05")
    return gaps.select(F.date_format("day", "yyyy-MM-dd").alias("day"))
