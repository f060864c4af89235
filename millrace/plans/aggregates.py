"""Aggregation and reshaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate as A
from millrace.operators.clean import exact_median
from millrace.operators.documents import match_group
from millrace.operators.ordered import exact_quantiles, ordered, run_groups
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import stage
from millrace.tables import load


@query(
    "group_sum",
    f"""WITH {D.DIRTY_ORDERS} SELECT customer_id, count(*) AS n_orders, sum(order_id)::BIGINT AS key_sum FROM dirty
        WHERE customer_id IS NOT NULL GROUP BY customer_id""",
)
def group_sum(spark, folder):
    """Group by one key; rows without a key are left out, as a data frame library would."""
    return A.group_by(
        D.dirty_orders(spark, folder),
        ["customer_id"],
        [F.count(F.lit(1)).alias("n_orders"), F.sum("order_id").alias("key_sum")],
        null_keys="drop",
    )


@query(
    "group_multi_agg",
    """SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice), 2) / count(*) AS mean,
              count(*) AS n FROM orders GROUP BY o_orderstatus""",
)
def group_multi_agg(spark, folder):
    return A.group_by(
        load(spark, folder, "orders"),
        ["o_orderstatus"],
        [
            A.money_sum("o_totalprice").alias("total"),
            A.money_avg("o_totalprice").alias("mean"),
            F.count(F.lit(1)).alias("n"),
        ],
    )


@query(
    "group_two_keys",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS qty, count(*) AS n,
              l_returnflag = 'A' AND l_linestatus = 'F' AS is_picked FROM lineitem GROUP BY ALL""",
)
def group_two_keys(spark, folder):
    grouped = A.group_by(
        load(spark, folder, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        [A.money_sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n")],
    )
    return grouped.withColumn("is_picked", (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"))


@query(
    "completed_revenue",
    """SELECT o_orderpriority, round(sum(o_totalprice), 2) AS revenue FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def completed_revenue(spark, folder):
    return (
        load(spark, folder, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .groupBy("o_orderpriority")
        .agg(A.money_sum("o_totalprice").alias("revenue"))
    )


@query(
    "global_reduce",
    """SELECT 'all' AS input, round(sum(f), 6) + 100 AS total, round(product(f), 9) AS product,
              greatest(max(f), 100) AS largest
       FROM (SELECT 1 + p_size / 1000000.0::DOUBLE AS f FROM part)
       UNION ALL SELECT 'none', 100, 1, 100""",
)
def global_reduce(spark, folder):
    """Sum, product and maximum with a start value, over all parts and over no rows at all."""
    parts = load(spark, folder, "part").select((1 + F.col("p_size") / F.lit(1_000_000.0)).alias("f"))
    everything = A.global_reduce(parts, "f", 100.0).withColumn("input", F.lit("all"))
    nothing = A.global_reduce(parts.filter("f < 0"), "f", 100.0).withColumn("input", F.lit("none"))
    both = everything.unionByName(nothing)
    return both.withColumns({"total": F.round("total", 6), "product": F.round("product", 9)})


@query(
    "top_record",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""",
)
def top_record(spark, folder):
    return A.top_record(
        load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice", "o_orderkey"
    )


@query(
    "group_collect",
    """SELECT c_nationkey, c_custkey // 100000 AS page, count(*) AS n_members,
              string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS members
       FROM customer GROUP BY ALL""",
    ints="n_members",
)
def group_collect(spark, folder):
    """Members of each nation as arrays; a page holds one range of 100,000 customer keys."""
    groups = A.collect_groups(
        load(spark, folder, "customer"), ["c_nationkey"], "c_custkey", F.floor(F.col("c_custkey") / 100_000)
    )
    return groups.select(
        "c_nationkey", "page", F.size("members").alias("n_members"), F.array_join("members", ",").alias("members")
    )


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, folder):
    return load(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query(
    "cardinality_ratio",
    """SELECT count(DISTINCT c_nationkey) AS n_nations, count(DISTINCT c_custkey) AS n_keys, count(*) AS n_rows,
              count(DISTINCT c_nationkey) / count(*) AS nation_ratio FROM customer""",
)
def cardinality_ratio(spark, folder):
    return (
        load(spark, folder, "customer")
        .agg(
            F.count_distinct("c_nationkey").alias("n_nations"),
            F.count_distinct("c_custkey").alias("n_keys"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .withColumn("nation_ratio", F.col("n_nations") / F.col("n_rows"))
    )


@query(
    "stat_aggregates",
    """SELECT l_returnflag, round(sum(l_quantity), 2) / count(*) AS mean, median(l_quantity) AS median,
              quantile_cont(l_quantity, 0.9) AS p90, round(stddev_samp(l_quantity), 6) AS std_sample,
              round(stddev_pop(l_quantity), 6) AS std_population,
              (SELECT l_quantity FROM lineitem i WHERE i.l_returnflag = o.l_returnflag GROUP BY 1
               ORDER BY count(*) DESC, 1 LIMIT 1) AS mode
       FROM lineitem o GROUP BY l_returnflag""",
)
def stat_aggregates(spark, folder):
    """Mean, median, a high quantile, both deviations and the smallest most common value."""
    lines = load(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    moments = lines.groupBy("l_returnflag").agg(
        A.money_avg("l_quantity").alias("mean"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("std_sample"),
        F.round(F.stddev_pop("l_quantity"), 6).alias("std_population"),
    )
    counts = lines.groupBy("l_returnflag", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    modes = counts.groupBy("l_returnflag").agg(
        F.min_by("l_quantity", F.struct((-F.col("n")).alias("n"), "l_quantity")).alias("mode")
    )
    places = exact_quantiles(lines, ["l_returnflag"], "l_quantity", {"median": 0.5, "p90": 0.9}).drop("n")
    return moments.join(places, "l_returnflag").join(modes, "l_returnflag")


@query(
    "exact_median",
    """SELECT o_orderstatus, median(o_totalprice) AS median_price, count(*) AS n FROM orders GROUP BY 1""",
)
def exact_median_query(spark, folder):
    """Exact median of a column with very many values, found by narrowing ranges."""
    return exact_median(load(spark, folder, "orders"), "o_orderstatus", "o_totalprice", "median_price")


@query(
    "total_spent",
    f"""WITH {D.GAPPY_ORDERS} SELECT c_custkey, coalesce(round(sum(o_totalprice), 2), 0) AS spent
        FROM customer LEFT JOIN gappy_orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def total_spent(spark, folder):
    """Every customer's total, 0 for one without orders."""
    sums = D.orders_with_gaps(spark, folder).groupBy("o_custkey").agg(A.money_sum("o_totalprice").alias("spent"))
    customers = load(spark, folder, "customer").select("c_custkey")
    return customers.join(sums, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("spent", F.lit(0.0)).alias("spent")
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_PIVOT = ", ".join(
    f"""coalesce(round(sum(o_totalprice) FILTER (o_orderpriority = '{p}'), 2), 0) AS "{p}" """ for p in PRIORITIES
)


@query("pivot_sum", f"SELECT o_orderstatus, {_PIVOT} FROM orders GROUP BY 1")
def pivot_sum(spark, folder):
    """Status by priority; a status without rows for a priority has 0 there."""
    return A.pivot_sum(load(spark, folder, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES, "o_totalprice")


@query(
    "partial_merge_agg",
    """SELECT l_returnflag, round(sum(l_quantity), 2) AS qty, count(*) AS n FROM lineitem GROUP BY 1""",
)
def partial_merge_agg(spark, folder):
    """Partial sums per ship month kept as a table, then merged: a run can resume from the parts."""
    lines = load(spark, folder, "lineitem")
    parts = stage(
        lines.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_returnflag").agg(
            F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n")
        ),
        "partials",
    )
    return parts.groupBy("l_returnflag").agg(A.money_sum("qty").alias("qty"), F.sum("n").alias("n"))


@query(
    "doc_match_group",
    f"""WITH {D.NESTED_ORDERS} SELECT o_orderpriority AS _id, count(*) AS orders, round(sum(total), 2) AS revenue,
          round(sum(total), 2) / count(*) AS average FROM nested
        WHERE status = 'F' AND total >= 100000 GROUP BY 1""",
)
def doc_match_group(spark, folder):
    """Match then group over documents, by a dotted path."""
    spec = {
        "_id": "$customer.terms.priority",
        "orders": {"$sum": 1},
        "revenue": {"$sum": "$total"},
        "average": {"$avg": "$total"},
    }
    out = match_group(D.order_documents(spark, folder), {"status": "F", "total": {"$gte": 100000}}, spec)
    return out.withColumn("revenue", F.round("revenue", 2)).withColumn("average", F.col("revenue") / F.col("orders"))


@query(
    "col_range",
    """SELECT 'l_quantity' AS "column", max(l_quantity) - min(l_quantity) AS value_range FROM lineitem
       UNION ALL SELECT 'l_extendedprice', max(l_extendedprice) - min(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_discount', max(l_discount) - min(l_discount) FROM lineitem""",
)
def col_range(spark, folder):
    return A.column_ranges(load(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "row_argmax",
    """SELECT o_custkey, CASE WHEN f >= o AND f >= p THEN 'F' WHEN o >= p THEN 'O' ELSE 'P' END AS best FROM (
         SELECT o_custkey, coalesce(round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2), 0) AS f,
                coalesce(round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2), 0) AS o,
                coalesce(round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2), 0) AS p FROM orders GROUP BY 1)""",
)
def row_argmax(spark, folder):
    wide = A.pivot_sum(load(spark, folder, "orders"), "o_custkey", "o_orderstatus", ["F", "O", "P"], "o_totalprice")
    return wide.select("o_custkey", A.row_argmax(["F", "O", "P"]).alias("best"))


@query(
    "run_groups",
    """WITH flagged AS (
         SELECT user_id, ts, event_id, event_type, value, CASE WHEN event_type IS DISTINCT FROM
           lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS new FROM events),
       numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run_no FROM flagged)
       SELECT user_id, run_no::BIGINT AS run_no, event_type, count(*) AS n, round(sum(value), 2) AS total
       FROM numbered GROUP BY ALL""",
)
def run_groups_query(spark, folder):
    """Runs of the same event type within a user's events."""
    events = load(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return run_groups(
        ordered(events, ["user_id"], ["ts", "event_id"]),
        "event_type",
        [F.count(F.lit(1)).alias("n"), A.money_sum("value").alias("total")],
    )


@query(
    "batch_kpi",
    """SELECT count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue,
              floor(round(sum(o_totalprice), 2) / count(*) * 100 + 0.5) / 100 AS average FROM orders""",
)
def batch_kpi(spark, folder):
    return (
        load(spark, folder, "orders")
        .agg(F.count(F.lit(1)).alias("n_orders"), A.money_sum("o_totalprice").alias("revenue"))
        .withColumn("average", F.floor(F.col("revenue") / F.col("n_orders") * 100 + 0.5) / 100)
    )


@query(
    "concat_agg",
    """SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1""",
)
def concat_agg(spark, folder):
    """Text of a group in one string; the distinct values are few however many rows there are."""
    return (
        load(spark, folder, "customer")
        .groupBy("c_nationkey")
        .agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "|").alias("segments"))
    )


@query(
    "map_merge",
    """SELECT o_custkey, string_agg(o_orderpriority || '=' || o_orderkey, ',' ORDER BY o_orderpriority) AS merged FROM (
         SELECT o_custkey, o_orderpriority, o_orderkey FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       GROUP BY 1""",
)
def map_merge(spark, folder):
    """Merge the one-entry maps of a customer's orders; for one key the latest order wins."""
    latest = (
        load(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderpriority")
        .agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("order"))
    )
    merged = F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "order")))
    entries = F.array_sort(F.map_entries("m"))
    text = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return latest.groupBy("o_custkey").agg(merged.alias("m")).select("o_custkey", F.array_join(text, ",").alias("merged"))


@query(
    "any_all",
    """SELECT l_returnflag, bool_or(l_discount > 0.09) AS any_deep, bool_and(l_quantity >= 1) AS all_positive,
              count(*) AS n, round(sum(l_quantity), 2) AS total, min(l_quantity) AS low, max(l_quantity) AS high
       FROM lineitem GROUP BY 1""",
)
def any_all(spark, folder):
    return (
        load(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.bool_or(F.col("l_discount") > 0.09).alias("any_deep"),
            F.bool_and(F.col("l_quantity") >= 1).alias("all_positive"),
            F.count(F.lit(1)).alias("n"),
            A.money_sum("l_quantity").alias("total"),
            F.min("l_quantity").alias("low"),
            F.max("l_quantity").alias("high"),
        )
    )


@query("distinct_derived", "SELECT DISTINCT upper(split_part(p_name, ' ', 2)) AS noun, length(p_type) AS type_len FROM part", ints="type_len")
def distinct_derived(spark, folder):
    return (
        load(spark, folder, "part")
        .select(F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("noun"), F.length("p_type").alias("type_len"))
        .distinct()
    )
