"""Sort and top-k queries. A sorted result is given as a global rank, so order can be compared."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.ordered import global_index
from millrace.plans.registry import query
from millrace.tables import load


def _ranked(name, table, key, order_sql, order):
    """Register a sort of ``table`` and the rank each row gets."""
    sql = f"SELECT {key}, row_number() OVER (ORDER BY {order_sql}) AS pos FROM {table}"

    @query(name, sql)
    def run(spark, folder):
        return global_index(load(spark, folder, table), order(), "pos", start=1).select(key, "pos")

    return run


c = F.col
_ranked("sort_one", "orders", "o_orderkey", "o_totalprice DESC, o_orderkey", lambda: [F.desc("o_totalprice"), F.asc("o_orderkey")])
_ranked(
    "sort_multi",
    "orders",
    "o_orderkey",
    "o_orderstatus, o_totalprice DESC, o_orderkey",
    lambda: [F.asc("o_orderstatus"), F.desc("o_totalprice"), F.asc("o_orderkey")],
)
# equal priorities keep the earlier (date, key) order
_ranked(
    "sort_stable",
    "orders",
    "o_orderkey",
    "o_orderpriority, o_orderdate, o_orderkey",
    lambda: [F.asc("o_orderpriority"), F.asc("o_orderdate"), F.asc("o_orderkey")],
)
_ranked(
    "sort_derived",
    "part",
    "p_partkey",
    "length(p_name), lower(p_type), p_partkey",
    lambda: [F.length("p_name"), F.lower("p_type"), c("p_partkey")],
)
_ranked(
    "sort_comparator",
    "part",
    "p_partkey",
    "length(p_type), p_type, p_partkey",
    lambda: [F.length("p_type"), c("p_type"), c("p_partkey")],
)


@query(
    "sort_map_entries",
    """WITH t AS (SELECT o_custkey, o_orderpriority AS p, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY ALL)
       SELECT o_custkey, string_agg(p, ',' ORDER BY p) AS by_key, string_agg(p, ',' ORDER BY v DESC, p) AS by_value
       FROM t GROUP BY 1""",
)
def sort_map_entries(spark, folder):
    """Entries of a map (priority to total, per customer) sorted by key and by value."""
    totals = (
        load(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderpriority")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    )
    maps = totals.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "v"))).alias("m")
    )
    entries = F.map_entries("m")
    by_key = F.transform(F.array_sort(entries), lambda e: e["key"])
    ranked = F.array_sort(F.transform(entries, lambda e: F.struct((-e["value"]).alias("v"), e["key"].alias("k"))))
    by_value = F.transform(ranked, lambda e: e["k"])
    return maps.select("o_custkey", F.array_join(by_key, ",").alias("by_key"), F.array_join(by_value, ",").alias("by_value"))


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "top_k_per_group",
    """SELECT o_orderstatus, o_orderkey, o_totalprice, rn FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
       WHERE rn <= 3""",
    ints="rn",
)
def top_k_per_group(spark, folder):
    """Best three per group; Spark cuts each task's rows to three per group before the shuffle."""
    best = Window.partitionBy("o_orderstatus").orderBy(F.desc("o_totalprice"), "o_orderkey")
    orders = load(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return orders.withColumn("rn", F.row_number().over(best)).filter("rn <= 3")


@query(
    "first_match",
    """SELECT 'big' AS search, (SELECT o_orderkey FROM orders WHERE o_totalprice > 490000 ORDER BY o_orderkey LIMIT 1) AS o_orderkey,
              CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 490000) THEN 'found' ELSE 'not found' END AS outcome
       UNION ALL
       SELECT 'impossible', (SELECT o_orderkey FROM orders WHERE o_totalprice < 0 ORDER BY o_orderkey LIMIT 1),
              CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) THEN 'found' ELSE 'not found' END""",
)
def first_match(spark, folder):
    """First row that meets a condition, with an else branch when none does."""
    orders = load(spark, folder, "orders")
    wanted = {"big": F.col("o_totalprice") > 490000, "impossible": F.col("o_totalprice") < 0}
    firsts = orders.agg(*[F.min(F.when(test, F.col("o_orderkey"))).alias(name) for name, test in wanted.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("search"), F.col(name).alias("o_orderkey")) for name in wanted])
    found = firsts.select(F.explode(rows).alias("r")).select("r.*")
    return found.withColumn("outcome", F.when(F.col("o_orderkey").isNull(), "not found").otherwise("found"))
