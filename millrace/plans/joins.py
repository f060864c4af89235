"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.operators.aggregate import money_sum
from millrace.operators.joins import merge_join, store_sorted
from millrace.operators.load import buckets_for, stored_bytes
from millrace.operators.sets import dedup
from millrace.operators.skew import broadcast_within, spread_join
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.tables import load


@query(
    "sales_by_region",
    """SELECT r_name AS region, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice), 2) / count(*) AS average,
              count(*) AS n_orders, strftime(min(o_orderdate), '%Y-%m-%d') AS first_date
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def sales_by_region(spark, folder):
    """Flagship: named aggregates per region over orders and three dimensions."""
    # pre-aggregated per customer, so the join with customers moves one row per customer
    per_customer = load(spark, folder, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first")
    )
    return (
        per_customer.join(load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(load(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region"))
        .agg(
            money_sum("total").alias("total"),
            (money_sum("total") / F.sum("n")).alias("average"),
            F.sum("n").alias("n_orders"),
            F.date_format(F.min("first"), "yyyy-MM-dd").alias("first_date"),
        )
    )


def _kind(spark, folder, how):
    orders, customers = load(spark, folder, "orders"), load(spark, folder, "customer")
    if how != "inner":  # these need keys without a partner
        orders, customers = D.orders_with_gaps(spark, folder), D.customers_with_gaps(spark, folder)
    orders = orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = customers.select(F.col("c_custkey").alias("custkey"), "c_name")
    return spread_join(orders, customers, ["custkey"], how)


def _kind_sql(how, key):
    return f"""WITH {D.GAPPY}, {D.GAPPY_ORDERS}
      SELECT {key} AS custkey, o_orderkey, c_name FROM gappy_orders {how} JOIN gappy ON o_custkey = c_custkey"""


@query(
    "join_inner",
    "SELECT o_custkey AS custkey, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(spark, folder):
    return _kind(spark, folder, "inner")


@query("join_left", _kind_sql("LEFT", "o_custkey"))
def join_left(spark, folder):
    return _kind(spark, folder, "left")


@query("join_right", _kind_sql("RIGHT", "c_custkey"))
def join_right(spark, folder):
    return _kind(spark, folder, "right")


@query("join_outer", _kind_sql("FULL", "coalesce(o_custkey, c_custkey)"))
def join_outer(spark, folder):
    return _kind(spark, folder, "outer")


@query(
    "join_diff_keys",
    "SELECT s_suppkey, n_nationkey, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def join_diff_keys(spark, folder):
    suppliers = load(spark, folder, "supplier")
    return J.join_on(suppliers, load(spark, folder, "nation"), {"s_nationkey": "n_nationkey"}).select(
        "s_suppkey", "n_nationkey", "n_name", "s_name"
    )


@query(
    "join_validate_m1",
    """SELECT o_orderkey, o_custkey AS custkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def join_validate_m1(spark, folder):
    """Fan-out guard: the dimension with copies is refused, the repaired one joins."""
    orders = load(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = load(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    copies = customers.withColumn(
        "seq", F.explode(F.when(F.col("custkey") % 50 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    try:
        J.validated_join(orders, copies, ["custkey"])
    except J.JoinKeyError:
        copies = dedup(copies, ["custkey"], ["seq"])
    return J.validated_join(orders, copies.drop("seq"), ["custkey"])


@query(
    "join_broadcast",
    """SELECT p_type, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n_lines
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""",
)
def join_broadcast(spark, folder):
    """Broadcast of a dimension whose size was checked; a bigger one is shuffled."""
    part = broadcast_within(load(spark, folder, "part").select("p_partkey", "p_type"))
    return (
        load(spark, folder, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type")
        .agg(money_sum("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("n_lines"))
    )


@query(
    "join_sortmerge",
    """SELECT o_orderpriority, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n_lines
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
)
def join_sortmerge(spark, folder):
    """Two large sides; lines are summed per order first, so the shuffle moves less and no order is hot."""
    per_order = (
        load(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("n"))
    )
    return (
        per_order.join(load(spark, folder, "orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderpriority")
        .agg(money_sum("revenue").alias("revenue"), F.sum("n").alias("n_lines"))
    )


@query(
    "join_merge_unique",
    """SELECT c_custkey AS id, c_acctbal AS left_value, spent AS right_value FROM customer JOIN (
         SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def join_merge_unique(spark, folder):
    """Merge join of two inputs with unique keys, both stored in buckets sorted by them."""
    left = load(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("left_value"))
    spent = money_sum("o_totalprice").alias("right_value")
    right = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("id")).agg(spent)
    buckets = buckets_for(stored_bytes(left))
    return merge_join(*(store_sorted(side, ["id"], buckets) for side in (left, right)), ["id"])


@query(
    "aligned_add",
    """WITH a AS (SELECT user_id, round(sum(value), 2) AS v FROM events WHERE event_type IN ('click', 'view') GROUP BY 1),
            b AS (SELECT user_id, round(sum(value), 2) AS v FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1)
       SELECT coalesce(a.user_id, b.user_id) AS user_id, a.v + b.v AS strict_total,
              coalesce(a.v, 0) + coalesce(b.v, 0) AS filled_total
       FROM a FULL JOIN b ON a.user_id = b.user_id""",
)
def aligned_add(spark, folder):
    """Add two keyed series; with and without a fill value for one-sided keys."""
    events = load(spark, folder, "events")
    per_user = [
        events.filter(period).groupBy("user_id").agg(money_sum("value").alias("v"))
        for period in ("event_type in ('click', 'view')", "event_type not in ('click', 'view')")
    ]
    strict = J.aligned_add(*per_user, "user_id", "v", "strict_total")
    return strict.join(J.aligned_add(*per_user, "user_id", "v", "filled_total", fill=0.0), "user_id")


@query(
    "cross_product",
    """SELECT s_nationkey, s_name, r_name FROM supplier, region""",
)
def cross_product(spark, folder):
    """Every supplier with every region."""
    suppliers = load(spark, folder, "supplier").select("s_nationkey", "s_name")
    return J.product(suppliers, load(spark, folder, "region").select("r_name"))


@query(
    "zip_join",
    """WITH a AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx FROM supplier),
            b AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer)
       SELECT idx, s_name, c_name FROM a JOIN b USING (idx)""",
)
def zip_join(spark, folder):
    suppliers = load(spark, folder, "supplier").select("s_suppkey", "s_name")
    customers = load(spark, folder, "customer").select("c_custkey", "c_name")
    return J.zip_rows(suppliers, customers, ["s_suppkey"], ["c_custkey"]).select("idx", "s_name", "c_name")


@query(
    "semi_join",
    f"""WITH {D.GAPPY} SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gappy)""",
)
def semi_join(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return J.member_of(orders, "o_custkey", D.customers_with_gaps(spark, folder), "c_custkey")


@query(
    "anti_join",
    f"""WITH {D.GAPPY}, {D.DIRTY_ORDERS} SELECT order_id, attempt, customer_id FROM dirty d
        WHERE NOT EXISTS (SELECT 1 FROM gappy WHERE c_custkey = d.customer_id)""",
)
def anti_join(spark, folder):
    """Orders whose customer is unknown; a missing customer is never known."""
    orders = D.dirty_orders(spark, folder).select("order_id", "attempt", "customer_id")
    return J.member_of(orders, "customer_id", D.customers_with_gaps(spark, folder), "c_custkey", negate=True)


@query(
    "big_spenders",
    """SELECT c_name, round(sum(o_totalprice), 2) AS spent, count(*) AS n_orders
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name HAVING sum(o_totalprice) > 2500000""",
)
def big_spenders(spark, folder):
    """Parent/child join with a bound threshold on the aggregate."""
    load(spark, folder, "orders").createOrReplaceTempView("m_orders")
    load(spark, folder, "customer").createOrReplaceTempView("m_customer")
    return spark.sql(
        """SELECT c_name, spent, n_orders
           FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent, count(*) AS n_orders
                 FROM m_orders GROUP BY o_custkey HAVING sum(o_totalprice) > :threshold)
           JOIN m_customer ON o_custkey = c_custkey""",
        args={"threshold": 2_500_000},
    )


@query(
    "join_composite",
    """WITH t AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS total_qty FROM lineitem GROUP BY ALL)
       SELECT l_orderkey, l.l_partkey, l.l_suppkey, l_quantity, total_qty FROM lineitem l
       JOIN t ON l.l_partkey = t.l_partkey AND l.l_suppkey = t.l_suppkey""",
)
def join_composite(spark, folder):
    """Lookup by a two-column key."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    totals = lines.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("total_qty"))
    return spread_join(lines, totals, ["l_partkey", "l_suppkey"])
