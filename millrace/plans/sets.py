"""Set operations, concatenation and deduplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import sets as S
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.tables import load

_SETS = f"WITH {D.GAPPY}, {D.GAPPY_ORDERS}, a AS (SELECT o_custkey AS k FROM gappy_orders), b AS (SELECT c_custkey AS k FROM gappy)"


def _sides(spark, folder):
    left = D.orders_with_gaps(spark, folder).select(F.col("o_custkey").alias("k"))
    return left, D.customers_with_gaps(spark, folder).select(F.col("c_custkey").alias("k"))


def _whole(spark, folder):
    orders, customers = load(spark, folder, "orders"), load(spark, folder, "customer")
    return orders.select(F.col("o_custkey").alias("k")), customers.select(F.col("c_custkey").alias("k"))


@query("set_union", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def set_union(spark, folder):
    a, b = _whole(spark, folder)
    return a.union(b).distinct()


@query("set_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer")
def set_intersect(spark, folder):
    a, b = _whole(spark, folder)
    return a.distinct().intersect(b.distinct())


@query(
    "set_difference",
    _SETS + " SELECT k, 'missing' AS what FROM (SELECT k FROM a EXCEPT SELECT k FROM b)"
    " UNION ALL SELECT k, 'extra' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)",
)
def set_difference(spark, folder):
    """Keys the target misses and keys it has too many."""
    a, b = _sides(spark, folder)
    a, b = a.distinct(), b.distinct()
    return a.subtract(b).withColumn("what", F.lit("missing")).union(b.subtract(a).withColumn("what", F.lit("extra")))


@query(
    "set_symdiff",
    _SETS + " SELECT k, 'left' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b)"
    " UNION ALL SELECT k, 'right' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)",
)
def set_symdiff(spark, folder):
    return S.symmetric_difference(*_sides(spark, folder), "k")


_RELATIONS = """SELECT '{0}' AS input, NOT EXISTS (SELECT k FROM {1} EXCEPT SELECT k FROM {2}) AS is_subset,
    NOT EXISTS (SELECT k FROM {2} EXCEPT SELECT k FROM {1}) AS is_superset, NOT EXISTS (SELECT k FROM {1} INTERSECT SELECT k FROM {2}) AS is_disjoint,
    NOT EXISTS (SELECT k FROM {1} EXCEPT SELECT k FROM {2}) AND NOT EXISTS (SELECT k FROM {2} EXCEPT SELECT k FROM {1}) AS is_equal"""


@query(
    "set_relations",
    _SETS
    + """, o AS (SELECT o_custkey AS k FROM orders), c AS (SELECT c_custkey AS k FROM customer), s AS (SELECT -1 - s_suppkey AS k FROM supplier) """
    + " UNION ALL ".join(
        _RELATIONS.format(*x) for x in (("orders in customers", "o", "c"), ("customers twice", "c", "c"), ("other numbers", "c", "s"), ("with gaps", "a", "b"))
    ),
)
def set_relations(spark, folder):
    """Keys of whole tables, of numbers that no customer has, and of two inputs with gaps on both sides."""
    orders, customers = _whole(spark, folder)
    others = load(spark, folder, "supplier").select((-1 - F.col("s_suppkey")).alias("k"))
    sides = {
        "orders in customers": (orders, customers),
        "customers twice": (customers, customers),
        "other numbers": (customers, others),
        "with gaps": _sides(spark, folder),
    }
    out = None
    for name, (a, b) in sides.items():
        part = S.set_relations(a, b, "k").withColumn("input", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "concat_rows",
    """SELECT row_number() OVER (ORDER BY src, k) - 1 AS row_id, k, name, balance FROM (
         SELECT 0 AS src, s_suppkey AS k, s_name AS name, s_acctbal AS balance FROM supplier
         UNION ALL SELECT 1, c_custkey, c_name, NULL FROM customer)""",
)
def concat_rows(spark, folder):
    """Stack two tables with different columns and number the rows afresh."""
    c = F.col
    suppliers = load(spark, folder, "supplier").select(
        c("s_suppkey").alias("k"), c("s_name").alias("name"), c("s_acctbal").alias("balance")
    )
    customers = load(spark, folder, "customer").select(c("c_custkey").alias("k"), c("c_name").alias("name"))
    return S.concat_rows([suppliers, customers], ["k"])


@query(
    "concat_cols",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders WHERE o_custkey % 7 <> 0 GROUP BY 1),
            b AS (SELECT c_custkey AS k, c_acctbal FROM customer WHERE c_custkey % 10 <> 0)
       SELECT coalesce(a.k, b.k) AS k, n_orders, c_acctbal FROM a FULL JOIN b ON a.k = b.k""",
)
def concat_cols(spark, folder):
    """Put columns of two keyed tables side by side, aligned on the key."""
    a, _ = _sides(spark, folder)
    counts = a.groupBy("k").agg(F.count(F.lit(1)).alias("n_orders"))
    b = D.customers_with_gaps(spark, folder).select(F.col("c_custkey").alias("k"), "c_acctbal")
    return counts.join(b, "k", "outer")


@query("dedup_exact", "SELECT DISTINCT text, lang FROM documents")
def dedup_exact(spark, folder):
    return S.dedup_exact(load(spark, folder, "documents"), ["text", "lang"])


@query(
    "dedup_first",
    """SELECT doc_id, source, n_chars, dropped FROM (
         SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY text) - 1 AS dropped
         FROM documents) WHERE rn = 1""",
)
def dedup_first(spark, folder):
    """First document per text, with the number of later copies dropped."""
    documents = load(spark, folder, "documents").select("doc_id", "source", "n_chars", "text")
    # the digest stands for the text, so the shuffle does not move whole texts
    keyed = documents.withColumn("digest", F.sha2("text", 256)).drop("text")
    return S.dedup_with_count(keyed, ["digest"], ["doc_id"]).drop("digest")


@query(
    "dedup_last",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt, customer_id, price_text, status FROM dirty
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY attempt DESC) = 1""",
)
def dedup_last(spark, folder):
    """Last attempt per order of a feed with retries."""
    feed = D.dirty_orders(spark, folder).select("order_id", "attempt", "customer_id", "price_text", "status")
    return S.dedup(feed, ["order_id"], ["attempt"], keep="last")


@query(
    "mark_duplicates",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt,
          row_number() OVER (PARTITION BY order_id ORDER BY attempt) > 1 AS dup_keep_first,
          row_number() OVER (PARTITION BY order_id ORDER BY attempt DESC) > 1 AS dup_keep_last,
          count(*) OVER (PARTITION BY order_id) > 1 AS dup_all FROM dirty""",
)
def mark_duplicates(spark, folder):
    feed = D.dirty_orders(spark, folder).select("order_id", "attempt")
    return S.mark_duplicates(feed, ["order_id"], ["attempt"])
