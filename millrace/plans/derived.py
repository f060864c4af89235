"""Inputs derived from the given tables, once for Spark and once as SQL.

The tables are clean; dirt, gaps, copies and hot keys come from key arithmetic so
that both sides see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.skew import collect_pages
from millrace.tables import SCHEMAS, load


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with bad prices, missing customers, doubtful states, and retried copies."""
    key = F.col("o_orderkey")
    price = F.format_string("%.2f", F.when(key % 31 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    return (
        load(spark, folder, "orders")
        .withColumn("attempt", F.explode(F.when(key % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            key.alias("order_id"),
            "attempt",
            F.when(key % 23 != 0, F.col("o_custkey")).alias("customer_id"),
            F.when(key % 17 == 0, F.lit("N/A")).otherwise(price).alias("price_text"),
            F.when(key % 29 == 0, F.lit("F?")).otherwise(F.col("o_orderstatus")).alias("status"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
            F.col("o_orderpriority").alias("priority"),
        )
    )


DIRTY_ORDERS = """dirty AS (
  SELECT o_orderkey AS order_id, attempt,
         CASE WHEN o_orderkey % 23 <> 0 THEN o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 17 = 0 THEN 'N/A'
              ELSE printf('%.2f', CASE WHEN o_orderkey % 31 = 0 THEN -o_totalprice ELSE o_totalprice END) END AS price_text,
         CASE WHEN o_orderkey % 29 = 0 THEN 'F?' ELSE o_orderstatus END AS status,
         strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_orderpriority AS priority
  FROM orders, (SELECT unnest([0, 1])::INT AS attempt) a WHERE attempt = 0 OR o_orderkey % 11 = 0)"""


def customers_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without every tenth one, so that joins have unmatched rows."""
    return load(spark, folder, "customer").filter("c_custkey % 10 <> 0")


GAPPY = "gappy AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0)"


def orders_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "orders").filter("o_custkey % 7 <> 0")


GAPPY_ORDERS = "gappy_orders AS (SELECT * FROM orders WHERE o_custkey % 7 <> 0)"


def hot_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which nine in ten belong to one customer."""
    return load(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("account "), F.col("o_custkey").cast("string")))
        .otherwise("house account")
        .alias("customer"),
        "o_custkey",
        "o_totalprice",
    )


HOT_ORDERS = """hot AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'account ' || o_custkey ELSE 'house account' END AS customer,
         o_custkey, o_totalprice FROM orders)"""


def sparse_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in which half of the values are missing."""
    return load(spark, folder, "events").withColumn(
        "value", F.when(~(F.col("event_id") % 4).isin(1, 2), F.col("value"))
    )


SPARSE_EVENTS = """sparse AS (
  SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 4 NOT IN (1, 2) THEN value END AS value FROM events)"""


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as log lines; every hundredth is malformed."""
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    good = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit(" "),
        level,
        F.lit(" event_id="),
        F.col("event_id").cast("string"),
        F.lit(" user="),
        F.col("user_id").cast("string"),
        F.lit(" action="),
        F.col("event_type"),
        F.lit(" message=value "),
        F.format_string("%.2f", "value"),
    )
    bad = F.concat(F.lit("corrupt "), F.col("event_id").cast("string"))
    return load(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 100 == 99, bad).otherwise(good).alias("line")
    )


LOG_LINES = """lines AS (
  SELECT event_id, CASE WHEN event_id % 100 = 99 THEN 'corrupt ' || event_id ELSE
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END
    || ' event_id=' || event_id || ' user=' || user_id || ' action=' || event_type
    || ' message=value ' || printf('%.2f', value) END AS line FROM events)"""

ITEMS_PER_DOCUMENT = 10_000


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One document per order with its customer fields, for what doesn't ask for items."""
    return load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.struct(
            F.col("o_custkey").alias("id"),
            F.struct(F.col("o_orderpriority").alias("priority")).alias("terms"),
        ).alias("customer"),
    )


def nested_orders(spark: SparkSession, folder: str, items_per_document: int = ITEMS_PER_DOCUMENT) -> DataFrame:
    """One document per order: customer fields and the sorted array of its items.

    An order with more lines than fit one document continues in further documents
    with other numbers in ``page``; each order has a page 0. So no array grows
    without bound, and what asks for all items must look at all pages. Lines go to
    a page by their place in the file, which a retried task reproduces.
    """
    lines = (
        spark.read.schema(SCHEMAS["lineitem"])
        .parquet(f"{folder}/lineitem.parquet")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("partkey"),
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("price"),
        )
    )
    item = F.struct("partkey", "qty", "price")
    place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    items = collect_pages(lines, ["order_id"], item, place, items_per_document, "items")
    return (
        order_documents(spark, folder)
        .join(items, "order_id", "left")
        .withColumn("page", F.coalesce("page", F.lit(0)))
        .withColumn("items", F.coalesce("items", F.array().cast("array<struct<partkey:bigint,qty:double,price:double>>")))
    )


NESTED_ORDERS = """nested AS (
  SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total, o_custkey, o_orderpriority,
         coalesce(list_sort(items), []) AS items
  FROM orders LEFT JOIN (
    SELECT l_orderkey, list(struct_pack(partkey := l_partkey, qty := l_quantity, price := l_extendedprice)) AS items
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    """New balances for every seventh customer, and one new customer for each of them."""
    changed = load(spark, folder, "customer").filter("c_custkey % 7 = 0")
    update = changed.withColumn("c_acctbal", F.lit(1.0) * F.col("c_custkey"))
    fresh = changed.withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000_000).withColumn("c_acctbal", F.lit(0.0))
    return update.unionByName(fresh)


CUSTOMER_CHANGES = """changes AS (
  SELECT * REPLACE (c_custkey * 1.0::DOUBLE AS c_acctbal) FROM customer WHERE c_custkey % 7 = 0
  UNION ALL
  SELECT * REPLACE (c_custkey + 1000000000000 AS c_custkey, 0.0::DOUBLE AS c_acctbal) FROM customer WHERE c_custkey % 7 = 0)"""
