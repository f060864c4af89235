"""Idempotent loads and changes of tables and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import documents as M
from millrace.operators.aggregate import money_sum
from millrace.operators.load import (
    KeyedTable,
    Ledger,
    LoadRejected,
    append,
    atomic_load,
    backfill,
    read_loads,
    replace_partitions,
)
from millrace.operators.ordered import missing_days
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import fresh_path
from millrace.tables import SCHEMAS, load

c = F.col
DAILY = "event_id bigint, user_id bigint, value double, day string"


def _daily(spark, folder):
    return load(spark, folder, "events").select(
        "event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )


_PER_DAY = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events"


def _per_day(df):
    return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"), money_sum("value").alias("total"))


@query("load_partition_replace", _PER_DAY + " GROUP BY 1")
def load_partition_replace(spark, folder):
    """Load by day, then load again: the second run changes nothing."""
    path, events = fresh_path(spark, "by-day"), _daily(spark, folder)
    replace_partitions(events, path, ["day"])
    replace_partitions(events.filter("day >= '2024-01-15'"), path, ["day"])
    return _per_day(spark.read.schema(DAILY).parquet(path))


@query(
    "load_upsert",
    f"""WITH {D.CUSTOMER_CHANGES} SELECT * FROM changes
        UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM changes)""",
)
def load_upsert(spark, folder):
    """Changes and new customers into a table with a unique key, applied twice."""
    table = KeyedTable(spark, fresh_path(spark, "customers"), SCHEMAS["customer"], ("c_custkey",))
    table.create(load(spark, folder, "customer"))
    changes = D.customer_changes(spark, folder)
    for _ in range(2):
        table.upsert(changes, ["c_acctbal"])
    return table.read()


@query(
    "load_insert_ignore",
    f"""WITH {D.CUSTOMER_CHANGES} SELECT c_custkey, c_acctbal, strict FROM (
          SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0
          UNION ALL SELECT c_custkey, c_acctbal FROM changes
            WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)),
        (SELECT 'a key of the batch is already in the table' AS strict)""",
)
def load_insert_ignore(spark, folder):
    """Known keys keep their row, unknown ones are added; the strict form refuses the batch."""
    table = KeyedTable(spark, fresh_path(spark, "customers"), SCHEMAS["customer"], ("c_custkey",))
    table.create(load(spark, folder, "customer").filter("c_custkey % 2 = 0"))
    changes = D.customer_changes(spark, folder)
    table.insert_if_absent(changes, ["c_acctbal"])
    try:
        table.insert_strict(changes)
        strict = "inserted"
    except LoadRejected as error:
        strict = str(error)
    return table.read().select("c_custkey", "c_acctbal", F.lit(strict).alias("strict"))


@query(
    "apply_once",
    """SELECT user_id, round(sum(value), 2) + 100 AS balance, count(*) AS n_applied FROM events
       WHERE event_type = 'purchase' GROUP BY 1""",
)
def apply_once(spark, folder):
    """Credits in three overlapping batches, one of them sent twice: each counts once."""
    credits = load(spark, folder, "events").filter("event_type = 'purchase'").select("event_id", "user_id", "value")
    table = KeyedTable(
        spark, fresh_path(spark, "ledger"), "event_id bigint, user_id bigint, value double", ("event_id",)
    ).create(credits.limit(0))
    ledger = Ledger(table, "user_id", "value")
    first, second = credits.filter("event_id % 3 < 2"), credits.filter("event_id % 3 > 0")
    for batch in (first, second.unionByName(second), first):
        ledger.apply(batch, ["event_id"])
    return ledger.balances(100.0)


@query("append_doubles", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def append_doubles(spark, folder):
    """Appending the same batch twice doubles it, which is why the loads above replace."""
    path, events = fresh_path(spark, "appended"), load(spark, folder, "events").select("event_id", "event_type")
    for _ in range(2):
        append(events, path)
    stored = spark.read.schema("event_id bigint, event_type string").parquet(path)
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("daily_summary", _PER_DAY + " GROUP BY 1")
def daily_summary(spark, folder):
    """Compute a summary without side effects, then commit it; two commits leave one row per day."""
    summary, path = _per_day(_daily(spark, folder)), fresh_path(spark, "summary")
    for _ in range(2):
        replace_partitions(summary, path, ["day"])
    return spark.read.schema("n bigint, total double, day string").parquet(path)


@query(
    "atomic_load",
    """SELECT 'a' AS load_id, count(*) AS n, 'rejected' AS second_load FROM orders WHERE o_orderkey % 2 = 0""",
)
def atomic_load_query(spark, folder):
    """A batch with one bad part leaves the target as it was."""
    path, orders = fresh_path(spark, "atomic"), load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    valid = c("o_totalprice") > 0
    atomic_load(orders.filter("o_orderkey % 2 = 0"), path, "a", ["o_orderkey"], valid)
    odd = orders.filter("o_orderkey % 2 = 1")
    broken = odd.withColumn("o_totalprice", F.when(c("o_orderkey") % 99 != 1, c("o_totalprice")))
    try:
        atomic_load(broken, path, "b", ["o_orderkey"], valid)
        outcome = "loaded"
    except LoadRejected:
        outcome = "rejected"
    stored = read_loads(spark, path, "o_orderkey bigint, o_totalprice double")
    return stored.groupBy("load_id").agg(F.count(F.lit(1)).alias("n")).withColumn("second_load", F.lit(outcome))


@query(
    "retry_safe_load",
    """SELECT c_custkey, c_acctbal, 'one' AS load FROM customer WHERE c_custkey % 3 > 0
       UNION ALL SELECT c_custkey, c_acctbal, 'two' FROM customer WHERE c_custkey % 3 = 0""",
)
def retry_safe_load(spark, folder):
    """Two named loads of a strict table, the first sent again after its success, as a caller does that never heard of it."""
    customers = load(spark, folder, "customer").select("c_custkey", "c_acctbal")
    schema = "c_custkey bigint, c_acctbal double, load string"
    table = KeyedTable(spark, fresh_path(spark, "strict"), schema, ("c_custkey",))
    table.create(spark.createDataFrame([], schema))
    one = customers.filter("c_custkey % 3 > 0").withColumn("load", F.lit("one"))
    two = customers.filter("c_custkey % 3 = 0").withColumn("load", F.lit("two"))
    for rows, name in ((one, "one"), (one, "one"), (two, "two")):
        table.insert_strict(rows, load=name)
    return table.read()


@query(
    "backfill_days",
    _PER_DAY + " WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' OR day(ts) % 4 = 0 GROUP BY 1",
)
def backfill_days(spark, folder):
    """Find the days of a window that are not loaded and load them, each replaceable."""
    path, events = fresh_path(spark, "backfill"), _daily(spark, folder)
    replace_partitions(events.filter("int(substr(day, 9, 2)) % 4 = 0"), path, ["day"])
    loaded = spark.read.schema(DAILY).parquet(path).select(c("day").cast("date").alias("day"))
    gaps = missing_days(loaded, "day", "2024-01-05", "2024-01-20")
    backfill(events, path, "day", gaps.select(c("day").cast("string").alias("day")))
    return _per_day(spark.read.schema(DAILY).parquet(path))


@query(
    "doc_find",
    f"""WITH {D.NESTED_ORDERS} SELECT 'range' AS search, order_id FROM nested WHERE total > 100000 AND total <= 200000 AND status <> 'P'
        UNION ALL SELECT 'in', order_id FROM nested WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND total >= 300000
        UNION ALL SELECT 'missing', order_id FROM nested WHERE total < 5000
        UNION ALL SELECT 'null', order_id FROM nested WHERE total < 3000""",
)
def doc_find(spark, folder):
    """Query operators on plain and dotted paths; a field nobody has is missing."""
    documents = D.order_documents(spark, folder)
    searches = {
        "range": {"total": {"$gt": 100000, "$lte": 200000}, "status": {"$ne": "P"}},
        "in": {"customer.terms.priority": {"$in": ["1-URGENT", "2-HIGH"]}, "total": {"$gte": 300000}},
        "missing": {"gift.note": {"$ne": "x"}, "total": {"$lt": 5000}},
        "nothing": {"gift.note": {"$gt": 1}},
        "null": {"gift": None, "total": {"$lt": 3000}},
    }
    out = None
    for name, search in searches.items():
        part = M.find(documents, search).select(F.lit(name).alias("search"), "order_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "doc_update",
    f"""WITH {D.NESTED_ORDERS} SELECT order_id, CASE WHEN order_id = 77 THEN 'replaced' WHEN total > 300000 THEN 'big' ELSE status END AS status,
          CASE WHEN order_id <> 77 THEN total END AS total,
          CASE WHEN order_id <> 77 AND status = 'P' AND total <= 300000 THEN 5 END AS revisions,
          CASE WHEN order_id <> 77 AND total >= 10000 THEN o_orderpriority END AS priority,
          CASE WHEN order_id <> 77 THEN len(items) + CASE WHEN order_id = (SELECT min(order_id) FROM nested WHERE status = 'F' AND total <= 300000)
            THEN 1 ELSE 0 END END AS n_items FROM nested""",
    ints="n_items",
)
def doc_update(spark, folder):
    """Set, increment, unset, push, and replace; all matches or the first one."""
    docs = D.nested_orders(spark, folder)
    docs = M.update(docs, {"total": {"$gt": 300000}}, {"$set": {"status": "big"}})
    docs = M.update(docs, {"status": "P"}, {"$inc": {"revisions": 2}})
    docs = M.update(docs, {"status": "P"}, {"$inc": {"revisions": 3}})
    docs = M.update(docs, {"total": {"$lt": 10000}}, {"$unset": ["customer.terms.priority"]})
    item = F.struct(F.lit(0).alias("partkey"), F.lit(1).alias("qty"), F.lit(0).alias("price"))
    # every order has a page 0, so the new item lands once
    docs = M.update(docs, {"status": "F", "page": 0}, {"$push": {"items": item}}, first_by=["order_id"])
    docs = M.replace(docs, {"order_id": 77}, {"status": "replaced"}, key="order_id")
    whole = docs.groupBy("order_id").agg(
        F.max("status").alias("status"),
        F.max("total").alias("total"),
        F.max("revisions").alias("revisions"),
        F.max("customer.terms.priority").alias("priority"),
        F.sum(F.when(c("items").isNotNull(), F.size("items"))).cast("int").alias("n_items"),
    )
    return whole


@query(
    "doc_delete",
    f"""WITH {D.NESTED_ORDERS} SELECT order_id FROM nested WHERE status <> 'P'
          AND order_id <> (SELECT min(order_id) FROM nested WHERE total > 200000 AND status = 'O')""",
)
def doc_delete(spark, folder):
    """Delete the first match, and all matches."""
    docs = M.delete(D.order_documents(spark, folder), {"total": {"$gt": 200000}, "status": "O"}, first_by=["order_id"])
    return M.delete(docs, {"status": "P"}).select("order_id")


@query(
    "schema_evolve",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderkey % 2 = 0 THEN 'gift' ELSE 'none' END AS wrap,
              o_orderdate < TIMESTAMP '1998-01-01' OR o_orderkey % 2 = 1 AS was_missing FROM orders""",
)
def schema_evolve(spark, folder):
    """Later files carry a field the earlier ones lack; it reads as missing, then gets a default."""
    orders, path = load(spark, folder, "orders"), fresh_path(spark, "evolving")
    base = orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    is_new = c("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    append(base.filter(~is_new).drop("o_orderdate"), path)
    wrap = F.when(c("o_orderkey") % 2 == 0, "gift")
    append(base.filter(is_new).withColumn("wrap", wrap).drop("o_orderdate"), path)
    stored = spark.read.schema("o_orderkey bigint, o_totalprice double, wrap string").parquet(path)
    return M.evolve([stored.withColumn("was_missing", c("wrap").isNull())], {"wrap": "none"})
