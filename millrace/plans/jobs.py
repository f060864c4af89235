"""Whole jobs: extract, transform, check, load."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.strings import clean_price
from millrace.operators import quality as Q
from millrace.operators.aggregate import money_sum
from millrace.operators.joins import map_with_default
from millrace.operators.load import KeyedTable, replace_partitions
from millrace.operators.select import RangeStep
from millrace.operators.sets import dedup
from millrace.plans import derived as D
from millrace.plans.quality import AUDITED, BROKEN, shipment_rules, shipments
from millrace.plans.registry import query
from millrace.plans.sources import PAGE_ROWS, write_pages
from millrace.session import fresh_path, stage
from millrace.sources import files, paged
from millrace.tables import load

c = F.col


@query(
    "etl_end_to_end",
    f"""SELECT 'loaded' AS outcome, o_orderkey AS id, o_totalprice AS amount, 'uncategorized' AS category,
              floor(o_totalprice / 1000)::BIGINT AS thousands, NULL AS error FROM orders
       WHERE o_orderkey // {PAGE_ROWS} % 7 <> 3 AND o_totalprice >= 2000
       UNION ALL SELECT DISTINCT 'page given up', o_orderkey // {PAGE_ROWS}, NULL, NULL, NULL, '503 from the server' FROM orders
       WHERE o_orderkey // {PAGE_ROWS} % 7 = 3""",
)
def etl_end_to_end(spark, folder):
    """Paged extract, validation, defaults and derived fields, upsert; two runs, one table, and the pages that were given up."""
    path = write_pages(spark, folder)
    schema = "id bigint, amount double, category string, thousands bigint"
    table = KeyedTable(spark, fresh_path(spark, "etl"), schema, ("id",)).create(spark.createDataFrame([], schema))
    lost = fresh_path(spark, "dead-letters")
    fields = [
        Q.Field("o_orderkey", "bigint"),
        Q.Field("o_totalprice", "double", minimum=2000),
        Q.Field("category", "string", required=False, default="uncategorized"),
    ]
    for _ in range(2):
        raw = paged.fetch(spark, path, wait=0.01)
        paged.dead_letters(raw, lost)
        records = raw.filter("status = 'ok'").select(c("record").alias("document"))
        checked = Q.validate_records(records, "document", fields).filter(F.size("errors") == 0)
        ready = checked.select(
            c("o_orderkey").alias("id"),
            c("o_totalprice").alias("amount"),
            "category",
            F.floor(c("o_totalprice") / 1000).alias("thousands"),
        )
        table.upsert(ready, ["amount"])
    given_up = spark.read.schema("page int, error string").parquet(lost)
    return (
        table.read()
        .withColumn("outcome", F.lit("loaded"))
        .unionByName(
            given_up.select(c("page").cast("bigint").alias("id"), "error", F.lit("page given up").alias("outcome")),
            allowMissingColumns=True,
        )
    )


@query(
    "etl_gated",
    AUDITED
    + f""" SELECT 'loaded' AS target, month AS part, count(*) AS n FROM judged WHERE {BROKEN} = '' GROUP BY 2
          UNION ALL SELECT 'rejected', {BROKEN}, count(*) FROM judged WHERE {BROKEN} <> '' GROUP BY {BROKEN}""",
)
def etl_gated(spark, folder):
    """Hard stops first, then good rows to the table by month and the others to the rejects."""
    batch = Q.refuse_unusable(shipments(spark, folder), ["order_no", "supplier_no", "net", "flag"], {"order_no": 0.5, "net": 0.5})
    accepted, rejected = Q.audit(batch, shipment_rules(spark, folder)).split()
    good_path, reject_path = fresh_path(spark, "good"), fresh_path(spark, "rejects")
    replace_partitions(accepted, good_path, ["month"])
    rejected.write.parquet(reject_path)
    n = F.count(F.lit(1)).alias("n")
    loaded = spark.read.schema("order_no bigint, month string").parquet(good_path)
    refused = spark.read.schema("order_no bigint, broken_rules array<string>").parquet(reject_path)
    reasons = refused.groupBy(F.array_join("broken_rules", ", ").alias("part")).agg(n)
    return loaded.groupBy(c("month").alias("part")).agg(n).withColumn("target", F.lit("loaded")).unionByName(
        reasons.withColumn("target", F.lit("rejected"))
    )


@query(
    "etl_typed",
    """WITH t AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 27 <> 5 THEN o_totalprice END AS amount, upper(r_name) AS region FROM orders
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
       SELECT id, CASE WHEN id % 4 = 0 AND amount IS NULL THEN 1.0 ELSE amount END AS amount,
              CASE WHEN id % 4 = 0 AND amount IS NULL THEN 'BEFORE' ELSE region END AS region,
              CASE WHEN amount IS NULL THEN 'no number: on request' END AS error
       FROM t WHERE amount IS NOT NULL OR id % 4 = 0
       UNION ALL SELECT id, NULL, region, 'no number: on request' FROM t WHERE amount IS NULL AND id % 4 <> 0""",
)
def etl_typed(spark, folder):
    """Texts from CSV upserted into a typed table; a line whose amount is no number is an error, and the table keeps what it had."""
    source = (
        load(spark, folder, "orders")
        .join(load(spark, folder, "customer"), c("o_custkey") == c("c_custkey"))
        .join(load(spark, folder, "nation"), c("c_nationkey") == c("n_nationkey"))
        .join(load(spark, folder, "region"), c("n_regionkey") == c("r_regionkey"))
        .select(
            c("o_orderkey").cast("string").alias("id"),
            F.when(c("o_orderkey") % 27 == 5, "on request")
            .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
            .alias("amount"),
            F.lower("r_name").alias("region"),
        )
    )
    path = files.write(source, "csv", fresh_path(spark, "typed-in"))
    raw = files.read(spark, "csv", path, "id string, amount string, region string")
    typed = stage(
        raw.select(
            c("id").cast("bigint").alias("id"),
            clean_price(c("amount"))["amount"].alias("amount"),
            F.upper("region").alias("region"),
            F.col("amount").alias("text"),
        ),
        "typed",
    )
    before = typed.filter("id % 4 = 0").select("id", F.lit(1.0).alias("amount"), F.lit("BEFORE").alias("region"))
    table = KeyedTable(spark, fresh_path(spark, "typed"), "id bigint, amount double, region string", ("id",)).create(before)
    table.upsert(typed.filter("amount is not null").select("id", "amount", "region"), ["amount"])
    errors = typed.filter("amount is null").select(
        c("id").alias("bad_id"), c("region").alias("bad_region"), F.concat(F.lit("no number: "), "text").alias("error")
    )
    both = table.read().join(errors, c("id") == c("bad_id"), "outer")
    return both.select(F.coalesce("id", "bad_id").alias("id"), "amount", F.coalesce("region", "bad_region").alias("region"), "error")


@query(
    "etl_volume_branch",
    """SELECT 'F' AS batch, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 0
       UNION ALL SELECT 'O', count(*) FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 0
       UNION ALL SELECT 'P', count(*) FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 0""",
)
def etl_volume_branch(spark, folder):
    """Batches in the size band are loaded, the others skipped."""
    orders, path = load(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate")), fresh_path(spark, "volume")
    batches = {"F": "o_orderstatus = 'F'", "O": "o_orderstatus = 'O'", "P": "o_orderstatus = 'P'", "tiny": "o_totalprice > 499900"}
    low = {"tiny": 10**12}
    for name, condition in batches.items():
        batch = orders.filter(condition).filter("o_totalprice >= 0")
        gate = Q.freshness_volume(batch, "day", "2001-08-01", 2, low.get(name, 1), 10**15).first()
        if gate["volume_ok"]:
            replace_partitions(batch.select("o_orderkey", F.lit(name).alias("batch")), path, ["batch"])
    stored = spark.read.schema("o_orderkey bigint, batch string").parquet(path)
    return stored.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query(
    "etl_partitioned_files",
    """SELECT o_orderpriority AS priority, year(o_orderdate) AS year, count(*) AS n, round(sum(net), 2) AS total FROM (
         SELECT *, o_totalprice * CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS net FROM orders)
       WHERE net BETWEEN 50000 AND 400000 GROUP BY ALL""",
    ints="year",
)
def etl_partitioned_files(spark, folder):
    """Files per year, a discount, a filter, totals by two keys, output by one of them."""
    source, target = fresh_path(spark, "yearly"), fresh_path(spark, "totals")
    orders = load(spark, folder, "orders")
    orders.withColumn("year", F.year("o_orderdate")).select("o_orderpriority", "o_totalprice", "year").write.partitionBy(
        "year"
    ).csv(source, header=True)
    rows = files.read(spark, "csv", source, "o_orderpriority string, o_totalprice double, year int")
    rate = F.when(c("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.5)
    totals = (
        rows.withColumn("net", c("o_totalprice") * rate)
        .transform(RangeStep("net", 50000, 400000))
        .groupBy(c("o_orderpriority").alias("priority"), "year")
        .agg(F.count(F.lit(1)).alias("n"), money_sum("net").alias("total"))
    )
    replace_partitions(totals, target, ["year"])
    return spark.read.schema("priority string, n bigint, total double, year int").parquet(target)


_NET = "l_extendedprice::DECIMAL(15,2) * l_quantity::DECIMAL(10,2) * (1 - l_discount::DECIMAL(4,2))"


@query(
    "etl_normalize_orders",
    f"""WITH {D.DIRTY_ORDERS} SELECT l_orderkey, l_linenumber, CASE status WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial'
          ELSE 'unknown' END AS state, round(l_extendedprice::DECIMAL(15,2), 2)::DOUBLE AS price, round({_NET}, 2)::DOUBLE AS line_total,
          l_extendedprice * l_quantity > 1500000 AND l_discount < 0.05 AS is_priority
        FROM lineitem JOIN dirty ON order_id = l_orderkey WHERE attempt = 0""",
)
def etl_normalize_orders(spark, folder):
    """State labels, a flag for large lines of low discount, exact line totals, and both amounts rounded; an order sent again counts once."""
    orders = dedup(D.dirty_orders(spark, folder), ["order_id"], ["attempt"]).select("order_id", "status")
    labels = {"F": "finished", "O": "open", "P": "partial"}
    named = map_with_default(orders, "status", labels, "unknown", "state").drop("status")
    price, quantity = c("l_extendedprice").cast("decimal(15,2)"), c("l_quantity").cast("decimal(10,2)")
    amounts = {"price": price, "line_total": price * quantity * (1 - c("l_discount").cast("decimal(4,2)"))}
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        ((c("l_extendedprice") * c("l_quantity") > 1_500_000) & (c("l_discount") < 0.05)).alias("is_priority"),
        *[F.round(x, 2).cast("double").alias(name) for name, x in amounts.items()],
    )
    joined = lines.join(named, c("l_orderkey") == c("order_id"))
    return joined.select("l_orderkey", "l_linenumber", "state", "price", "line_total", "is_priority")
