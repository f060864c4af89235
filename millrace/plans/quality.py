"""Data quality queries."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import quality as Q
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import fresh_path, stage
from millrace.tables import load

c = F.col


def shipments(spark, folder):
    """Order lines as they come in: unread discounts, unknown suppliers, unnamed parts, sums that are off, and copies."""
    part, order = c("l_partkey"), c("l_orderkey")
    sent = F.explode(F.when(part % 59 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        load(spark, folder, "lineitem")
        .withColumn("sent", sent)
        .select(
            order.alias("order_no"),
            c("l_linenumber").alias("line_no"),
            "sent",
            F.when(part % 53 != 0, part).alias("part_no"),
            F.when(c("l_suppkey") % 19 == 0, c("l_suppkey") + 1_000_000_000).otherwise(c("l_suppkey")).alias("supplier_no"),
            F.when(order % 41 == 0, "?").otherwise(F.format_string("%.2f", "l_discount")).alias("discount_text"),
            F.when(order % 97 == 0, "X").otherwise(c("l_returnflag")).alias("flag"),
            c("l_extendedprice").alias("gross"),
            (c("l_extendedprice") * (1 - c("l_discount")) + F.when(part % 61 == 0, 30.0).otherwise(0.0)).alias("net"),
            F.date_format("l_shipdate", "yyyy-MM").alias("month"),
        )
    )


def shipment_rules(spark, folder):
    """What a shipment line must be, in the order of the reports."""
    discount = c("discount_text").try_cast("double")
    return [
        Q.Expect("supplier_on_file", "stop", listed=("supplier_no", load(spark, folder, "supplier"), "s_suppkey")),
        Q.Expect("net_follows_gross", "note", holds=F.abs(c("net") - c("gross") * (1 - discount)) < 10),
        Q.Expect("line_sent_once", "stop", single=("order_no", "line_no")),
        Q.Expect("discount_readable", "stop", holds=discount.between(0, 0.5)),
        Q.Expect("part_named", "note", holds=c("part_no").isNotNull()),
        Q.Expect("flag_in_use", "stop", holds=c("flag").isin("A", "N", "R")),
        Q.Expect("batch_not_empty", "stop", size=(1, 10**15)),
    ]


SHIPMENTS = """shipments AS (
  SELECT l_orderkey AS order_no, l_linenumber AS line_no, sent, CASE WHEN l_partkey % 53 <> 0 THEN l_partkey END AS part_no,
         CASE WHEN l_suppkey % 19 = 0 THEN l_suppkey + 1000000000 ELSE l_suppkey END AS supplier_no,
         CASE WHEN l_orderkey % 41 = 0 THEN '?' ELSE printf('%.2f', l_discount) END AS discount_text,
         CASE WHEN l_orderkey % 97 = 0 THEN 'X' ELSE l_returnflag END AS flag, l_extendedprice AS gross,
         l_extendedprice * (1 - l_discount) + CASE WHEN l_partkey % 61 = 0 THEN 30.0::DOUBLE ELSE 0 END AS net,
         strftime(l_shipdate, '%Y-%m') AS month
  FROM lineitem, (SELECT unnest([0, 1])::INT AS sent) s WHERE sent = 0 OR l_partkey % 59 = 0)"""
_RULES = {
    "supplier_on_file": ("stop", "coalesce(supplier_no IN (SELECT s_suppkey FROM supplier), false)"),
    "net_follows_gross": ("note", "coalesce(abs(net - gross * (1 - try_cast(discount_text AS DOUBLE))) < 10, false)"),
    "line_sent_once": ("stop", "count(*) OVER (PARTITION BY order_no, line_no) = 1"),
    "discount_readable": ("stop", "coalesce(try_cast(discount_text AS DOUBLE) BETWEEN 0 AND 0.5, false)"),
    "part_named": ("note", "part_no IS NOT NULL"),
    "flag_in_use": ("stop", "coalesce(flag IN ('A', 'N', 'R'), false)"),
    "batch_not_empty": ("stop", "true"),
}
AUDITED = f"""WITH {SHIPMENTS}, judged AS (
  SELECT *, {", ".join(f"{sql} AS {name}" for name, (_, sql) in _RULES.items())} FROM shipments)"""
BROKEN = "concat_ws(', ', " + ", ".join(f"CASE WHEN NOT {name} THEN '{name}' END" for name in _RULES) + ")"


@query(
    "dq_report",
    AUDITED
    + " UNION ALL ".join(
        f""" SELECT {i} AS line, '{n}' AS rule, '{level}' AS level, count(*) FILTER (NOT {n}) AS n_broken, count(*) AS n_rows,
             count(*) FILTER (NOT {n}) = 0 AS met FROM judged"""
        for i, (n, (level, _)) in enumerate(_RULES.items())
    ),
)
def dq_report(spark, folder):
    """Every rule over every row."""
    return Q.audit(shipments(spark, folder), shipment_rules(spark, folder)).summary()


@query("dq_clean", AUDITED + f" SELECT order_no, line_no, sent, net FROM judged WHERE {BROKEN} = ''")
def dq_clean(spark, folder):
    found = Q.audit(shipments(spark, folder), shipment_rules(spark, folder))
    return found.accepted().select("order_no", "line_no", "sent", "net")


@query("dq_rejects", AUDITED + f" SELECT order_no, line_no, sent, {BROKEN} AS broken FROM judged WHERE {BROKEN} <> ''")
def dq_rejects(spark, folder):
    """Refused rows with the rules they break."""
    found = Q.audit(shipments(spark, folder), shipment_rules(spark, folder)).refused()
    return found.select("order_no", "line_no", "sent", F.array_join("broken_rules", ", ").alias("broken"))


@query(
    "dq_invariants",
    """SELECT 'as sent' AS batch, 'usable' AS outcome, (SELECT count(*) FROM lineitem) AS n_rows
       UNION ALL SELECT 'untaxed', 'absent: l_tax', count(*) FROM lineitem
       UNION ALL SELECT 'anonymous', 'too empty: l_suppkey (0% filled)', count(*) FROM lineitem""",
)
def dq_invariants(spark, folder):
    """Batches that are stopped as a whole: a column is gone, or holds nothing."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_tax")
    batches = {
        "as sent": lines,
        "untaxed": lines.drop("l_tax"),
        "anonymous": lines.withColumn("l_suppkey", F.lit(None).cast("bigint")),
    }
    rows = []
    for name, batch in batches.items():
        try:
            Q.refuse_unusable(batch, ["l_orderkey", "l_tax"], {"l_orderkey": 0.5, "l_suppkey": 0.1})
            outcome = "usable"
        except Q.BatchRefused as refusal:
            outcome = str(refusal)
        n_rows = batch.agg(F.count(F.lit(1)).alias("n_rows"))
        rows.append(n_rows.select(F.lit(name).alias("batch"), F.lit(outcome).alias("outcome"), "n_rows"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "schema_diff",
    """SELECT * FROM (VALUES ('origin.host', 'added', NULL, 'string', NULL::BOOLEAN), ('props', 'absent', 'string', NULL, NULL),
         ('value', 'retyped', 'double', 'string', true), ('user_id', 'retyped', 'bigint', 'string', false),
         ('event_type', 'retyped', 'string', 'int', true)) t(field, change, expected, found, fits)
       WHERE EXISTS (FROM events)""",
)
def schema_diff(spark, folder):
    """The next batch of events against the declared schema, tried on all its values."""
    events = load(spark, folder, "events")
    batch = events.drop("props").withColumns(
        {
            "origin": F.struct(F.lit("a.example").alias("host")),
            "value": c("value").cast("string"),
            "user_id": F.concat(F.lit("u"), c("user_id").cast("string")),
            "event_type": F.length("event_type"),
        }
    )
    return Q.schema_changes(events.schema, batch)


@query(
    "freshness_volume",
    """SELECT o_orderstatus AS batch, count(*) AS n_rows, strftime(max(o_orderdate), '%Y-%m-%d') AS newest,
              count(*) FILTER (datediff('day', o_orderdate::DATE, DATE '2001-08-01') > 2) AS n_stale,
              count(*) BETWEEN 5000 AND 1000000000000 AS volume_ok,
              CASE WHEN count(*) BETWEEN 5000 AND 1000000000000 THEN 'load' ELSE 'skip' END AS branch
       FROM orders GROUP BY 1
       UNION ALL SELECT 'truncated', count(*), strftime(max(o_orderdate), '%Y-%m-%d'),
              count(*) FILTER (datediff('day', o_orderdate::DATE, DATE '2001-08-01') > 2), false, 'skip'
       FROM orders WHERE o_totalprice > 499000""",
)
def freshness_volume(spark, folder):
    """Staleness and size band per batch; the gate chooses to load or to skip."""
    orders = load(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    batches = {status: orders.filter(c("o_orderstatus") == status) for status in "FOP"}
    low = {"truncated": 10**12}
    batches["truncated"] = orders.filter("o_totalprice > 499000")
    out = None
    for name, batch in batches.items():
        row = Q.freshness_volume(batch, "day", "2001-08-01", 2, low.get(name, 5000), 10**12).withColumn("batch", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out.withColumns(
        {"newest": F.date_format("newest", "yyyy-MM-dd"), "branch": F.when(c("volume_ok"), "load").otherwise("skip")}
    )


#: The contract of an event as it arrives.
EVENT_FIELDS = [
    Q.Field("event", "bigint"),
    Q.Field("kind", "string"),
    Q.Field("reading", "double", minimum=5),
    Q.Field("user", "bigint", required=False),
    Q.Field("urgent", "boolean", required=False, default=False),
    Q.Field("channel", "string", required=False, default="web"),
]


def _arrivals(spark, folder):
    """Events as JSON: numbers as text, readings that are missing, small or no numbers, fields nobody asked for."""
    k = c("event_id")
    whole = F.floor("value").cast("bigint").cast("string")
    record = F.struct(
        k.cast("string").alias("event"),
        F.when(k % 21 != 0, c("event_type")).alias("kind"),
        F.when(k % 29 == 0, "much").when(k % 17 != 0, whole).alias("reading"),
        F.when(k % 13 != 0, c("user_id")).alias("user"),
        F.when(k % 4 == 0, k % 8 == 0).alias("urgent"),
        F.when(k % 6 == 0, "app").alias("channel"),
        F.when(k % 37 == 0, "x").alias("trace"),
    )
    return load(spark, folder, "events").select("event_id", F.to_json(record).alias("document"))


@query(
    "record_validate",
    """WITH r AS (SELECT event_id AS k, CASE WHEN event_id % 21 <> 0 THEN event_type END AS kind,
         CASE WHEN event_id % 29 = 0 THEN 'much' WHEN event_id % 17 <> 0 THEN floor(value)::BIGINT::VARCHAR END AS reading,
         CASE WHEN event_id % 13 <> 0 THEN user_id END AS "user", CASE WHEN event_id % 4 = 0 THEN event_id % 8 = 0 ELSE false END AS urgent,
         CASE WHEN event_id % 6 = 0 THEN 'app' ELSE 'web' END AS channel FROM events)
       SELECT k AS event_id, k AS event, kind, try_cast(reading AS DOUBLE) AS reading, "user", urgent, channel, concat_ws('; ',
         CASE WHEN kind IS NULL THEN 'kind: field required' END, CASE WHEN reading IS NULL THEN 'reading: field required' END,
         CASE WHEN reading = 'much' THEN 'reading: not a valid double' END,
         CASE WHEN try_cast(reading AS DOUBLE) < 5 THEN 'reading: must be at least 5' END) AS errors FROM r""",
)
def record_validate(spark, folder):
    """Coercion, defaults, required fields and bounds, with all errors of each record."""
    out = Q.validate_records(_arrivals(spark, folder), "document", EVENT_FIELDS).drop("document")
    text = F.transform("errors", lambda e: F.concat_ws(": ", e["field"], e["reason"]))
    return out.withColumn("errors", F.array_join(text, "; "))


@query(
    "unknown_fields",
    """SELECT event_id, CASE WHEN event_id % 37 = 0 THEN 'trace' ELSE '' END AS extra,
              event_id % 37 = 0 AS rejected, true AS rename_found FROM events""",
)
def unknown_fields(spark, folder):
    """Fields outside the contract, refused in strict mode; a renamed field shows as missing."""
    strict = Q.validate_records(_arrivals(spark, folder), "document", EVENT_FIELDS, unknown="forbid")
    strict = strict.select("event_id", "document", c("errors").alias("strict_errors"))
    later = [Q.Field("measure", f.kind, f.required) if f.name == "reading" else f for f in EVENT_FIELDS]
    both = Q.validate_records(strict, "document", later)
    extra = F.filter("strict_errors", lambda e: e["reason"] == "unknown field")
    return both.select(
        "event_id",
        F.array_join(F.transform(extra, lambda e: e["field"]), ",").alias("extra"),
        (F.size(extra) > 0).alias("rejected"),
        F.exists("errors", lambda e: (e["field"] == "measure") & (e["reason"] == "field required")).alias("rename_found"),
    )


@query(
    "file_batch_status",
    """WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, day(ts) AS n, round(sum(value), 2) AS amount FROM events GROUP BY ALL)
       SELECT day AS file, CASE WHEN n % 6 IN (1, 2, 3, 4) THEN 'failed' ELSE 'loaded' END AS status,
         CASE n % 6 WHEN 1 THEN 'not valid JSON' WHEN 2 THEN 'id is missing' WHEN 3 THEN 'amount is not a number'
                    WHEN 4 THEN 'amount is negative' END AS reason,
         CASE WHEN n % 6 IN (0, 5) THEN amount END AS amount FROM d""",
)
def file_batch_status(spark, folder):
    """One file per day, some broken: a bad file is skipped with a reason, the batch goes on."""
    daily = load(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(F.round(F.sum("value"), 2).alias("amount"))
    n = F.dayofmonth("day") % 6
    document = F.to_json(
        F.struct(
            F.when(n != 2, F.date_format("day", "yyyyMMdd").cast("int")).alias("id"),
            F.when(n == 3, "many").when(n == 4, F.format_string("-%.2f", "amount")).otherwise(
                F.format_string("%.2f", "amount")
            ).alias("amount"),
        )
    )
    text = F.when(n == 1, F.concat(F.lit("{broken "), document)).otherwise(document)
    path = fresh_path(spark, "day-files")
    daily.select(F.date_format("day", "yyyy-MM-dd").alias("file"), text.alias("value")).write.partitionBy("file").text(path)
    from millrace.sources.files import file_batch

    return file_batch(spark, path).select("file", "status", "reason", "amount")


@query(
    "run_metrics",
    f"""WITH {D.DIRTY_ORDERS}, r AS (SELECT CASE WHEN try_cast(price_text AS DOUBLE) IS NULL THEN 'price is not a number'
            WHEN customer_id IS NULL THEN 'no customer' END AS reason FROM dirty)
        SELECT 'loaded' AS metric, count(*) AS n FROM r WHERE reason IS NULL
        UNION ALL SELECT 'failed', count(*) FROM r WHERE reason IS NOT NULL
        UNION ALL SELECT 'failed: ' || reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY reason""",
)
def run_metrics(spark, folder):
    """Counts taken while the run writes its rows, and the reasons of the rejected ones."""
    reason = F.when(c("price_text").try_cast("double").isNull(), "price is not a number").when(
        c("customer_id").isNull(), "no customer"
    )
    run = Observation("orders_run")
    marked = D.dirty_orders(spark, folder).withColumn("reason", reason)
    observed = marked.observe(
        run,
        F.count_if(c("reason").isNull()).alias("loaded"),
        F.count_if(c("reason").isNotNull()).alias("failed"),
    )
    written = stage(observed, "run")
    counts = spark.createDataFrame([(k, int(v)) for k, v in run.get.items()], "metric string, n bigint")
    reasons = (
        written.filter("reason is not null")
        .groupBy(F.concat(F.lit("failed: "), c("reason")).alias("metric"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.unionByName(reasons)
