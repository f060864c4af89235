"""Missing data and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import clean as C
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import fresh_path
from millrace.tables import load

c = F.col
_MESSY = f"""WITH {D.DIRTY_ORDERS}, messy AS (
   SELECT order_id, attempt, customer_id, try_cast(price_text AS DOUBLE) AS price,
          CASE WHEN status <> 'F?' THEN status END AS status FROM dirty)"""


def _messy(spark, folder):
    return D.dirty_orders(spark, folder).select(
        "order_id",
        "attempt",
        "customer_id",
        c("price_text").try_cast("double").alias("price"),
        F.when(c("status") != "F?", c("status")).alias("status"),
    )


@query(
    "null_profile",
    _MESSY
    + "".join(
        f""" {u} SELECT order_id % 2 AS segment, '{x}' AS "column", count(*) - count({x}) AS n_null, count(*) AS n_rows,
             (count(*) - count({x})) / count(*) AS null_share FROM messy GROUP BY 1"""
        for u, x in (("", "customer_id"), ("UNION ALL", "price"), ("UNION ALL", "status"))
    ),
)
def null_profile(spark, folder):
    """Is missingness random? Null counts per column and segment."""
    messy = _messy(spark, folder).withColumn("segment", c("order_id") % 2)
    return C.null_profile(messy, ["customer_id", "price", "status"], by=["segment"])


@query(
    "null_marks",
    _MESSY
    + """ SELECT marks, count(*) AS n FROM (SELECT CASE WHEN customer_id IS NULL THEN 'X' ELSE '.' END ||
          CASE WHEN price IS NULL THEN 'X' ELSE '.' END || CASE WHEN status IS NULL THEN 'X' ELSE '.' END AS marks FROM messy)
        GROUP BY 1""",
)
def null_marks(spark, folder):
    marks = C.null_marks(["customer_id", "price", "status"])
    return _messy(spark, folder).groupBy(marks.alias("marks")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "dropna_modes",
    _MESSY
    + """, k AS (SELECT *, (customer_id IS NOT NULL)::INT + (price IS NOT NULL)::INT + (status IS NOT NULL)::INT AS n FROM messy)
        SELECT 'any' AS mode, order_id, attempt FROM k WHERE n = 3
        UNION ALL SELECT 'all', order_id, attempt FROM k WHERE n > 0
        UNION ALL SELECT 'subset', order_id, attempt FROM k WHERE customer_id IS NOT NULL AND status IS NOT NULL
        UNION ALL SELECT 'thresh', order_id, attempt FROM k WHERE n >= 2""",
)
def dropna_modes(spark, folder):
    df, checked = _messy(spark, folder), ["customer_id", "price", "status"]
    modes = {
        "any": df.na.drop("any", subset=checked),
        "all": df.na.drop("all", subset=checked),
        "subset": df.na.drop("any", subset=["customer_id", "status"]),
        "thresh": df.na.drop(thresh=2, subset=checked),
    }
    out = None
    for mode, kept in modes.items():
        part = kept.select(F.lit(mode).alias("mode"), "order_id", "attempt")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "fillna_stats",
    _MESSY
    + """, s AS (SELECT avg(price) AS mean, median(price) AS med, avg(coalesce(price, 0)) AS zero_mean FROM messy),
         m AS (SELECT status AS common FROM messy WHERE status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT order_id, attempt, coalesce(customer_id, -1) AS customer_id, round(coalesce(price, mean), 4) AS by_mean,
               coalesce(price, med) AS by_median, coalesce(price, 0) AS by_zero, coalesce(status, common) AS status
        FROM messy, s, m""",
)
def fillna_stats(spark, folder):
    """Fill by constant, mean, median and most common value."""
    df = _messy(spark, folder)
    df = df.withColumns({"by_mean": c("price"), "by_median": c("price"), "by_zero": c("price")}).drop("price")
    rules = {"customer_id": -1, "by_mean": "mean", "by_median": "median", "by_zero": 0.0, "status": "mode"}
    return C.fill_nulls(df, rules).withColumn("by_mean", F.round("by_mean", 4))


@query(
    "nan_to_null",
    """SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN value END AS value, event_id % 9 = 0 AS was_nan,
              CASE WHEN event_id % 9 <> 0 THEN true END AS equals_itself FROM events""",
)
def nan_to_null(spark, folder):
    """NaN becomes null, so that equality with it is never true."""
    value = F.when(c("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(c("value"))
    events = load(spark, folder, "events").select("event_id", value.alias("value"))
    return C.nan_to_null(events).select(
        "event_id", "value", c("value").isNull().alias("was_nan"), (c("value") == c("value")).alias("equals_itself")
    )


#: What the suppliers' export writes where it knows nothing.
UNKNOWN = ["", "-", "?", "tba"]


@query(
    "clean_messy_csv",
    """WITH t AS (SELECT s_suppkey AS supplier_no, s_name AS label,
            CASE WHEN s_suppkey % 5 <> 3 THEN 1 + s_suppkey % 9 END AS grade,
            CASE WHEN s_suppkey % 8 <> 6 THEN DATE '2011-03-01' + (s_suppkey % 700)::INT END AS since,
            CASE WHEN s_suppkey % 12 <> 7 THEN s_acctbal END AS balance FROM supplier)
       SELECT supplier_no, label, grade, strftime(since, '%Y-%m-%d') AS since, balance,
              CASE WHEN grade IS NULL OR since IS NULL OR balance IS NULL THEN 'quarantine' ELSE 'good' END AS target FROM t""",
)
def clean_messy_csv(spark, folder):
    """A messy export through CSV: trim, markers to null, two date formats, quarantine."""
    k = c("s_suppkey")
    day = F.date_add(F.lit("2011-03-01").cast("date"), (k % 700).cast("int"))
    export = load(spark, folder, "supplier").select(
        k.cast("string").alias("supplier_no"),
        F.concat(F.lit(" "), c("s_name"), F.lit("   ")).alias("label"),
        F.when(k % 5 == 3, "?").otherwise((k % 9 + 1).cast("string")).alias("grade"),
        F.when(k % 8 == 6, "tba").when(k % 3 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(day.cast("string")).alias("since"),
        F.when(k % 12 == 7, "-").otherwise(c("s_acctbal").cast("string")).alias("balance"),
    )
    path = fresh_path(spark, "messy-csv")
    export.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    raw = spark.read.schema(", ".join(f"{x} string" for x in export.columns)).csv(path, header=True)
    trimmed = raw.withColumns({x: F.trim(x) for x in raw.columns})
    known = trimmed.withColumns({x: F.when(~c(x).isin(UNKNOWN), c(x)) for x in raw.columns})
    cleaned = known.select(
        c("supplier_no").try_cast("bigint").alias("supplier_no"),
        "label",
        c("grade").try_cast("bigint").alias("grade"),
        dates.parse_date(c("since")).alias("since"),
        c("balance").try_cast("double").alias("balance"),
    )
    good, bad = C.split_complete(cleaned, ["grade", "since", "balance"])
    both = good.withColumn("target", F.lit("good")).unionByName(bad.withColumn("target", F.lit("quarantine")))
    return both.withColumn("since", F.date_format("since", "yyyy-MM-dd"))


@query(
    "clean_order_feed",
    f"""WITH {D.DIRTY_ORDERS}, d AS (SELECT order_id, attempt, customer_id, try_cast(price_text AS DOUBLE) AS amount FROM dirty
          QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY attempt DESC) = 1),
        k AS (SELECT * FROM d WHERE customer_id IS NOT NULL)
        SELECT order_id, attempt, customer_id, coalesce(amount, (SELECT median(amount) FROM k)) AS amount FROM k""",
)
def clean_order_feed(spark, folder):
    """Last copy per order, no rows without a customer, missing amounts by the median."""
    feed = D.dirty_orders(spark, folder).select(
        "order_id", "attempt", "customer_id", c("price_text").try_cast("double").alias("amount")
    )
    return C.clean_order_feed(feed, "order_id", ["attempt"], ["order_id", "customer_id"], "amount")


@query(
    "ingest_repair",
    """SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CASE WHEN l_linenumber = 3 THEN 0 ELSE l_quantity END AS qty
       FROM lineitem WHERE l_orderkey % 13 <> 0""",
)
def ingest_repair(spark, folder):
    """Rows with a malformed price go, a missing quantity becomes 0."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(c("l_orderkey") % 13 == 0, "12,x").otherwise(c("l_extendedprice").cast("string")).alias("price"),
        F.when(c("l_linenumber") != 3, c("l_quantity")).alias("qty"),
    )
    return C.repair_ingest(lines, "price", "qty")


def _int_sql(x, kind, size):
    sizes = [(n, s) for n, s in C.INTEGERS if s <= size]
    cases = " ".join(
        f"WHEN min({x}) >= {-(1 << (8 * s - 1))} AND max({x}) < {1 << (8 * s - 1)} THEN '{n}'" for n, s in sizes[:-1]
    )
    return f"SELECT '{x}' AS c, '{kind}' AS f, CASE {cases} ELSE '{kind}' END AS t, NULL::DOUBLE AS share, count(*) AS n FROM lineitem"


def _float_sql(x):
    return f"""SELECT '{x}', 'double', CASE WHEN count(*) FILTER ({x}::FLOAT::DOUBLE <> {x}) = 0 THEN 'float' ELSE 'double' END,
               NULL, count(*) FROM lineitem"""


def _time_sql(x):
    return f"""SELECT '{x}', 'timestamp_ntz', CASE WHEN count(*) FILTER (date_trunc('day', {x}) <> {x}) = 0 THEN 'date' ELSE 'timestamp_ntz' END,
               NULL, count(*) FROM lineitem"""


def _text_sql(x):
    return f"""SELECT '{x}', 'string', CASE WHEN count(DISTINCT {x}) / count(*) < 0.5 THEN 'category' ELSE 'string' END,
               count(DISTINCT {x}) / count(*), count(*) FROM lineitem"""


_WIDTHS = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in C.WIDTH.items()) + "}"


@query(
    "narrow_schema",
    "WITH r AS ("
    + " UNION ALL ".join(
        [_int_sql(x, "bigint", 8) for x in ("l_orderkey", "l_partkey", "l_suppkey")]
        + [_int_sql("l_linenumber", "int", 4)]
        + [_float_sql(x) for x in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
        + [_text_sql(x) for x in ("l_returnflag", "l_linestatus")]
        + [_time_sql("l_shipdate")]
    )
    + f""") SELECT c AS "column", f AS from_type, t AS to_type, share AS distinct_share,
           {_WIDTHS}[f] * n AS bytes_before, {_WIDTHS}[t] * n AS bytes_after FROM r""",
)
def narrow_schema(spark, folder):
    """Smallest exact type per column, and what it saves."""
    return C.narrowing_report(load(spark, folder, "lineitem"))
