"""Partitioning, skew, user code and SQL queries."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.operators import custom as U
from millrace.operators import skew as K
from millrace.operators import tables as T
from millrace.operators.aggregate import money_sum
from millrace.operators.partitions import partition_counts, plan_facts
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import shared, stage
from millrace.tables import load

c = F.col


@query(
    "partition_counts",
    """SELECT layout, n_partitions, (SELECT count(*) FROM orders) AS n_rows
       FROM (VALUES ('round_robin', 8), ('by_key', 8), ('merged', 2)) t(layout, n_partitions)""",
)
def partition_counts_query(spark, folder):
    """Rows per partition after spreading evenly, by key, and after merging partitions."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    layouts = {
        "round_robin": orders.repartition(8),
        "by_key": orders.repartition(8, "o_custkey"),
        "merged": orders.repartition(8).coalesce(2),
    }
    out = None
    for name, df in layouts.items():
        counts = partition_counts(df)
        n_rows = next(x for x in counts.columns if x != "partition")
        part = counts.agg(F.count(F.lit(1)).cast("int").alias("n_partitions"), F.sum(n_rows).alias("n_rows")).withColumn("layout", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


_PROFILE = """SELECT {name} AS input, sum(n)::BIGINT AS n_rows, count(*) AS n_keys, arg_min(k, (-n, k)) AS hot_key, max(n) AS hot_rows,
  max(n) / sum(n) AS hot_share FROM (SELECT {key} AS k, count(*) AS n FROM {table} GROUP BY 1)"""
_PROFILES = (
    _PROFILE.format(name="'orders'", key="o_custkey::VARCHAR", table="orders").replace("arg_min(k, (-n, k))", "arg_min(k, (-n, k::BIGINT))"),
    _PROFILE.format(name="'hot'", key="customer", table="hot"),
)


def _profiles(spark, folder, measure):
    orders = load(spark, folder, "orders")
    plain = measure(orders, "o_custkey").withColumn("input", F.lit("orders"))
    hot = measure(D.hot_orders(spark, folder), "customer").withColumn("input", F.lit("hot"))
    return plain.withColumn("hot_key", c("hot_key").cast("string")), hot


@query("skew_profile", f"WITH {D.HOT_ORDERS} " + " UNION ALL ".join(_PROFILES))
def skew_profile(spark, folder):
    plain, hot = _profiles(spark, folder, K.skew_profile)
    return plain.unionByName(hot)


@query(
    "needs_salting",
    f"WITH {D.HOT_ORDERS}, p AS (" + " UNION ALL ".join(_PROFILES) + """)
      SELECT input, hot_share >= 0.2 AS salt FROM p UNION ALL SELECT 'empty', false""",
)
def needs_salting(spark, folder):
    """Salt when one key holds a fifth of the rows or more; never for an empty table."""
    plain, hot = _profiles(spark, folder, K.needs_salting)
    nothing = K.needs_salting(load(spark, folder, "orders").filter("o_orderkey < 0"), "o_custkey")
    empty = nothing.withColumn("input", F.lit("empty"))
    return plain.select("input", "salt").unionByName(hot.select("input", "salt")).unionByName(empty.select("input", "salt"))


_HOT_SUM = f"""WITH {D.HOT_ORDERS} SELECT customer, round(sum(o_totalprice), 2) AS total, count(*) AS n_rows FROM hot GROUP BY 1"""


@query("salted_sum", _HOT_SUM)
def salted_sum(spark, folder):
    """Sum per (key, salt), then per key; equal to the direct sum."""
    out = K.salted_sum(D.hot_orders(spark, folder), "customer", "o_totalprice", ["o_orderkey"], 16, "total")
    return out.withColumn("total", F.round("total", 2))


@query("skew_aware_sum", _HOT_SUM)
def skew_aware_sum(spark, folder):
    """Look at the key first, then choose the plan."""
    out = K.skew_aware_sum(D.hot_orders(spark, folder), "customer", "o_totalprice", ["o_orderkey"], "total")
    return out.withColumn("total", F.round("total", 2))


@query(
    "salted_join",
    f"""WITH {D.HOT_ORDERS}, dim AS (SELECT customer, round(sum(o_totalprice), 2) AS total FROM hot GROUP BY 1)
        SELECT o_orderkey, h.customer, o_totalprice, total FROM hot h JOIN dim d ON h.customer = d.customer""",
)
def salted_join(spark, folder):
    """Join in which nine rows in ten have one key."""
    orders = D.hot_orders(spark, folder).drop("o_custkey")
    totals = orders.groupBy("customer").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return K.salted_join(orders, totals, ["customer"], ["o_orderkey"], rows_per_task=5_000)


@query(
    "skew_broadcast_join",
    f"""WITH {D.HOT_ORDERS}, dim AS (SELECT customer, round(sum(o_totalprice), 2) AS total FROM hot GROUP BY 1)
        SELECT o_orderkey, h.customer, o_totalprice, total FROM hot h JOIN dim d ON h.customer = d.customer""",
)
def skew_broadcast_join(spark, folder):
    """The same join without moving the skewed side at all: the other side is stored, and sent whole as its bytes are few."""
    orders = D.hot_orders(spark, folder).drop("o_custkey")
    totals = stage(orders.groupBy("customer").agg(F.round(F.sum("o_totalprice"), 2).alias("total")), "totals")
    return orders.join(K.broadcast_within(totals), "customer").select("o_orderkey", "customer", "o_totalprice", "total")


@query(
    "plan_inspection",
    """SELECT plan, shuffles, broadcasts, sorts, python_steps, (SELECT count(*) FROM orders) AS n_orders FROM (VALUES
         ('filter', 0, 0, 0, 0), ('sum by key', 1, 0, 0, 0), ('merge join', 2, 0, 2, 0), ('broadcast join', 0, 1, 0, 0), ('blocks in Python', 0, 0, 0, 1))
       t(plan, shuffles, broadcasts, sorts, python_steps)""",
)
def plan_inspection(spark, folder):
    """What plans are going to do, read off before they run."""
    orders, customers = load(spark, folder, "orders"), load(spark, folder, "customer")
    same = c("o_custkey") == c("c_custkey")
    plans = {
        "filter": orders.filter("o_totalprice > 1000").select("o_orderkey"),
        "sum by key": orders.groupBy("o_custkey").agg(F.sum("o_totalprice")),
        "merge join": orders.hint("merge").join(customers, same),
        "broadcast join": orders.join(F.broadcast(customers), same),
        "blocks in Python": U.map_partitions(orders.select("o_orderkey"), dict, lambda _, frame: frame, "o_orderkey bigint"),
    }
    facts = [F.struct(F.lit(name).alias("plan"), *[F.lit(n).alias(k) for k, n in plan_facts(df).items()]) for name, df in plans.items()]
    return orders.agg(F.count(F.lit(1)).alias("n_orders")).select(F.inline(F.array(*facts)), "n_orders")


def _labels(sizes: pd.Series) -> pd.Series:
    out = sizes.astype("string")
    out[sizes % 3 == 0] = "three"
    out[sizes % 5 == 0] = "five"
    out[sizes % 15 == 0] = "both"
    return out


@query(
    "udf_scalar",
    """SELECT p_partkey, CASE WHEN p_size % 15 = 0 THEN 'both' WHEN p_size % 5 = 0 THEN 'five' WHEN p_size % 3 = 0 THEN 'three'
              ELSE p_size::VARCHAR END AS label FROM part""",
)
def udf_scalar(spark, folder):
    label = U.column_function(_labels, "string")
    return load(spark, folder, "part").select("p_partkey", label(c("p_size")).alias("label"))


def _composed(texts: pa.Array) -> pa.Array:
    """Only a hundred texts at a time are Python objects. Arrow's own utf8_normalize was tried: it took letters apart here."""
    parts = (texts.slice(i, 100).to_pylist() for i in range(0, len(texts), 100))
    found = [pa.array([t if t is None else unicodedata.normalize("NFC", t) for t in part], pa.string()) for part in parts]
    return pa.concat_arrays(found) if found else pa.array([], pa.string())


_ACUTE = "chr(769)"


@query(
    "udf_unicode",
    f"""SELECT doc_id, md5(nfc_normalize(t)) AS digest, length(t) - length(nfc_normalize(t)) AS n_composed
        FROM (SELECT doc_id, replace(text, 'e', 'e' || {_ACUTE}) AS t FROM documents)""",
)
def udf_unicode(spark, folder):
    """Unicode composition, for which Spark has no expression, as a function of a whole column of texts."""
    compose = U.arrow_function(_composed, "string")
    apart = F.replace("text", F.lit("e"), F.lit("e\u0301"))
    texts = load(spark, folder, "documents").select("doc_id", apart.alias("t")).withColumn("u", compose("t"))
    return texts.select("doc_id", F.md5("u").alias("digest"), (F.length("t") - F.length("u")).cast("bigint").alias("n_composed"))


# Discount per order priority; fixed values of the example.
DISCOUNTS = {"1-URGENT": 0.0, "2-HIGH": 0.05}


@query(
    "map_partitions",
    """SELECT o_orderkey, round(o_totalprice * (1 - CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 0.05::DOUBLE ELSE 0.1::DOUBLE END), 6)
              AS net FROM orders""",
)
def map_partitions(spark, folder):
    """A function of whole blocks of rows, with its lookup set up once per partition."""

    def discount(rates, frame):
        rate = frame["o_orderpriority"].map(rates).fillna(0.1)
        return pd.DataFrame({"o_orderkey": frame["o_orderkey"], "net": frame["o_totalprice"] * (1 - rate)})

    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    out = U.map_partitions(orders, lambda: dict(DISCOUNTS), discount, "o_orderkey bigint, net double")
    return out.withColumn("net", F.round("net", 6))


def _digit_sums(numbers: pd.Series) -> pd.Series:
    return numbers.map(lambda n: sum(map(int, str(n))))


@query(
    "delayed_sum",
    """SELECT count(*) AS n, sum(list_sum(list_transform(string_split(o_orderkey::VARCHAR, ''), lambda x: x::BIGINT)))::BIGINT AS total
       FROM orders""",
)
def delayed_sum(spark, folder):
    """A Python function over independent items in parallel, then one reduction."""
    digits = U.column_function(_digit_sums, "bigint")
    items = load(spark, folder, "orders").select(digits(c("o_orderkey")).alias("v"))
    return items.agg(F.count("v").alias("n"), F.sum("v").alias("total"))


def _jaro(a: str, b: str) -> float:
    """Share of matching letters and of those in the same order, 1 for equal texts."""
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, left = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                left.append(x)
                break
    if not left:
        return 0.0
    right = [y for y, t in zip(b, taken, strict=True) if t]
    m = len(left)
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def _similarities(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([_jaro(a, b) for a, b in zip(left, right, strict=True)])


@query(
    "parallel_items",
    "SELECT p_partkey, round(jaro_similarity(p_name, p_brand || ' ' || p_type), 6) AS similarity FROM part",
)
def parallel_items(spark, folder):
    """A Python loop over independent pairs of texts, run wherever their blocks are."""
    alike = U.column_function(_similarities, "double")
    names = load(spark, folder, "part")
    return names.select("p_partkey", F.round(alike("p_name", F.concat("p_brand", F.lit(" "), "p_type")), 6).alias("similarity"))


@query(
    "group_combine",
    """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) - min(o_totalprice) AS spread,
              sum((o_totalprice > 250000)::INT)::BIGINT AS n_large FROM orders GROUP BY 1""",
)
def group_combine(spark, folder):
    """A mergeable Python function per group: large groups come in blocks."""

    def measure(frame):
        price = frame["o_totalprice"]
        return pd.DataFrame(
            {
                "o_orderpriority": [frame["o_orderpriority"].iloc[0]],
                "n": [len(price)],
                "low": [price.min()],
                "high": [price.max()],
                "n_large": [int((price > 250000).sum())],
            }
        )

    return U.group_combine(
        load(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"),
        ["o_orderpriority"],
        ["o_orderkey"],
        measure,
        "o_orderpriority string, n bigint, low double, high double, n_large bigint",
        [F.sum("n").alias("n"), (F.max("high") - F.min("low")).alias("spread"), F.sum("n_large").alias("n_large")],
    )


def _rises(batches):
    """Rows and rises of one customer's orders in order of time; only the last price is kept from batch to batch."""
    key, n, rises, last = None, 0, 0, None
    for batch in batches:
        price = batch.column("o_totalprice").to_numpy(zero_copy_only=False)
        key, n = batch.column("o_custkey")[0].as_py(), n + len(price)
        rises += int(np.count_nonzero(price[1:] > price[:-1])) + (last is not None and bool(price[0] > last))
        last = price[-1]
    yield key, n, rises


def _middle(batches):
    """Median of prices that come in ascending order with their number; at most two values are kept."""
    key, seen, found = None, 0, []
    for batch in batches:
        n = batch.column("n")[0].as_py()
        key, price = batch.column("o_custkey")[0].as_py(), batch.column("o_totalprice")
        found += [price[k - seen].as_py() for k in ((n - 1) // 2, n // 2) if seen <= k < seen + len(price)]
        seen += len(price)
    yield key, sum(found) / 2


@query(
    "group_apply",
    """SELECT o_custkey, count(*) AS n, median(o_totalprice) AS middle,
              count(*) FILTER (o_totalprice > before) AS n_rises FROM (
         SELECT *, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders) GROUP BY 1""",
)
def group_apply(spark, folder):
    """Any Python function of a whole group, which comes as a stream: the rises in order of time, a median in order of price."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return rises_and_middle(orders)


def rises_and_middle(orders):
    counted = U.group_stream(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], _rises, "o_custkey bigint, n bigint, n_rises bigint")
    counted = stage(counted, "rises")
    prices = K.same_keys(orders, counted.select(c("o_custkey").alias("_k_o_custkey"), "n"), ["o_custkey"], "_k_", "inner")
    middle = U.group_stream(prices.select("o_custkey", "o_totalprice", "n"), ["o_custkey"], ["o_totalprice"], _middle, "o_custkey bigint, middle double")
    middle = middle.select(c("o_custkey").alias("_k_o_custkey"), "middle")
    return K.same_keys(counted, middle, ["o_custkey"], "_k_", "inner").select("o_custkey", "n", "middle", "n_rises")


@query(
    "udtf_tokens",
    r"""SELECT doc_id, count(w) AS n_words, count(DISTINCT w) AS n_distinct, max(pos)::INT AS last_pos FROM (
         SELECT doc_id, unnest(l) AS w, unnest(range(0, len(l))) AS pos FROM (
           SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{M}]+') AS l FROM documents)) GROUP BY 1""",
)
def udtf_tokens(spark, folder):
    """One text to many rows: its words, in any language.

    The texts are dealt by document before they become rows, so what moves is the texts and not a row per word.
    """
    texts = load(spark, folder, "documents").select("doc_id", "text").repartition("doc_id")
    rows = U.words(texts, "text").filter("word is not null")
    return rows.groupBy("doc_id").agg(
        F.count("word").alias("n_words"), F.count_distinct("word").alias("n_distinct"), F.max("pos").alias("last_pos")
    )


@query(
    "step_chain",
    """SELECT o_orderkey, round(o_totalprice * 1.2::DOUBLE, 4) AS with_tax, upper(o_orderstatus) || '!' AS status
       FROM orders WHERE o_totalprice >= 100000""",
)
def step_chain(spark, folder):
    """Small steps put together and run as one plan."""

    def at_least(low):
        return lambda df: df.filter(c("o_totalprice") >= low)

    def with_tax(rate):
        return lambda df: df.withColumn("with_tax", F.round(c("o_totalprice") * (1 + rate), 4))

    def shout(df):
        return df.withColumn("status", F.concat(F.upper("o_orderstatus"), F.lit("!")))

    out = U.run_steps(load(spark, folder, "orders"), at_least(100000), with_tax(0.2), shout)
    return out.select("o_orderkey", "with_tax", "status")


@query(
    "param_query",
    """SELECT 'plain' AS kind, c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000""",
)
def param_query(spark, folder):
    """Bound values; a hostile text is only a text that no segment equals."""
    sql = "SELECT :kind AS kind, c_custkey, c_name FROM {table} WHERE c_mktsegment = :segment AND c_acctbal > :low"
    customers = load(spark, folder, "customer")
    plain = T.bound_query(customers, sql, kind="plain", segment="BUILDING", low=5000)
    hostile = T.bound_query(customers, sql, kind="hostile", segment="x' OR '1'='1", low=0)
    return plain.unionByName(hostile)


@query(
    "dynamic_filter",
    """SELECT o_orderkey, 'cannot filter by [''1=1; DROP TABLE orders'']' AS refused FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'""",
)
def dynamic_filter(spark, folder):
    """Filters from a dictionary; only listed columns may be named."""
    orders, allowed = load(spark, folder, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]
    try:
        T.dynamic_filter(orders, {"1=1; DROP TABLE orders": 1}, allowed)
        refused = "nothing"
    except ValueError as error:
        refused = str(error)
    found = T.dynamic_filter(orders, {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}, allowed)
    return found.select("o_orderkey", F.lit(refused).alias("refused"))


@query("like_filter", "SELECT c_custkey, c_name FROM customer WHERE c_name LIKE 'Customer#%7' AND c_mktsegment LIKE '_U%'")
def like_filter(spark, folder):
    customers = load(spark, folder, "customer").filter(c("c_name").like("Customer#%7") & c("c_mktsegment").like("_U%"))
    return customers.select("c_custkey", "c_name").orderBy("c_name")


@query(
    "table_update_delete",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSING' ELSE c_mktsegment END AS c_mktsegment
       FROM customer WHERE NOT (c_custkey % 7 <> 0 AND c_acctbal < 0 AND c_mktsegment <> 'BUILDING')""",
)
def table_update_delete(spark, folder):
    """Update then delete by predicate, as a new version of the table."""
    customers = load(spark, folder, "customer").withColumn("nation", F.when(c("c_custkey") % 7 != 0, c("c_nationkey")))
    updated = T.update_where(
        customers,
        c("c_mktsegment") == "BUILDING",
        {"c_acctbal": c("c_acctbal") * 2, "c_mktsegment": F.lit("HOUSING")},
    )
    # an unknown nation leaves the condition unknown, and the row stays
    gone = (c("nation") >= 0) & (c("c_acctbal") < 0) & (c("c_mktsegment") != "HOUSING")
    kept = T.delete_where(updated, gone)
    return stage(kept.select("c_custkey", "c_acctbal", "c_mktsegment"), "customers")


@query(
    "shared_result",
    """WITH j AS (SELECT c_mktsegment AS segment, o_orderpriority AS priority, o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT 'segment' AS by, segment AS part, count(*) AS n, round(sum(price), 2) AS total FROM j GROUP BY 2
       UNION ALL SELECT 'priority', priority, count(*), round(sum(price), 2) FROM j GROUP BY 2""",
)
def shared_result(spark, folder):
    """A join that two totals need: made once, kept for both, then released."""
    joined = load(spark, folder, "orders").join(load(spark, folder, "customer"), c("o_custkey") == c("c_custkey"))
    needed = joined.select(c("c_mktsegment").alias("segment"), c("o_orderpriority").alias("priority"), c("o_totalprice").alias("price"))
    totals = [F.count(F.lit(1)).alias("n"), money_sum("price").alias("total")]
    with shared(needed) as once:
        parts = [stage(once.groupBy(c(by).alias("part")).agg(*totals), by).withColumn("by", F.lit(by)) for by in ("segment", "priority")]
    return parts[0].unionByName(parts[1])
