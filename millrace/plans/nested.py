"""Array, map and nested document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays, jsons, maps, slicing
from millrace.operators.aggregate import money_sum
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.tables import load

c = F.col
_E = "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"


def _vectors(spark, folder):
    return load(spark, folder, "embeddings").select("vec_id", "label", c("embedding").cast("array<double>").alias("v"))


@query(
    "array_slice",
    _E
    + """ SELECT vec_id, v[6] AS sixth, v[-1] AS last, list_sum(v[3:10]) AS slice_sum, len(v[61:200]) AS n_tail,
            list_sum(v[1:64:8]) AS step_sum, list_reverse(v)[1] AS reversed_first, len(v[100:]) AS n_beyond,
            len(v[1:5]) + 2 + len(v[11:]) AS n_replaced FROM e""",
    ints="n_tail n_beyond n_replaced",
)
def array_slice(spark, folder):
    """Index, slice, step, reverse; out of range is empty; replace a slice by two values."""
    v = c("v")
    patched = F.concat(slicing.array_slice(v, 0, 5), F.array(F.lit(0.0), F.lit(1.0)), slicing.array_slice(v, 10))
    return _vectors(spark, folder).select(
        "vec_id",
        F.get(v, F.lit(5)).alias("sixth"),
        F.element_at(v, -1).alias("last"),
        arrays.total(slicing.array_slice(v, 2, 10)).alias("slice_sum"),
        F.size(slicing.array_slice(v, -4, 200)).alias("n_tail"),
        arrays.total(slicing.array_slice(v, 0, 64, 8)).alias("step_sum"),
        F.get(slicing.array_slice(v, step=-1), F.lit(0)).alias("reversed_first"),
        F.size(slicing.array_slice(v, 99)).alias("n_beyond"),
        F.size(patched).alias("n_replaced"),
    )


_LISTS = """WITH d AS (SELECT DISTINCT o_custkey, month(o_orderdate) AS m FROM orders),
            t AS (SELECT o_custkey, list(m ORDER BY m) AS a FROM d GROUP BY 1)"""


def _month_lists(spark, folder):
    """Distinct order months per customer: at most twelve, however many orders there are."""
    months = load(spark, folder, "orders").select("o_custkey", F.month("o_orderdate").alias("m")).distinct()
    return months.groupBy("o_custkey").agg(F.array_sort(F.collect_list("m")).alias("a"))


@query(
    "array_ops",
    _LISTS
    + """ SELECT o_custkey, array_to_string(list_append(a, 13), ',') AS appended,
            array_to_string(list_concat(a, [7, 7]), ',') AS extended,
            array_to_string(list_concat([0], a), ',') AS inserted,
            array_to_string(list_filter(a, lambda x: x <> 6), ',') AS removed, list_contains(a, 6) AS has_june,
            coalesce(list_position(a, 6), 0)::BIGINT - 1 AS place, len(list_filter(list_concat(a, [7, 7]), lambda x: x = 7)) AS n_seven,
            array_to_string(list_reverse_sort(a), ',') AS descending,
            len(list_distinct(list_concat(a, [7, 7]))) AS n_distinct, len(a) * 2 AS n_repeated FROM t""",
    ints="n_seven n_distinct n_repeated",
)
def array_ops(spark, folder):
    a = c("a")
    sevens = F.concat(a, F.array(F.lit(7), F.lit(7)))
    join = lambda x: F.array_join(x.cast("array<string>"), ",")
    return _month_lists(spark, folder).select(
        "o_custkey",
        join(F.array_append(a, F.lit(13))).alias("appended"),
        join(sevens).alias("extended"),
        join(F.array_insert(a, 1, F.lit(0))).alias("inserted"),
        join(F.array_remove(a, 6)).alias("removed"),
        F.array_contains(a, 6).alias("has_june"),
        (F.array_position(a, 6) - 1).alias("place"),
        F.size(F.filter(sevens, lambda x: x == 7)).alias("n_seven"),
        join(F.sort_array(a, asc=False)).alias("descending"),
        F.size(F.array_distinct(sevens)).alias("n_distinct"),
        F.size(F.flatten(F.array_repeat(a, 2))).alias("n_repeated"),
    )


@query(
    "array_hof",
    _E
    + """ SELECT vec_id, round(list_sum(list_transform(v, lambda x: x * x)), 6) AS squares,
            len(list_filter(v, lambda x: x > 0)) AS n_positive,
            round(coalesce(list_sum([x * 2 FOR x IN v IF x > 0]), 0), 6) AS doubled,
            round(list_sum([x[1] * x[2] FOR x IN list_zip(v, list_reverse(v))]), 6) AS products FROM e""",
    ints="n_positive",
)
def array_hof(spark, folder):
    v = c("v")
    positive = F.filter(v, lambda x: x > 0)
    products = F.zip_with(v, F.reverse(v), lambda x, y: x * y)
    return _vectors(spark, folder).select(
        "vec_id",
        F.round(arrays.total(F.transform(v, lambda x: x * x)), 6).alias("squares"),
        F.size(positive).alias("n_positive"),
        F.round(arrays.total(F.transform(positive, lambda x: x * 2)), 6).alias("doubled"),
        F.round(arrays.total(products), 6).alias("products"),
    )


@query(
    "array_flatten",
    _E
    + """ SELECT vec_id, len(flatten([v[1:8], v[9:16], v[17:]])) AS n_flat, round(v[1] + v[9] + v[17], 6) AS first_column,
            round(v[8] + v[16] + v[24], 6) AS last_column, 8 AS n_columns FROM e""",
    ints="n_flat",
)
def array_flatten(spark, folder):
    """Nest a vector into rows, flatten it again, transpose a matrix."""
    v = c("v")
    rows = F.array(F.slice(v, 1, 8), F.slice(v, 9, 8), F.slice(v, 17, 8))
    columns = arrays.transpose(c("rows"))
    with_rows = _vectors(spark, folder).withColumn("rows", rows)
    return with_rows.withColumn("columns", columns).select(
        "vec_id",
        F.size(F.flatten(F.concat("rows", F.array(F.slice(v, 25, 40))))).alias("n_flat"),
        F.round(arrays.total(F.get("columns", F.lit(0))), 6).alias("first_column"),
        F.round(arrays.total(F.get("columns", F.lit(7))), 6).alias("last_column"),
        F.size("columns").alias("n_columns"),
    )


@query(
    "vector_broadcast",
    _E
    + """ SELECT vec_id, round(list_sum([x * 2.5 + 1 FOR x IN v]), 6) AS scaled,
            round(list_sum(list_transform(v, lambda x, i: x + (i - 1))), 6) AS shifted FROM e""",
)
def vector_broadcast(spark, folder):
    """Scalar with vector, and vector with a row vector of the same length."""
    v = c("v")
    steps = F.transform(v, lambda _, i: i.cast("double"))
    return _vectors(spark, folder).select(
        "vec_id",
        F.round(arrays.total(F.transform(arrays.scale(v, 2.5), lambda x: x + 1)), 6).alias("scaled"),
        F.round(arrays.total(arrays.add(v, steps)), 6).alias("shifted"),
    )


@query(
    "vector_axis_agg",
    _E
    + """ SELECT 'row' AS axis, vec_id AS i, round(list_sum(v), 6) AS total, round(list_avg(v), 6) AS mean,
            round(list_stddev_pop(v), 6) AS std, list_min(v) AS low, list_max(v) AS high FROM e
          UNION ALL SELECT 'column', i, round(sum(x), 6), round(avg(x), 6), round(stddev_pop(x), 6), min(x), max(x)
          FROM (SELECT unnest(v) AS x, unnest(range(0, len(v))) AS i FROM e) GROUP BY i""",
)
def vector_axis_agg(spark, folder):
    """Aggregates of each vector, and of each position over all vectors."""
    v = c("v")
    vectors = _vectors(spark, folder)
    rows = vectors.select(
        F.lit("row").alias("axis"),
        c("vec_id").alias("i"),
        arrays.total(v).alias("total"),
        arrays.mean(v).alias("mean"),
        arrays.std(v).alias("std"),
        F.array_min(v).alias("low"),
        F.array_max(v).alias("high"),
    )
    columns = arrays.by_position(vectors, "v").withColumnRenamed("pos", "i").withColumn("axis", F.lit("column"))
    both = rows.unionByName(columns.withColumn("i", c("i").cast("bigint")))
    return both.withColumns({x: F.round(x, 6) for x in ("total", "mean", "std")})


@query(
    "vector_mask",
    _E
    + """ SELECT vec_id, len(list_filter(v, lambda x: x > list_avg(v))) AS n_above,
            round(v[1] + v[6] + v[64], 6) AS gathered, v[101] IS NULL AS beyond_is_null FROM e""",
    ints="n_above",
)
def vector_mask(spark, folder):
    v = c("v")
    picked = arrays.gather(v, F.array(F.lit(0), F.lit(5), F.lit(63)))
    with_mean = _vectors(spark, folder).withColumn("mean", arrays.mean(v))
    return with_mean.select(
        "vec_id",
        F.size(F.filter(v, lambda x: x > c("mean"))).alias("n_above"),
        F.round(arrays.total(picked), 6).alias("gathered"),
        F.get(arrays.gather(v, F.array(F.lit(100))), F.lit(0)).isNull().alias("beyond_is_null"),
    )


@query(
    "explode_items",
    """SELECT l_orderkey AS order_id, o_orderstatus AS status, l_partkey AS partkey, l_quantity AS qty,
              l_extendedprice AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def explode_items(spark, folder):
    """Child list of a document to rows that carry parent fields."""
    return D.nested_orders(spark, folder).select("order_id", "status", F.explode("items").alias("i")).select(
        "order_id", "status", "i.*"
    )


@query(
    "map_ops",
    """WITH t AS (SELECT event_id, json_extract(props, '$.k')::INT AS k, value FROM events)
       SELECT event_id, k AS found, -1 AS missing, 'k' AS wanted_keys, CASE WHEN k > 50 THEN 'k' ELSE '' END AS big_keys,
              'id,k' AS keys, event_id + k AS value_sum, true AS has_k, false AS has_z, 'id' AS first_key FROM t""",
)
def map_ops(spark, folder):
    """Lookup with default, key subset, filter by value, first entries, keys, values, membership."""
    m = c("m")
    parsed = F.from_json("props", "map<string,bigint>")
    entries = maps.merge(F.create_map(F.lit("id"), c("event_id")), parsed)
    events = load(spark, folder, "events").select("event_id", entries.alias("m"))
    big = F.map_filter(maps.subset(m, ["k"]), lambda _, x: x > 50)
    return events.select(
        "event_id",
        maps.get(m, "k", -1).cast("int").alias("found"),
        maps.get(m, "z", -1).cast("int").alias("missing"),
        F.array_join(F.map_keys(maps.subset(m, ["k", "z"])), ",").alias("wanted_keys"),
        F.array_join(F.map_keys(big), ",").alias("big_keys"),
        F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys"),
        F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("value_sum"),
        F.map_contains_key(m, "k").alias("has_k"),
        F.map_contains_key(m, "z").alias("has_z"),
        F.get(F.map_keys(maps.first_n(m, 1)), F.lit(0)).alias("first_key"),
    )


@query(
    "map_merge_invert",
    """WITH n AS (SELECT o_custkey, o_orderstatus AS k, count(*) AS v FROM orders GROUP BY ALL),
            merged AS (SELECT * FROM n WHERE k <> 'P' UNION ALL SELECT DISTINCT o_custkey, 'P', 0 FROM n),
            inv AS (SELECT o_custkey, v, max(k) AS k FROM merged GROUP BY ALL)
       SELECT o_custkey, string_agg(v || '=' || k, ',' ORDER BY v) AS inverted FROM inv GROUP BY 1""",
)
def map_merge_invert(spark, folder):
    """Status counts per customer, one status overridden by a later map, then inverted."""
    counts = load(spark, folder, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    per_customer = counts.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("m")
    )
    override = F.create_map(F.lit("P"), F.lit(0).cast("bigint"))
    merged = per_customer.withColumn("m", maps.merge(c("m"), override))
    entries = F.array_sort(F.map_entries("inverted"))
    text = F.transform(entries, lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]))
    return maps.invert(merged, "o_custkey", "m").select("o_custkey", F.array_join(text, ",").alias("inverted"))


@query(
    "map_from_records",
    """SELECT s_nationkey, count(*) AS n, min(s_suppkey) AS first_key,
              (SELECT s_name FROM supplier i WHERE i.s_suppkey = min(o.s_suppkey)) AS first_name FROM supplier o GROUP BY 1""",
)
def map_from_records(spark, folder):
    """A lookup of suppliers per nation (1,000 keys to a map); duplicate keys are refused."""
    suppliers = load(spark, folder, "supplier").withColumn("block", F.floor(c("s_suppkey") / 1000))
    keyed = suppliers.withColumn("group", F.struct("s_nationkey", "block"))
    lookups = maps.from_records(keyed, "group", "s_suppkey", "s_name")
    firsts = lookups.withColumn("k", F.array_min(F.map_keys("lookup"))).select(
        "group.s_nationkey", F.size("lookup").alias("n"), "k", F.try_element_at("lookup", c("k")).alias("name")
    )
    return firsts.groupBy("s_nationkey").agg(
        F.sum("n").alias("n"), F.min("k").alias("first_key"), F.min_by("name", "k").alias("first_name")
    )


@query(
    "json_safe_get",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_extract_string(props, '$.a.b[0]'), 'none') AS deep,
              user_id::VARCHAR AS second_tag, 'none' AS third_tag FROM events""",
)
def json_safe_get(spark, folder):
    """Paths through objects and list positions; what is missing gives the default."""
    tags = F.to_json(F.struct(F.array(c("event_id"), c("user_id")).alias("tags")))
    return load(spark, folder, "events").select(
        "event_id",
        jsons.safe_get(c("props"), "k").alias("k"),
        jsons.safe_get(c("props"), "a.b[0]", "none").alias("deep"),
        jsons.safe_get(tags, "tags[1]").alias("second_tag"),
        jsons.safe_get(tags, "tags[2]", "none").alias("third_tag"),
    )


@query(
    "json_flatten",
    f"""WITH {D.NESTED_ORDERS} SELECT order_id, status, total, o_custkey AS "customer.id",
          o_orderpriority AS "customer.terms.priority", len(items) AS n_items FROM nested""",
    ints="n_items",
)
def json_flatten(spark, folder):
    """Dotted columns of each order, and its items on all pages."""
    flat = jsons.flatten(D.nested_orders(spark, folder)).withColumn("n", F.size("items")).drop("items", "page")
    return flat.groupBy(*[F.col(f"`{x}`") for x in flat.columns if x != "n"]).agg(F.sum("n").cast("int").alias("n_items"))


@query(
    "json_paths",
    """SELECT path, count(*) AS n, min(value) AS low FROM (
         SELECT 'order' AS path, o_orderkey::VARCHAR AS value FROM orders
         UNION ALL SELECT 'customer.id', o_custkey::VARCHAR FROM orders
         UNION ALL SELECT 'tags[0]', o_orderstatus FROM orders
         UNION ALL SELECT 'tags[1]', o_orderpriority FROM orders) GROUP BY path""",
)
def json_paths(spark, folder):
    """Flatten JSON texts whose shape is not known beforehand to (path, value) rows."""
    document = F.to_json(
        F.struct(
            c("o_orderkey").alias("order"),
            F.struct(c("o_custkey").alias("id")).alias("customer"),
            F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        )
    )
    texts = load(spark, folder, "orders").select("o_orderkey", document.alias("document"))
    paths = jsons.json_paths(texts, "o_orderkey", "document")
    return paths.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"))


@query(
    "json_normalize",
    """SELECT o_orderkey AS order_id, o_custkey AS "customer.id", l_partkey AS item_partkey, l_quantity AS item_qty,
              l_extendedprice AS item_price FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def json_normalize(spark, folder):
    return jsons.normalize(D.nested_orders(spark, folder), "items", ["order_id", "customer.id"], "item_")


@query(
    "nested_total",
    """SELECT o_orderkey AS order_id, coalesce(round(sum(l_quantity * l_extendedprice), 2), 0) AS items_total
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def nested_total(spark, folder):
    """Sum of quantity times price over the items of each document."""
    items = F.aggregate("items", F.lit(0.0), lambda acc, i: acc + i["qty"] * i["price"])
    totals = D.nested_orders(spark, folder).select("order_id", items.alias("t"))
    return totals.groupBy("order_id").agg(money_sum("t").alias("items_total"))
