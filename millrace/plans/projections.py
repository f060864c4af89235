"""Filter, projection and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import select as S
from millrace.operators.aggregate import first_look, profile
from millrace.operators.joins import lookup, map_with_default
from millrace.operators.ordered import row_slice
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.tables import SCHEMAS, load


@query(
    "filter_bool",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE (o_orderstatus = 'F' AND o_totalprice > 200000 OR o_orderpriority = '1-URGENT')
         AND NOT o_orderstatus = 'P'""",
)
def filter_bool(spark, folder):
    c = F.col
    keep = (((c("o_orderstatus") == "F") & (c("o_totalprice") > 200000)) | (c("o_orderpriority") == "1-URGENT")) & ~(
        c("o_orderstatus") == "P"
    )
    return load(spark, folder, "orders").filter(keep).select("o_orderkey", "o_totalprice")


@query(
    "derive_columns",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
              l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
              l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 AS is_large FROM lineitem""",
)
def derive_columns(spark, folder):
    return (
        load(spark, folder, "lineitem")
        .withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("gross", F.col("net") * (1 + F.col("l_tax")))
        .withColumn("is_large", F.col("gross") > 50000)
        .select("l_orderkey", "l_linenumber", "net", "gross", "is_large")
    )


@query(
    "drop_cols_rows",
    """SELECT * EXCLUDE (o_orderpriority, o_orderdate) FROM orders WHERE o_orderkey NOT IN (0, 1, 5, 999999999)""",
)
def drop_cols_rows(spark, folder):
    return S.drop_labels(
        load(spark, folder, "orders"), "o_orderkey", [0, 1, 5, 999_999_999], ["o_orderpriority", "o_orderdate"]
    )


@query("label_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey >= 100 AND o_orderkey <= 900")
def label_range(spark, folder):
    return S.label_range(load(spark, folder, "orders"), "o_orderkey", 100, 900).select("o_orderkey", "o_totalprice")


@query(
    "row_slice",
    """SELECT idx, o_orderkey, o_totalprice FROM (
         SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS idx FROM orders)
       WHERE idx >= 10 AND idx < 1000 AND (idx - 10) % 3 = 0""",
)
def row_slice_query(spark, folder):
    """Rows [10, 1000) by position, every third."""
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return row_slice(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, 1000, 3)


@query(
    "flag_update",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'review' WHEN o_orderstatus = 'P' THEN 'pending'
              ELSE 'ok' END AS flag FROM orders""",
)
def flag_update(spark, folder):
    flag = F.when(F.col("o_totalprice") > 300000, "review").when(F.col("o_orderstatus") == "P", "pending")
    return load(spark, folder, "orders").select("o_orderkey", flag.otherwise("ok").alias("flag"))


@query(
    "map_with_default",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unknown' END AS label,
              coalesce(c_mktsegment, 'none') AS segment
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey""",
)
def map_with_default_query(spark, folder):
    """Codes to labels, from a literal map and from a table, with a default for unknown ones."""
    orders = map_with_default(
        load(spark, folder, "orders"), "o_orderstatus", {"F": "finished", "O": "open"}, "unknown", "label"
    )
    customers = D.customers_with_gaps(spark, folder)
    return lookup(orders, "o_custkey", customers, "c_custkey", "c_mktsegment", "none", "segment").select(
        "o_orderkey", "label", "segment"
    )


def _profile_sql(c):
    return f"""SELECT '{c}' AS "column", count({c}) AS n, (count(*) - count({c})) AS nulls,
        round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std, min({c})::DOUBLE AS min,
        quantile_cont({c}, 0.25)::DOUBLE AS q25, quantile_cont({c}, 0.5)::DOUBLE AS q50,
        quantile_cont({c}, 0.75)::DOUBLE AS q75, max({c})::DOUBLE AS max, NULL::BIGINT AS n_unique,
        NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM lineitem"""


def _profile_text_sql(c):
    return f"""SELECT '{c}', count({c}), count(*) - count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}),
        (SELECT {c}::VARCHAR FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
        (SELECT count(*) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1) FROM lineitem"""


_KINDS = {f.split()[0]: f.split()[1] for f in SCHEMAS["lineitem"].split(", ")}
_NUMBERS = [x for x, kind in _KINDS.items() if kind in ("int", "bigint", "double")]
_OTHERS = [x for x in _KINDS if x not in _NUMBERS]


@query("table_profile", " UNION ALL ".join([*map(_profile_sql, _NUMBERS), *map(_profile_text_sql, _OTHERS)]))
def table_profile(spark, folder):
    """Every column of a table: counts, nulls, mean, deviation, quartiles, extremes; for texts and times the most common value."""
    out = profile(load(spark, folder, "lineitem"), _NUMBERS, _OTHERS)
    return out.withColumns({c: F.round(c, 3) for c in ("mean", "std")})


_LOOK = {f.split()[0]: f.split()[1] for f in SCHEMAS["customer"].split(", ")}


@query(
    "first_look",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{x}' AS "column", '{kind}' AS type, count(*) AS n_rows, count({x}) AS n_known,
            (SELECT string_agg({x}::VARCHAR, ', ' ORDER BY c_custkey) FROM (FROM customer ORDER BY c_custkey LIMIT 3)) AS head,
            (SELECT string_agg({x}::VARCHAR, ', ' ORDER BY c_custkey) FROM (FROM customer ORDER BY c_custkey DESC LIMIT 3)) AS tail
            FROM customer"""
        for i, (x, kind) in enumerate(_LOOK.items())
    ),
    ints="position",
)
def first_look_query(spark, folder):
    """Shape, types, and the first and last rows of a table, all its columns."""
    found = first_look(load(spark, folder, "customer"), ["c_custkey"])
    return found.withColumns({x: F.array_join(x, ", ") for x in ("head", "tail")})


@query(
    "records_columnar",
    """SELECT s_suppkey // 1000 AS batch, row_number() OVER (PARTITION BY s_suppkey // 1000 ORDER BY s_suppkey) - 1 AS pos,
              s_suppkey, s_name, s_nationkey, first_value(s_name) OVER (PARTITION BY s_suppkey // 1000 ORDER BY s_suppkey) AS head
       FROM supplier""",
    ints="pos",
)
def records_columnar(spark, folder):
    """Records to arrays of columns, a record picked by position, and back to records."""
    fields = ["s_suppkey", "s_name", "s_nationkey"]
    suppliers = load(spark, folder, "supplier").select(*fields)
    columnar = S.to_columnar(suppliers, ["s_suppkey"], F.floor(F.col("s_suppkey") / 1000))
    head = S.record_at(columnar, ["s_name"], 0).withColumnRenamed("s_name", "head")
    return S.to_records(columnar, fields).join(head, "batch")


_MAYBE = """CASE WHEN event_id % 5 = 0 THEN 0 WHEN event_id % 5 = 1 THEN NULL ELSE value END"""
_TEXT = """CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN NULL ELSE event_type END"""


@query(
    "drop_falsy",
    f"""SELECT event_id, {_MAYBE} AS amount, {_TEXT} AS label FROM events
        WHERE coalesce({_MAYBE}, 0) <> 0 AND coalesce({_TEXT}, '') <> ''""",
)
def drop_falsy(spark, folder):
    k = F.col("event_id")
    events = load(spark, folder, "events").select(
        "event_id",
        F.when(k % 5 == 0, 0.0).when(k % 5 == 1, None).otherwise(F.col("value")).alias("amount"),
        F.when(k % 7 == 0, "").when(k % 7 == 1, None).otherwise(F.col("event_type")).alias("label"),
    )
    return S.drop_falsy(S.drop_falsy(events, "amount"), "label")


@query(
    "config_range_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02 AND 0.05""",
)
def config_range_filter(spark, folder):
    steps = [{"column": "l_quantity", "min": 10, "max": 20}, {"column": "l_discount", "min": 0.02, "max": 0.05}]
    df = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    for config in steps:
        df = df.transform(S.RangeStep.from_config(config))
    return df


@query(
    "unpack_struct",
    """SELECT vec_id, label, embedding[1]::DOUBLE AS first_value, embedding[-1]::DOUBLE AS last_value,
              len(embedding[2:-2]) AS n_middle, embedding[2:-2][1]::DOUBLE AS middle_first FROM embeddings""",
    ints="n_middle",
)
def unpack_struct(spark, folder):
    """First, middle and last of a sequence, and the fields of a struct, as columns."""
    e = F.col("embedding")
    parts = F.struct(
        F.element_at(e, 1).cast("double").alias("first_value"),
        F.slice(e, 2, F.size(e) - 2).alias("middle"),
        F.element_at(e, -1).cast("double").alias("last_value"),
    )
    return (
        load(spark, folder, "embeddings")
        .select("vec_id", "label", parts.alias("p"))
        .select("vec_id", "label", "p.*")
        .select(
            "vec_id",
            "label",
            "first_value",
            "last_value",
            F.size("middle").alias("n_middle"),
            F.element_at("middle", 1).cast("double").alias("middle_first"),
        )
    )
