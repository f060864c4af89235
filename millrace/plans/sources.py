"""Source and sink queries: each writes files to the shared folder and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregate import money_sum
from millrace.operators.ordered import global_index
from millrace.operators.quality import misfits
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.session import fresh_path, stage
from millrace.sources import files, footers, html, incremental, paged
from millrace.tables import SCHEMAS, load

c = F.col
_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
                 o_orderpriority FROM orders"""


def _columns(table):
    return [f.split()[0] for f in SCHEMAS[table].split(", ")]


def _day(df, column="o_orderdate"):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


def _round_trip(spark, folder, kind, **options):
    path = files.write(load(spark, folder, "orders"), kind, fresh_path(spark, kind), **options)
    return _day(files.read(spark, kind, path, SCHEMAS["orders"], **options))


@query("csv_roundtrip", _ORDERS_SQL)
def csv_roundtrip(spark, folder):
    return _round_trip(spark, folder, "csv")


@query("orc_roundtrip", _ORDERS_SQL)
def orc_roundtrip(spark, folder):
    return _round_trip(spark, folder, "orc")


@query(
    "csv_dialects",
    """SELECT dialect, c_custkey, c_name, c_acctbal FROM customer, (SELECT unnest(['tab', 'semicolon']) AS dialect)""",
)
def csv_dialects(spark, folder):
    customers = load(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    out = None
    for name, separator in (("tab", "\t"), ("semicolon", ";")):
        path = files.write(customers, "csv", fresh_path(spark, name), sep=separator)
        part = files.read(spark, "csv", path, customers.schema, sep=separator).withColumn("dialect", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "csv_quoting",
    """SELECT doc_id, md5('"a",' || chr(10) || ' ' || text) AS text_md5 FROM documents""",
)
def csv_quoting(spark, folder):
    """Texts with delimiters, quotes and line breaks survive the trip."""
    text = F.concat(F.lit('"a",\n '), c("text"))
    documents = load(spark, folder, "documents").select("doc_id", text.alias("text"))
    path = files.write(documents, "csv", fresh_path(spark, "quoted"), **files.QUOTED)
    back = files.read(spark, "csv", path, documents.schema, **files.QUOTED, lineSep="\n")
    return back.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "csv_ragged",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 1 THEN o_orderstatus END AS status,
              CASE WHEN o_orderkey % 9 = 2 THEN 'extra,more' ELSE '' END AS surplus, o_orderkey % 9 IN (1, 2) AS is_ragged FROM orders""",
)
def csv_ragged(spark, folder):
    """Short rows get nulls, fields of long rows are kept."""
    key, status = c("o_orderkey").cast("string"), c("o_orderstatus")
    line = (
        F.when(c("o_orderkey") % 9 == 1, key)
        .when(c("o_orderkey") % 9 == 2, F.concat_ws(",", key, status, F.lit("extra"), F.lit("more")))
        .otherwise(F.concat_ws(",", key, status))
    )
    path = fresh_path(spark, "ragged")
    load(spark, folder, "orders").select(line.alias("value")).write.text(path)
    rows = files.read_ragged_csv(spark, path, "o_orderkey bigint, status string", header="false")
    raw = c(files.CORRUPT)
    surplus = F.when(raw.isNull(), "").otherwise(F.array_join(files.surplus_fields(raw, 2), ","))
    return rows.select("o_orderkey", "status", surplus.alias("surplus"), raw.isNotNull().alias("is_ragged"))


_MARKED = """CASE o_orderkey % 10 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE o_totalprice END"""


@query(
    "csv_null_markers",
    f"""SELECT o_orderkey, {_MARKED} AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def csv_null_markers(spark, folder):
    """Only some columns, dates parsed while reading, several texts that mean missing."""
    k = c("o_orderkey")
    price = F.when(k % 10 == 1, "NA").when(k % 10 == 2, "n/a").when(k % 10 == 3, "").otherwise(
        c("o_totalprice").cast("string")
    )
    export = load(spark, folder, "orders").select(
        "o_orderkey", price.alias("price"), F.date_format("o_orderdate", "dd.MM.yyyy").alias("day"), "o_orderpriority"
    )
    path = files.write(export, "csv", fresh_path(spark, "markers"))
    raw = files.read(spark, "csv", path, "o_orderkey bigint, price string, day date, o_orderpriority string", dateFormat="dd.MM.yyyy")
    wanted = files.null_markers(raw.select("o_orderkey", "price", "day"), {"price": ["NA", "n/a", ""]})
    return wanted.select("o_orderkey", c("price").cast("double").alias("price"), F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(
    "csv_drop_malformed",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 8 NOT IN (1, 2)""",
)
def csv_drop_malformed(spark, folder):
    """Lines that do not fit the schema are skipped."""
    key, price = c("o_orderkey").cast("string"), c("o_totalprice").cast("string")
    line = (
        F.when(c("o_orderkey") % 8 == 1, F.concat_ws(",", key, F.lit("price?")))
        .when(c("o_orderkey") % 8 == 2, F.concat_ws(",", key, price, F.lit("x"), F.lit("y")))
        .otherwise(F.concat_ws(",", key, price))
    )
    path = fresh_path(spark, "malformed")
    load(spark, folder, "orders").select(line.alias("value")).write.text(path)
    rows = files.read_ragged_csv(spark, path, "o_orderkey bigint, o_totalprice double", header="false")
    return rows.filter(c(files.CORRUPT).isNull()).drop(files.CORRUPT)


@query("json_roundtrip", _ORDERS_SQL)
def json_roundtrip(spark, folder):
    """Orders to JSON documents and back, times as ISO text."""
    orders = load(spark, folder, "orders")
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    texts = orders.select(F.to_json(F.struct(*orders.columns), options).alias("document"))
    back = texts.select(F.from_json("document", SCHEMAS["orders"], options).alias("r")).select("r.*")
    return _day(back)


@query(
    "jsonl_roundtrip",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events",
)
def jsonl_roundtrip(spark, folder):
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    path = files.write(load(spark, folder, "events"), "json", fresh_path(spark, "jsonl"), **options)
    back = files.read(spark, "json", path, SCHEMAS["events"], **options)
    return back.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    "jsonl_malformed",
    """SELECT 'good' AS kind, event_id, value FROM events WHERE event_id % 20 NOT IN (7, 8)
       UNION ALL SELECT 'bad', NULL, count(*) FROM events WHERE event_id % 20 = 7""",
)
def jsonl_malformed(spark, folder):
    """Good rows kept, bad lines counted, blank lines ignored."""
    document = F.to_json(F.struct("event_id", "value"))
    line = F.when(c("event_id") % 20 == 7, F.concat(F.lit("{oops "), document)).when(c("event_id") % 20 == 8, "  ")
    path = fresh_path(spark, "jsonl-bad")
    load(spark, folder, "events").select(line.otherwise(document).alias("value")).write.text(path)
    good, bad = files.read_jsonl(spark, path, "event_id bigint, value double")
    n_bad = bad.agg(F.count(F.lit(1)).cast("double").alias("value")).withColumn("kind", F.lit("bad"))
    return good.withColumn("kind", F.lit("good")).unionByName(n_bad, allowMissingColumns=True)


@query(
    "parquet_roundtrip",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
              l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem""",
)
def parquet_roundtrip(spark, folder):
    path = files.write(load(spark, folder, "lineitem"), "parquet", fresh_path(spark, "parquet"))
    return _day(files.read(spark, "parquet", path, SCHEMAS["lineitem"]), "l_shipdate")


@query(
    "parquet_codecs",
    """SELECT codec, (SELECT count(*) FROM lineitem) AS n_rows, codec <> 'none' AS smaller_than_plain
       FROM (SELECT unnest(['snappy', 'gzip', 'zstd', 'none']) AS codec)""",
)
def parquet_codecs(spark, folder):
    """The table under each codec, read back; whether it takes fewer bytes than without one."""
    lines, out = load(spark, folder, "lineitem"), None
    for codec in ("snappy", "gzip", "zstd", "none"):
        path = files.write(lines, "parquet", fresh_path(spark, codec), compression=codec)
        stored = files.read(spark, "parquet", path, SCHEMAS["lineitem"])
        per_file = stored.groupBy(c("_metadata.file_path").alias("f"), c("_metadata.file_size").alias("s"))
        sizes = per_file.agg(F.count(F.lit(1)).alias("n")).agg(F.sum("s").alias("n_bytes"), F.sum("n").alias("n_rows"))
        part = sizes.withColumn("codec", F.lit(codec))
        out = part if out is None else out.unionByName(part)
    sizes = stage(out, "codecs")  # one row per codec
    plain = sizes.filter("codec = 'none'").select("n_bytes").scalar()
    return sizes.select("codec", "n_rows", (c("n_bytes") < plain).alias("smaller_than_plain"))


@query(
    "parquet_footer_stats",
    'SELECT "column", (SELECT count(*) FROM lineitem) AS n_rows, low, high FROM ('
    + " UNION ALL ".join(f"""SELECT '{x}' AS "column", min({x})::VARCHAR AS low, max({x})::VARCHAR AS high FROM lineitem""" for x in _columns("lineitem"))
    + ")",
)
def parquet_footer_stats(spark, folder):
    """What the footers alone tell of each column: rows and extremes."""
    return footers.footer_profile(load(spark, folder, "lineitem")).select("column", "n_rows", "low", "high")


_EVEN = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


@query(
    "parquet_footer_bytes",
    " UNION ALL ".join(
        f"""SELECT '{x}' AS "column", count(*) AS n_rows, 8 AS bytes_a_row, 'BIT_PACKED,PLAIN,RLE' AS encodings, 0.25::DOUBLE AS share,
            0.5::DOUBLE AS keys_share FROM lineitem"""
        for x in _EVEN
    ),
    ints="bytes_a_row",
)
def parquet_footer_bytes(spark, folder):
    """Bytes, encodings and the share of a read of two columns, of files whose layout is known: four columns of plain 8-byte values."""
    path = fresh_path(spark, "plain")
    options = {"compression": "none", "parquet.enable.dictionary": "false"}
    load(spark, folder, "lineitem").select(*_EVEN).write.options(**options).parquet(path)
    profile = footers.footer_profile(spark.read.schema(f"{_EVEN[0]} bigint, {_EVEN[1]} bigint, {_EVEN[2]} double, {_EVEN[3]} double").parquet(path))
    keys = footers.subset_share(profile, _EVEN[:2]).select(F.round("share", 2)).scalar()
    bytes_a_row = F.floor(c("uncompressed") / c("n_rows")).cast("int").alias("bytes_a_row")
    return profile.select("column", "n_rows", bytes_a_row, "encodings", F.round("share", 2).alias("share"), keys.alias("keys_share"))


_MONTHS = {"o_orderdate": ("1995-03-10 00:00:00", "1995-06-02 00:00:00")}


@query(
    "zone_map_read",
    """WITH f AS (SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders GROUP BY date_trunc('month', o_orderdate))
       SELECT (SELECT count(*) FROM f) AS n_files, (SELECT count(*) FROM f WHERE high >= '1995-03-10' AND low <= '1995-06-02') AS n_opened,
              count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate BETWEEN '1995-03-10' AND '1995-06-02'""",
)
def zone_map_read(spark, folder):
    """A table of bounds per file, stored once, tells which files a read of some weeks has to open."""
    path, stored = fresh_path(spark, "months"), fresh_path(spark, "zones")
    month = F.date_format("o_orderdate", "yyyy-MM")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", month.alias("month"))
    orders.repartition("month").write.partitionBy("month").parquet(path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    footers.zone_map(spark.read.schema(schema).parquet(path), ["o_orderdate"]).write.parquet(stored)
    zones = spark.read.schema("file_path string, n_rows bigint, bytes bigint, low_o_orderdate timestamp_ntz, high_o_orderdate timestamp_ntz").parquet(stored)
    ranges = {k: tuple(F.lit(x).cast("timestamp_ntz") for x in v) for k, v in _MONTHS.items()}
    found = footers.read_within(spark, schema, zones, ranges)
    files = zones.agg(F.count(F.lit(1))).scalar()
    opened = F.lit(len(found.inputFiles())).cast("bigint").alias("n_opened")
    return found.agg(F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total")).select(files.alias("n_files"), opened, "n", "total")


@query(
    "hour_prefix_read",
    "SELECT event_id, value FROM events WHERE date_trunc('hour', ts) = TIMESTAMP '2024-01-05 13:00:00'",
)
def hour_prefix_read(spark, folder):
    """One hour of an extract that lies by day and hour."""
    path = fresh_path(spark, "hours")
    incremental.write_hours(load(spark, folder, "events").select("event_id", "value", "ts"), path, "ts")
    return incremental.read_hour(spark, path, "event_id bigint, value double", "2024-01-05", 13)


@query(
    "strict_schema_check",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt, 'price_text' AS misfits, 'refused' AS batch FROM dirty
        WHERE try_cast(price_text AS DOUBLE) IS NULL""",
)
def strict_schema_check(spark, folder):
    """Values that do not fit the declared type; a batch with any is refused."""
    orders = D.dirty_orders(spark, folder)
    types = {"price_text": "double", "customer_id": "bigint", "order_date": "date"}
    bad = orders.withColumn("m", misfits(orders, types)).filter(F.size("m") > 0)
    outcome = "accepted" if bad.isEmpty() else "refused"
    return bad.select("order_id", "attempt", F.array_join("m", ",").alias("misfits"), F.lit(outcome).alias("batch"))


@query("partitioned_read", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def partitioned_read(spark, folder):
    """One partition of a partitioned table; the others are not opened."""
    path = fresh_path(spark, "by-status")
    load(spark, folder, "orders").write.partitionBy("o_orderstatus").parquet(path)
    stored = spark.read.schema(SCHEMAS["orders"]).parquet(path)
    return stored.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")


@query(
    "glob_read",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE isodow(o_orderdate) BETWEEN 1 AND 5",
)
def glob_read(spark, folder):
    """Files of several days as one table, by a pattern."""
    path = fresh_path(spark, "days")
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", (F.weekday("o_orderdate") + 1).alias("orders_day")
    )
    orders.write.partitionBy("orders_day").csv(path, header=True)
    return files.read(spark, "csv", f"{path}/orders_day=[1-5]", "o_orderkey bigint, o_totalprice double")


def _tree(spark, folder):
    """Orders below dated folders, next to files that are no data."""
    root = fresh_path(spark, "lake")
    dated = load(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("year"), F.month("o_orderdate").alias("month")
    )
    dated.write.partitionBy("year", "month").csv(f"{root}/raw/orders", header=True)
    notes = dated.groupBy("year").agg(F.count(F.lit(1)).cast("string").alias("value"))
    notes.write.partitionBy("year").text(f"{root}/raw/notes")
    notes.write.json(f"{root}/raw/orders_json")
    return root


_KEYED = "o_orderkey bigint, o_totalprice double"


@query(
    "recursive_discovery",
    """SELECT strftime(o_orderdate, '%Y') || '/' || month(o_orderdate) AS folder, count(*) AS n FROM orders GROUP BY 1""",
)
def recursive_discovery(spark, folder):
    """Data files at any depth; markers, notes and other formats are passed over."""
    found = files.discover(spark, _tree(spark, folder), "*.csv", _KEYED)
    year, month = (F.regexp_extract("file_path", rf"{x}=(\d+)", 1) for x in ("year", "month"))
    return found.groupBy(F.concat_ws("/", year, month).alias("folder")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "prefix_partition_read",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3",
)
def prefix_partition_read(spark, folder):
    """Objects by key prefix."""
    root = _tree(spark, folder)
    found = files.discover(spark, root, "*.csv", _KEYED)
    return files.under_prefix(found, root, "raw/orders/year=1998/month=3/").select("o_orderkey", "o_totalprice")


@query(
    "log_keyword_count",
    f"""WITH {D.LOG_LINES} SELECT count(*) FILTER (contains(line, 'ERROR')) AS n_errors, count(*) AS n_lines FROM lines""",
)
def log_keyword_count(spark, folder):
    path = fresh_path(spark, "logs")
    D.log_lines(spark, folder).select(c("line").alias("value")).write.text(path)
    return spark.read.text(path).agg(
        F.count_if(c("value").contains("ERROR")).alias("n_errors"), F.count(F.lit(1)).alias("n_lines")
    )


@query(
    "file_line_profile",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_lines,
              sum(length(event_id::VARCHAR) + length(event_type) + 2)::BIGINT AS n_bytes FROM events GROUP BY 1""",
)
def file_line_profile(spark, folder):
    """Lines and bytes per file, added up per day."""
    path = fresh_path(spark, "profiled")
    line = F.concat_ws(" ", c("event_id").cast("string"), "event_type")
    load(spark, folder, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), line.alias("value")).write.partitionBy(
        "day"
    ).text(path)
    per_file = files.file_profile(spark, path)
    day = F.regexp_extract("file_path", r"day=([0-9-]+)", 1).alias("day")
    return per_file.groupBy(day).agg(F.sum("n_lines").alias("n_lines"), F.sum("n_bytes").alias("n_bytes"))


@query(
    "shard_union_totals",
    """SELECT 'shard' || (o_orderkey % 4) AS shard, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
)
def shard_union_totals(spark, folder):
    """Several sources read side by side, then totals per source."""
    path = fresh_path(spark, "shards")
    load(spark, folder, "orders").withColumn("part", c("o_orderkey") % 4).write.partitionBy("part").parquet(path)
    shards = {f"shard{i}": files.read(spark, "parquet", f"{path}/part={i}", SCHEMAS["orders"]) for i in range(4)}
    return files.with_shard(shards).groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("total")
    )


PAGE_ROWS = 1000


def write_pages(spark, folder):
    """Orders as numbered JSON pages; every seventh page holds the server's error instead.

    A page is a small file, so the tasks that write them are counted by cores and not by bytes.
    """
    path = fresh_path(spark, "pages")
    orders = load(spark, folder, "orders").withColumn("page", F.floor(c("o_orderkey") / PAGE_ROWS).cast("int"))
    items = F.to_json(F.struct(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("items")))
    body = F.when(c("page") % 7 == 3, '{"error": "503 from the server"}').otherwise(c("items"))
    dealt = orders.repartition(paged.TASKS_A_CORE * spark.sparkContext.defaultParallelism, "page")
    pages = dealt.groupBy("page").agg(items.alias("items"))
    pages.select("page", body.alias("value")).write.partitionBy("page").text(path)
    return path


@query(
    "paged_source",
    """SELECT (o_orderkey // 1000)::INT AS page, 'ok' AS status, NULL AS error, o_orderkey, o_totalprice FROM orders
         WHERE o_orderkey // 1000 % 7 <> 3
       UNION ALL SELECT DISTINCT (o_orderkey // 1000)::INT, 'failed', '503 from the server', NULL::BIGINT, NULL::DOUBLE FROM orders
         WHERE o_orderkey // 1000 % 7 = 3""",
)
def paged_source(spark, folder):
    """Pages fetched by the tasks up to the first that is empty; a page that keeps failing is reported, not lost."""
    return paged.read_pages(spark, write_pages(spark, folder), None, _KEYED, wait=0.01)


@query(
    "cursor_stream",
    """SELECT CASE WHEN dense_rank() OVER (ORDER BY o_orderkey // 1000) <= 3 THEN 1 ELSE 2 END AS run, o_orderkey, o_totalprice
       FROM orders""",
    ints="run",
)
def cursor_stream(spark, folder):
    """Pages that name their successor, as a stream: the second run goes on from the cursor in the checkpoint of the first."""
    path, out, checkpoint = (fresh_path(spark, x) for x in ("chain", "extract", "checkpoint"))
    numbered = load(spark, folder, "orders").withColumn("number", F.floor(c("o_orderkey") / PAGE_ROWS))
    dealt = numbered.repartition(paged.TASKS_A_CORE * spark.sparkContext.defaultParallelism, "number")
    pages = dealt.groupBy("number").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("items"))
    name = F.concat(F.lit("c"), c("number").cast("string"))
    places = global_index(numbered.select("number").distinct(), ["number"], "place")
    later = places.select((c("place") - 1).alias("place"), c("number").alias("later"))
    linked = places.join(later, "place", "left").select("number", F.concat(F.lit("c"), c("later").cast("string")).alias("next"))
    chain = pages.join(linked, "number")
    chain.select(name.alias("page"), F.to_json(F.struct("items", "next")).alias("value")).write.partitionBy("page").text(path)
    start = places.agg(F.min("number")).first()[0]
    for run, most in ((1, 3), (2, 1_000_000)):
        records = paged.stream_cursor(spark, path, f"c{start}", _KEYED, most).filter("status = 'ok'")
        rows = records.select(F.lit(run).alias("run"), "o_orderkey", "o_totalprice")
        writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(f"run int, {_KEYED}").parquet(out)


@query(
    "page_titles",
    r"""SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title[^>]*>(.*?)</title>')
           THEN trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) END AS title FROM pages""",
)
def page_titles(spark, folder):
    return load(spark, folder, "pages").select("page_id", html.title(c("html")).alias("title"))


@query(
    "page_links",
    r"""SELECT page_id, (unnest(range(0, len(l))))::INT AS pos, unnest(l) AS href FROM (
         SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1) AS l FROM pages)""",
)
def page_links(spark, folder):
    return html.links(load(spark, folder, "pages"), "page_id", "html")


@query(
    "page_cards",
    """SELECT p_partkey // 20 AS page, 'no-' || p_partkey AS sku, p_name AS name, p_retailprice AS price,
              CASE WHEN p_partkey % 4 <> 1 THEN p_size / 10 END AS rating, CASE WHEN p_partkey % 3 <> 2 THEN 'item?' || p_partkey END AS url
       FROM part WHERE p_partkey // 20 % 10 <> 9""",
)
def page_cards(spark, folder):
    """Offers out of shop pages built from the parts, twenty to a page.

    Every tenth page uses another class name and so yields nothing.
    """
    k = c("p_partkey")
    page = F.floor(k / 20)
    text = k.cast("string")
    stars = F.when(k % 4 == 1, "").otherwise(
        F.concat(F.lit('<td class="stars">'), (c("p_size") / 10).cast("string"), F.lit("</td>"))
    )
    link = F.when(k % 3 == 2, "").otherwise(F.concat(F.lit('<td><a href="item?'), text, F.lit('">see</a></td>')))
    card = F.concat(
        F.lit('<tr class="'),
        F.when(page % 10 == 9, "line").otherwise("offer"),
        F.lit('" data-code="no-'),
        text,
        F.lit('"><td><b class="label">'),
        c("p_name"),
        F.lit('</b></td><td>EUR <i class="cost">'),
        c("p_retailprice").cast("string"),
        F.lit("</i></td>"),
        stars,
        link,
        F.lit("</tr>"),
    )
    cards = load(spark, folder, "part").select(page.alias("page"), card.alias("card"))
    body = F.concat(F.lit("<table>"), F.array_join(F.collect_list("card"), ""), F.lit("</table>"))
    classes = {"name": "label", "price": "cost", "rating": "stars"}
    return html.product_cards(cards.groupBy("page").agg(body.alias("html")), "page", "html", "offer", classes, "data-code")


@query(
    "multi_format_export",
    """SELECT format, count(*) AS n, round(sum(s_acctbal), 2) AS total FROM supplier,
         (SELECT unnest(['csv', 'json', 'parquet', 'orc']) AS format) GROUP BY 1""",
)
def multi_format_export(spark, folder):
    """One frame to several formats, each read back."""
    suppliers, root = load(spark, folder, "supplier"), fresh_path(spark, "export")
    out = None
    for kind, path in files.multi_sink(suppliers, ["csv", "json", "parquet", "orc"], root).items():
        back = files.read(spark, kind, path, SCHEMAS["supplier"])
        part = back.agg(F.count(F.lit(1)).alias("n"), money_sum("s_acctbal").alias("total")).withColumn("format", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "incremental_since",
    """SELECT event_id, value FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-21')
       UNION ALL SELECT event_id + 1000000000, value FROM events WHERE ts = (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-21')""",
)
def incremental_since(spark, folder):
    """Events newer than the mark the last run stored, and one that came late with the mark's own time."""
    events, marks = load(spark, folder, "events"), fresh_path(spark, "marks")
    first_run = events.filter("ts < timestamp_ntz'2024-01-21 00:00:00'")
    incremental.save_mark(first_run, marks, "events", "ts", "event_id")
    mark = incremental.last_mark(spark, marks, "events")
    late = events.filter(c("ts") == F.lit(mark[0]).cast("timestamp_ntz")).withColumn("event_id", c("event_id") + 1_000_000_000)
    return incremental.since(events.unionByName(late), "ts", "event_id", mark).select("event_id", "value")
