"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates, logs, numbers, slicing, strings
from millrace.plans import derived as D
from millrace.plans.registry import query
from millrace.tables import load

c = F.col


@query(
    "str_case",
    """SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low,
         upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || '-' ||
         upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS title,
         upper(p_type[1]) || lower(p_type[2:]) AS capital FROM part""",
)
def str_case(spark, folder):
    hyphenated = F.replace("p_name", F.lit(" "), F.lit("-"))
    return load(spark, folder, "part").select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.lower("p_type").alias("low"),
        strings.title_case(hyphenated).alias("title"),
        strings.capitalize(c("p_type")).alias("capital"),
    )


@query(
    "str_trim",
    """WITH t AS (SELECT p_partkey, '  ' || p_name || '   ' AS padded, '**' || p_brand || '*' AS starred FROM part)
       SELECT p_partkey, trim(padded) AS both_ends, ltrim(padded) || '|' AS left_end, '|' || rtrim(padded) AS right_end,
              trim(starred, '*') AS bare FROM t""",
)
def str_trim(spark, folder):
    padded = F.concat(F.lit("  "), c("p_name"), F.lit("   "))
    starred = F.concat(F.lit("**"), c("p_brand"), F.lit("*"))
    return load(spark, folder, "part").select(
        "p_partkey",
        F.trim(padded).alias("both_ends"),
        F.concat(F.ltrim(padded), F.lit("|")).alias("left_end"),
        F.concat(F.lit("|"), F.rtrim(padded)).alias("right_end"),
        strings.strip_chars(starred, "*").alias("bare"),
    )


@query(
    "str_search",
    """SELECT p_partkey, replace(p_name, 'ring', 'RING') AS swapped, instr(p_name, 'ol') - 1 AS place,
         instr(p_brand, '#') - 1 AS hash_place, (length(p_name) - length(replace(p_name, 'l', '')))::INT AS n_l,
         starts_with(p_name, 'red') AS is_red, contains(p_name, 'bolt') AS is_bolt FROM part""",
    ints="place hash_place",
)
def str_search(spark, folder):
    name = c("p_name")
    return load(spark, folder, "part").select(
        "p_partkey",
        F.replace(name, F.lit("ring"), F.lit("RING")).alias("swapped"),
        strings.find(name, "ol").alias("place"),
        strings.index_of(c("p_brand"), "#").alias("hash_place"),
        strings.count_of(name, "l").alias("n_l"),
        name.startswith("red").alias("is_red"),
        name.contains("bolt").alias("is_bolt"),
    )


@query(
    "str_class",
    """SELECT p_partkey, regexp_matches(split_part(p_brand, '#', 2), '^[0-9]+$') AS tail_digits,
         regexp_matches(p_brand, '^[0-9]+$') AS brand_digits, regexp_matches(p_brand, '^[A-Za-z0-9]+$') AS brand_alnum,
         regexp_matches(p_type, '^[A-Za-z0-9]+$') AS type_alnum FROM part""",
)
def str_class(spark, folder):
    return load(spark, folder, "part").select(
        "p_partkey",
        strings.is_digits(F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("tail_digits"),
        strings.is_digits(c("p_brand")).alias("brand_digits"),
        strings.is_alnum(c("p_brand")).alias("brand_alnum"),
        strings.is_alnum(c("p_type")).alias("type_alnum"),
    )


@query(
    "str_split",
    r"""WITH t AS (SELECT doc_id, string_split(text, '. ') AS s, regexp_extract_all(text, '\S+') AS w,
            string_split_regex(text, '\r\n|\n|\r') AS l FROM documents)
        SELECT doc_id, len(s) AS n_sentences, len(w) AS n_words, len(l) AS n_lines, s[1] AS head,
               md5(array_to_string(s[2:], '. ')) AS rest_md5, array_to_string(w[1:3], '_') AS joined FROM t""",
    ints="n_sentences n_words n_lines",
)
def str_split(spark, folder):
    """Split on a separator, on white space, by lines, and at most once; join again."""
    text = c("text")
    once = strings.split_max(text, ". ", 1)
    return (
        load(spark, folder, "documents")
        .select("doc_id", F.split(text, r"\. ").alias("s"), strings.words(text).alias("w"), strings.lines(text).alias("l"), once.alias("o"))
        .select(
            "doc_id",
            F.size("s").alias("n_sentences"),
            F.size("w").alias("n_words"),
            F.size("l").alias("n_lines"),
            F.get("o", F.lit(0)).alias("head"),
            F.md5(F.coalesce(F.get("o", F.lit(1)), F.lit(""))).alias("rest_md5"),
            F.array_join(F.slice("w", 1, 3), "_").alias("joined"),
        )
    )


@query(
    "str_slice",
    """SELECT p_partkey, p_name[1:3] AS head, p_name[-3:] AS tail, p_name[3:-2] AS middle, reverse(p_name) AS backward,
         array_to_string([p_name[i] FOR i IN range(1, length(p_name) + 1, 2)], '') AS every_second,
         p_name[100:200] AS beyond FROM part""",
)
def str_slice(spark, folder):
    name = c("p_name")
    return load(spark, folder, "part").select(
        "p_partkey",
        slicing.char_slice(name, 0, 3).alias("head"),
        slicing.char_slice(name, -3).alias("tail"),
        slicing.char_slice(name, 2, -1).alias("middle"),
        slicing.char_slice(name, step=-1).alias("backward"),
        slicing.char_slice(name, step=2).alias("every_second"),
        slicing.char_slice(name, 99, 200).alias("beyond"),
    )


@query(
    "num_format",
    """SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice) AS two, format('{:,.2f}', l_extendedprice) AS thousands,
         lpad(l_orderkey::VARCHAR, 10, '0') AS padded, rpad(l_returnflag, 4, '.') || lpad(l_linestatus, 3, ' ') AS aligned,
         printf('%.1f%%', l_discount * 100) AS percent, printf('%X', l_partkey) AS hexed, bin(l_linenumber) AS binary,
         '$' || format('{:,.2f}', l_extendedprice) AS money FROM lineitem""",
)
def num_format(spark, folder):
    price = c("l_extendedprice")
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.format_string("%.2f", price).alias("two"),
        F.format_number(price, 2).alias("thousands"),
        F.lpad(c("l_orderkey").cast("string"), 10, "0").alias("padded"),
        F.concat(F.rpad("l_returnflag", 4, "."), F.lpad("l_linestatus", 3, " ")).alias("aligned"),
        F.format_string("%.1f%%", c("l_discount") * 100).alias("percent"),
        F.hex("l_partkey").alias("hexed"),
        F.bin("l_linenumber").alias("binary"),
        strings.money_text(price).alias("money"),
    )


@query(
    "str_encode",
    """SELECT doc_id, octet_length(encode(text)) AS n_bytes, length(text) AS n_chars, md5(decode(encode(text))) AS back_md5,
          decode(encode(text)) = text AS same FROM documents""",
    ints="n_bytes n_chars",
)
def str_encode(spark, folder):
    data = F.encode("text", "UTF-8")
    back = F.decode(data, "UTF-8")
    return load(spark, folder, "documents").select(
        "doc_id",
        F.octet_length(data).alias("n_bytes"),
        F.length("text").alias("n_chars"),
        F.md5(back).alias("back_md5"),
        (back == c("text")).alias("same"),
    )


@query(
    "regex_mask",
    rf"""SELECT doc_id, len(regexp_extract_all(text, '{strings.DOTTED_ADDRESS}')) AS n_addresses,
          regexp_extract(text, '[0-9]+') AS first_number, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers,
          md5(regexp_replace(text, '{strings.DOTTED_ADDRESS}', '[ip]', 'g')) AS masked_md5 FROM documents""",
    ints="n_addresses n_numbers",
)
def regex_mask(spark, folder):
    text = c("text")
    return load(spark, folder, "documents").select(
        "doc_id",
        F.regexp_count(text, F.lit(strings.DOTTED_ADDRESS)).alias("n_addresses"),
        F.regexp_extract(text, "[0-9]+", 0).alias("first_number"),
        F.size(F.regexp_extract_all(text, F.lit("([0-9]+)"))).alias("n_numbers"),
        F.md5(strings.mask(text)).alias("masked_md5"),
    )


@query(
    "text_normalize",
    rf"""SELECT doc_id, md5(regexp_replace(lower(trim(text)), '{strings.PUNCTUATION}', '', 'g')) AS normal_md5,
           length(regexp_replace(lower(trim(text)), '{strings.PUNCTUATION}', '', 'g')) AS n FROM documents""",
    ints="n",
)
def text_normalize(spark, folder):
    normal = load(spark, folder, "documents").select("doc_id", strings.normalize(c("text")).alias("t"))
    return normal.select("doc_id", F.md5("t").alias("normal_md5"), F.length("t").alias("n"))


_HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"


@query(
    "domain_class",
    f"""WITH t AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN {_HOST} WHEN page_id % 10 <> 1
            THEN 'owner@' || regexp_extract({_HOST}, '([^.]+\\.[^.]+)$', 1) END AS address FROM pages)
       SELECT page_id, CASE WHEN address IS NULL OR NOT contains(address, '@') THEN 'invalid'
         WHEN split_part(address, '@', 2) = 'example.com' THEN 'internal'
         WHEN split_part(address, '@', 2) IN ('example.org') THEN 'external_partner' ELSE 'unknown' END AS kind FROM t""",
)
def domain_class(spark, folder):
    """Class of the contact address of a page; some pages have none or a broken one."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    owner = F.concat(F.lit("owner@"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
    address = F.when(c("page_id") % 10 == 0, host).when(c("page_id") % 10 != 1, owner)
    return load(spark, folder, "pages").select(
        "page_id", strings.domain_class(address, ["example.com"], ["example.org"]).alias("kind")
    )


@query(
    "log_parse",
    rf"""WITH {D.LOG_LINES}, p AS (SELECT event_id AS line_id, line,
            regexp_extract(line, '{logs.LINE}', ['ts', 'level', 'event_id', 'user_id', 'action', 'message']) AS f,
            regexp_matches(line, '{logs.LINE}') AS good FROM lines)
        SELECT line_id, good AS parsed, CASE WHEN good THEN f.ts END AS ts, CASE WHEN good THEN f.level END AS level,
          CASE WHEN good THEN try_cast(f.event_id AS BIGINT) END AS event_id, CASE WHEN good THEN try_cast(f.user_id AS BIGINT) END AS user_id,
          CASE WHEN good THEN f.action END AS action, CASE WHEN good THEN f.message END AS message FROM p""",
)
def log_parse(spark, folder):
    parsed = D.log_lines(spark, folder).select(c("event_id").alias("line_id"), logs.parse_line(c("line")).alias("p"))
    return parsed.select("line_id", c("p").isNotNull().alias("parsed"), "p.*")


@query(
    "clean_price",
    f"""WITH {D.DIRTY_ORDERS}, t AS (SELECT order_id, attempt, price_text AS p FROM dirty)
        SELECT order_id, attempt, try_cast(p AS DOUBLE) AS amount,
               CASE WHEN p = 'N/A' THEN 'cannot parse price: N/A' END AS error FROM t""",
)
def clean_price(spark, folder):
    """Prices written as $1,234.56 or, when negative, as (1,234.56)."""
    feed = D.dirty_orders(spark, folder)
    number = c("price_text").try_cast("double")
    dressed = (
        F.when(number < 0, F.concat(F.lit("("), F.format_number(-number, 2), F.lit(")")))
        .when(number >= 0, F.concat(F.lit(" $"), F.format_number(number, 2)))
        .otherwise(c("price_text"))
    )
    return feed.select("order_id", "attempt", strings.clean_price(dressed).alias("p")).select("order_id", "attempt", "p.*")


@query(
    "arith",
    """SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS added, l_partkey - l_suppkey * 40 AS taken,
         l_quantity * l_tax AS times, l_partkey / (l_suppkey + 1) AS ratio,
         floor((l_suppkey - l_partkey) / 7)::BIGINT AS down, ((l_suppkey - l_partkey) % 7 + 7) % 7 AS rest,
         ((l_partkey % -5) - 5) % -5 AS negative_rest, pow(l_linenumber, 3) AS cubed FROM lineitem""",
)
def arith(spark, folder):
    """The seven operators; division rounds down and the remainder has the divisor's sign."""
    p, s = c("l_partkey"), c("l_suppkey")
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (p + s).alias("added"),
        (p - s * 40).alias("taken"),
        (c("l_quantity") * c("l_tax")).alias("times"),
        (p / (s + 1)).alias("ratio"),
        numbers.floor_div(s - p, F.lit(7)).alias("down"),
        numbers.modulo(s - p, F.lit(7)).alias("rest"),
        numbers.modulo(p, F.lit(-5)).alias("negative_rest"),
        F.power(c("l_linenumber"), F.lit(3)).alias("cubed"),
    )


@query(
    "compare_logic",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt, order_id BETWEEN 100 AND 5000 AS chained,
          customer_id IS NOT NULL AND customer_id > 500 AS both, customer_id IS NULL OR status = 'F' AS either,
          coalesce(customer_id, -1) AS customer, CASE WHEN order_id % 3 = 0 THEN 'none' ELSE status END AS state FROM dirty""",
)
def compare_logic(spark, folder):
    blank = F.when(c("order_id") % 3 == 0, "").otherwise(c("status"))
    return D.dirty_orders(spark, folder).select(
        "order_id",
        "attempt",
        c("order_id").between(100, 5000).alias("chained"),
        (c("customer_id").isNotNull() & (c("customer_id") > 500)).alias("both"),
        (c("customer_id").isNull() | (c("status") == "F")).alias("either"),
        numbers.or_default(c("customer_id"), -1).alias("customer"),
        numbers.or_default(blank, "none", blank_is_missing=True).alias("state"),
    )


@query(
    "bitwise",
    """SELECT event_id, event_id & 12 AS band, event_id | 12 AS bor, xor(event_id, 12) AS bxor, ~event_id AS bnot,
              event_id << 2 AS left2, event_id >> 2 AS right2 FROM events""",
)
def bitwise(spark, folder):
    e = c("event_id")
    return load(spark, folder, "events").select(
        "event_id",
        e.bitwiseAND(12).alias("band"),
        e.bitwiseOR(12).alias("bor"),
        e.bitwiseXOR(12).alias("bxor"),
        F.bitwise_not(e).alias("bnot"),
        F.shiftleft(e, 2).alias("left2"),
        F.shiftright(e, 2).alias("right2"),
    )


@query(
    "safe_cast",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt, try_cast(price_text AS DOUBLE) AS price,
          trunc(try_cast(price_text AS DOUBLE))::BIGINT AS whole, round_even(order_id / 2, 0)::DOUBLE AS even_half,
          order_id + 0.5::DOUBLE AS widened FROM dirty""",
)
def safe_cast(spark, folder):
    price = numbers.to_number(c("price_text"))
    return D.dirty_orders(spark, folder).select(
        "order_id",
        "attempt",
        price.alias("price"),
        numbers.truncate(price).alias("whole"),
        numbers.half_even(c("order_id") / 2).alias("even_half"),
        (c("order_id") + F.lit(0.5)).alias("widened"),
    )


@query(
    "line_total",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity * (1 - l_discount) AS total,
              l_extendedprice * l_quantity * (1 - l_discount) >= 1000000 AS is_priority FROM lineitem""",
)
def line_total(spark, folder):
    total = numbers.line_total(c("l_extendedprice"), c("l_quantity"), c("l_discount"))
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", total.alias("total"), (total >= 1_000_000).alias("is_priority")
    )


@query(
    "overflow_check",
    """SELECT p_partkey, try_cast(p_size + 100 AS TINYINT) AS narrow_sum, p_size + 100 > 127 AS overflows FROM part""",
)
def overflow_check(spark, folder):
    """Sums in one byte: a value that does not fit is null and flagged, never wrapped."""
    narrow = numbers.narrow_add(c("p_size"), F.lit(100), "tinyint")
    return load(spark, folder, "part").select("p_partkey", narrow.alias("narrow_sum"), narrow.isNull().alias("overflows"))


@query(
    "band_case",
    """SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'A' WHEN p_size >= 25 THEN 'B' WHEN p_size >= 10 THEN 'C' ELSE 'D' END AS grade,
         CASE WHEN p_retailprice > 1000 THEN CASE WHEN p_size > 25 THEN 'big' ELSE 'dear' END ELSE 'plain' END AS nested FROM part""",
)
def band_case(spark, folder):
    size = c("p_size")
    return load(spark, folder, "part").select(
        "p_partkey",
        F.when(size >= 40, "A").when(size >= 25, "B").when(size >= 10, "C").otherwise("D").alias("grade"),
        F.when(c("p_retailprice") > 1000, F.when(size > 25, "big").otherwise("dear")).otherwise("plain").alias("nested"),
    )


@query(
    "match_case",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'browse' WHEN event_type = 'purchase' THEN 'buy'
              WHEN event_type = 'signup' THEN 'join' ELSE 'other' END AS kind,
         CASE WHEN event_id % 3 = 0 AND user_id % 3 = 0 THEN 'origin' WHEN event_id % 3 = 0 THEN 'y axis at ' || (user_id % 3)
              WHEN user_id % 3 = 0 THEN 'x axis at ' || (event_id % 3) ELSE 'plane' END AS place FROM events""",
)
def match_case(spark, folder):
    """Match of values with alternatives, and of points by their fields."""
    e = c("event_type")
    kind = F.when(e.isin("click", "view"), "browse").when(e == "purchase", "buy").when(e == "signup", "join")
    point = F.struct((c("event_id") % 3).alias("x"), (c("user_id") % 3).alias("y"))
    x, y = c("point.x"), c("point.y")
    place = (
        F.when((x == 0) & (y == 0), "origin")
        .when(x == 0, F.concat(F.lit("y axis at "), y.cast("string")))
        .when(y == 0, F.concat(F.lit("x axis at "), x.cast("string")))
        .otherwise("plane")
    )
    events = load(spark, folder, "events").withColumn("point", point)
    return events.select("event_id", kind.otherwise("other").alias("kind"), place.alias("place"))


@query(
    "order_guard",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt, CASE WHEN customer_id IS NULL THEN 'no customer'
          WHEN try_cast(price_text AS DOUBLE) IS NULL THEN 'price is not a number'
          WHEN try_cast(price_text AS DOUBLE) <= 0 THEN 'price must be positive'
          WHEN status NOT IN ('F', 'O', 'P') THEN 'unknown status' ELSE 'ok' END AS reason FROM dirty""",
)
def order_guard(spark, folder):
    """Guard clauses in order; the first that applies gives the reason."""
    price = numbers.to_number(c("price_text"))
    reason = (
        F.when(c("customer_id").isNull(), "no customer")
        .when(price.isNull(), "price is not a number")
        .when(price <= 0, "price must be positive")
        .when(~c("status").isin("F", "O", "P"), "unknown status")
        .otherwise("ok")
    )
    return D.dirty_orders(spark, folder).select("order_id", "attempt", reason.alias("reason"))


@query(
    "date_multi_format",
    f"""WITH {D.DIRTY_ORDERS} SELECT order_id, attempt, CASE WHEN order_id % 13 <> 2 THEN order_date END AS parsed FROM dirty""",
)
def date_multi_format(spark, folder):
    """Dates written year first or day first; some are no dates at all."""
    day = c("order_date").cast("date")
    text = (
        F.when(c("order_id") % 13 == 2, "soon")
        .when(c("order_id") % 2 == 0, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(c("order_date"))
    )
    parsed = dates.parse_date(text)
    return D.dirty_orders(spark, folder).select("order_id", "attempt", F.date_format(parsed, "yyyy-MM-dd").alias("parsed"))


@query(
    "staleness",
    """SELECT o_orderkey, datediff('day', o_orderdate::DATE, DATE '2001-08-01') AS age,
              datediff('day', o_orderdate::DATE, DATE '2001-08-01') > 2 AS is_stale,
              len(generate_series(o_orderdate::DATE, DATE '2001-08-01', INTERVAL 1 DAY)) AS n_days FROM orders""",
    ints="age n_days",
)
def staleness(spark, folder):
    day = F.to_date("o_orderdate")
    return load(spark, folder, "orders").select(
        "o_orderkey",
        dates.age_in_days(day, "2001-08-01").alias("age"),
        dates.is_stale(day, "2001-08-01").alias("is_stale"),
        (F.datediff(F.lit("2001-08-01").cast("date"), day) + 1).alias("n_days"),
    )
