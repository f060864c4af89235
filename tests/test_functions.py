"""Column functions against what Python itself gives."""

import itertools

import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays, dates, jsons, logs, maps, numbers, slicing, strings

c = F.col


def one(spark, kind, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", expression.alias("y")).orderBy("i").collect()]


BOUNDS = [None, -9, -3, -1, 0, 1, 2, 5, 9]
CASES = [(a, b, s) for a, b, s in itertools.product(BOUNDS, BOUNDS, (1, 2, -1, -2))]


def test_array_slices_follow_python(spark):
    data = [[], [1], [1, 2, 3], [1, 2, 3, 4, 5, 6]]
    df = spark.createDataFrame([(d,) for d in data], "x array<int>")
    for block in range(0, len(CASES), 60):
        part = CASES[block : block + 60]
        row = df.select("x", *[slicing.array_slice(c("x"), *k).alias(str(k)) for k in part]).collect()
        for r in row:
            for k in part:
                assert r[str(k)] == r["x"][k[0] : k[1] : k[2]], (r["x"], k)


def test_char_slices_follow_python(spark):
    texts, cases = ["", "a", "spark", "prémices"], CASES[::5]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for r in df.select("x", *[slicing.char_slice(c("x"), *k).alias(str(k)) for k in cases]).collect():
        for k in cases:
            assert r[str(k)] == r["x"][k[0] : k[1] : k[2]], (r["x"], k)


def test_strings(spark):
    texts = ["hello-world of DATA", "", "x1y z", "été à-vent"]
    assert one(spark, "string", texts, strings.title_case(c("x"))) == [t.title() for t in texts]
    assert one(spark, "string", texts, strings.capitalize(c("x"))) == [t.capitalize() for t in texts]
    assert one(spark, "string", ["--a-b-", "", "--"], strings.strip_chars(c("x"), "-")) == ["a-b", "", ""]
    assert one(spark, "string", ["banana", "", "nan"], strings.find(c("x"), "an")) == [1, -1, 1]
    assert one(spark, "string", ["banana", "aaaa"], strings.count_of(c("x"), "a")) == [3, 4]
    assert one(spark, "string", ["aaaa"], strings.count_of(c("x"), "aa")) == ["aaaa".count("aa")]
    assert one(spark, "string", [" a\tb\n c ", ""], strings.words(c("x"))) == [["a", "b", "c"], []]
    assert one(spark, "string", ["a.b.c", "abc"], strings.split_max(c("x"), ".", 1)) == [["a", "b.c"], ["abc"]]
    assert one(spark, "string", ["a\nb\r\nc", "x"], strings.lines(c("x"))) == [["a", "b", "c"], ["x"]]
    assert one(spark, "string", ["12", "", "1a", "é1"], strings.is_digits(c("x"))) == [True, False, False, False]
    assert one(spark, "string", ["é1", "", "a b"], strings.is_alnum(c("x"))) == [True, False, False]
    assert one(spark, "string", ["  Hi, (You)! "], strings.normalize(c("x"))) == ["hi you"]
    assert one(spark, "string", ["from 10.1.22.333 to 1.2.3.4!"], strings.mask(c("x"))) == ["from [ip] to [ip]!"]
    with pytest.raises(Exception, match="substring not found"):
        one(spark, "string", ["abc"], strings.index_of(c("x"), "z"))


def test_domain_class(spark):
    mails = ["a@home.org", "b@PARTNER.net", "c@else.io", "broken", None]
    got = one(spark, "string", mails, strings.domain_class(c("x"), ["home.org"], ["partner.net"]))
    assert got == ["internal", "external_partner", "unknown", "invalid", "invalid"]


def test_prices(spark):
    texts = ["$1,200.50", " 7 ", "(3.25)", "$0", "-4", ".5", "abc", "", None, "1.2.3", "NaN", "1e3"]
    got = [tuple(r) for r in one(spark, "string", texts, strings.clean_price(c("x")))]
    assert [g[0] for g in got] == [1200.5, 7.0, -3.25, 0.0, -4.0, 0.5, None, None, None, None, None, None]
    assert [g[1] is None for g in got] == [True] * 6 + [False] * 6


def test_logs(spark):
    lines = ["2024-05-01 10:00:00 ERROR event_id=5 user=9 action=view message=went wrong = yes", "2024-05-01 ERROR", "", None]
    got = one(spark, "string", lines, logs.parse_line(c("x")))
    assert got[0].asDict() == {
        "ts": "2024-05-01 10:00:00", "level": "ERROR", "event_id": 5, "user_id": 9, "action": "view",
        "message": "went wrong = yes",
    }
    assert got[1:] == [None, None, None]


def test_numbers(spark):
    pairs = [(a, b) for a in (-7, -1, 0, 1, 7, 8) for b in (-3, -2, 2, 3)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for r in df.select("a", "b", numbers.floor_div(c("a"), c("b")).alias("q"), numbers.modulo(c("a"), c("b")).alias("m")).collect():
        assert (r["q"], r["m"]) == (r["a"] // r["b"], r["a"] % r["b"])
    halves = [0.5, 1.5, 2.5, -0.5, -1.5]
    assert one(spark, "double", halves, numbers.half_even(c("x"))) == [float(round(h)) for h in halves]
    assert one(spark, "double", [2.9, -2.9], numbers.truncate(c("x"))) == [2, -2]
    assert one(spark, "string", ["3.5", "x", None], numbers.to_number(c("x"))) == [3.5, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "string", ["x"], numbers.to_number(c("x"), errors="raise"))
    assert one(spark, "int", [100, 7, 300], numbers.narrow_add(c("x"), F.lit(100), "tinyint")) == [None, 107, None]


def test_dates(spark):
    texts = ["2024-02-29", "31/12/2021", "29/02/2023", "soon", None]
    got = one(spark, "string", texts, dates.parse_date(c("x")))
    assert [str(d) if d else None for d in got] == ["2024-02-29", "2021-12-31", None, None, None]
    stale = one(spark, "string", ["2024-03-01", "2024-02-20", None], dates.is_stale(c("x").cast("date"), "2024-03-02"))
    assert stale == [False, True, False]


def test_vectors(spark):
    v = [[1.0, 2.0, 3.0], [4.0, 4.0, 4.0]]
    assert one(spark, "array<double>", v, arrays.add(c("x"), arrays.scale(c("x"), 2.0))) == [[3.0, 6.0, 9.0], [12.0] * 3]
    assert one(spark, "array<double>", v, F.round(arrays.std(c("x")), 6)) == [0.816497, 0.0]
    assert one(spark, "array<double>", v, arrays.gather(c("x"), F.array(F.lit(2), F.lit(9)))) == [[3.0, None], [4.0, None]]
    with pytest.raises(Exception, match="differ in length"):
        one(spark, "array<double>", v, arrays.add(c("x"), F.array(F.lit(1.0))))
    m = [[[1, 2], [3, 4], [5, 6]]]
    assert one(spark, "array<array<int>>", m, arrays.transpose(c("x"))) == [[[1, 3, 5], [2, 4, 6]]]


def test_maps(spark):
    m = [{"a": 1, "b": 2}, {}]
    newer = F.create_map(F.lit("b"), F.lit(9), F.lit("c"), F.lit(3))
    assert one(spark, "map<string,int>", m, maps.merge(c("x"), newer)) == [{"a": 1, "b": 9, "c": 3}, {"b": 9, "c": 3}]
    assert one(spark, "map<string,int>", m, maps.get(c("x"), "b", -1)) == [2, -1]
    assert one(spark, "map<string,int>", m, maps.first_n(c("x"), 1)) == [{"a": 1}, {}]
    df = spark.createDataFrame([(1, {"a": 5, "b": 5, "c": 6})], "k int, m map<string,int>")
    assert maps.invert(df, "k", "m").first()["inverted"] == {5: "b", 6: "c"}
    twice = spark.createDataFrame([(1, "a", 1), (1, "a", 2)], "g int, k string, v int")
    with pytest.raises(Exception, match="duplicate key a"):
        maps.from_records(twice, "g", "k", "v").collect()


def test_documents(spark):
    text = '{"id": 7, "who": {"name": "Ann", "tags": ["x", {"deep": true}]}, "none": null}'
    df = spark.createDataFrame([(1, text), (2, None)], "k int, doc string")
    got = {r["path"]: r["value"] for r in jsons.json_paths(df, "k", "doc").collect()}
    assert got == {"id": "7", "who.name": "Ann", "who.tags[0]": "x", "who.tags[1].deep": "true", "none": "null"}
    odd = ['{"a":{"b":[1,2.5,null,{"c":true}]},"e":[],"f":{},"g":"","é x":[[1],["y"]]}', "7", "[[1],[2,[3]]]", '"t"', "{}"]
    spread = jsons.json_paths(spark.createDataFrame(list(enumerate(odd)), "k int, doc string"), "k", "doc").collect()
    assert {(r["k"], r["path"], r["value"]) for r in spread} == {
        (0, "a.b[0]", "1"), (0, "a.b[1]", "2.5"), (0, "a.b[2]", "null"), (0, "a.b[3].c", "true"), (0, "g", ""), (0, "é x[0][0]", "1"),
        (0, "é x[1][0]", "y"), (1, "", "7"), (2, "[0][0]", "1"), (2, "[1][0]", "2"), (2, "[1][1][0]", "3"), (3, "", "t"),
    }
    safe = one(spark, "string", [text], F.struct(jsons.safe_get(c("x"), "who.tags[1].deep").alias("a"), jsons.safe_get(c("x"), "who.age", "?").alias("b")))
    assert tuple(safe[0]) == ("true", "?")
    nested = spark.createDataFrame([(1, (2, ("n",)), [(5, "a"), (6, "b")])], "id int, s struct<x:int,y:struct<z:string>>, items array<struct<q:int,r:string>>")
    assert jsons.flatten(nested).columns == ["id", "s.x", "s.y.z", "items"]
    normal = jsons.normalize(nested, "items", ["id", "s.y.z"], "item_")
    assert [tuple(r) for r in normal.collect()] == [(1, "n", 5, "a"), (1, "n", 6, "b")]
