"""Joins, sets, cleaning, quality, documents and loads on small inputs."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import aggregate as A
from millrace.operators import clean as C
from millrace.operators import documents as M
from millrace.operators import joins as J
from millrace.operators import load as L
from millrace.operators import quality as Q
from millrace.operators import select as S
from millrace.operators import sets as X
from millrace.operators import tables as B
from millrace.session import fresh_path


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


# joins


def test_join_checks(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, name string")
    with pytest.raises(J.JoinKeyError):
        J.validated_join(facts, dim, ["k"])
    fixed = X.dedup(dim, ["k"], ["name"])
    assert J.validated_join(facts, fixed, ["k"]).count() == 3
    assert J.validated_join(facts, dim, ["k"], validate="one_to_many").count() == 4
    with pytest.raises(J.JoinKeyError):
        J.natural_join(facts, spark.createDataFrame([(1,)], "other int"))
    with pytest.raises(ValueError):
        J.validated_join(facts, dim, ["k"], validate="some")


def test_aligned_add_and_products(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("y", 5.0), ("z", 7.0)], "k string, v double")
    assert values(J.aligned_add(a, b, "k", "v", "s")) == [("x", None), ("y", 7.0), ("z", None)]
    assert values(J.aligned_add(a, b, "k", "v", "s", fill=0.0)) == [("x", 1.0), ("y", 7.0), ("z", 7.0)]
    assert J.product(a, b.withColumnRenamed("k", "j").drop("v")).count() == 4
    assert J.product(a, b.filter("v < 0").select(F.col("k").alias("j"))).count() == 0
    assert J.product(a, a.sparkSession.range(3000)).count() == 6000


def test_zip_stops_at_the_shorter_side(spark):
    a = spark.createDataFrame([(i,) for i in (3, 1, 2)], "a int")
    b = spark.createDataFrame([(i,) for i in (50, 40, 30, 20)], "b int")
    assert values(J.zip_rows(a, b, ["a"], ["b"]), "a", "b") == [(1, 20), (2, 30), (3, 40)]


# selection and aggregation


def test_truth(spark):
    df = spark.createDataFrame(
        [(0, "", False, []), (1, "a", True, [1]), (None, None, None, None)], "n int, s string, b boolean, a array<int>"
    )
    for column in df.columns:
        assert S.drop_falsy(df, column).count() == 1


def test_argmax_and_ranges(spark):
    df = spark.createDataFrame([(1.0, 5.0, 5.0), (9.0, 2.0, 3.0)], "x double, y double, z double")
    assert [r[0] for r in df.select(A.row_argmax(["x", "y", "z"])).collect()] == ["y", "x"]
    assert values(A.column_ranges(df, ["x", "y"])) == [("x", 8.0), ("y", 3.0)]


def test_reduce_on_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert A.global_reduce(empty, "v", 4.0).first().asDict() == {"total": 4.0, "product": 1.0, "largest": 4.0}
    assert A.top_record(empty.withColumn("id", F.lit(1)), "v", "id").count() == 0


def test_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "b"), (None, None)], "v double, s string")
    got = {r["column"]: r for r in A.profile(df, ["v"], ["s"]).collect()}
    assert (got["v"]["n"], got["v"]["nulls"], got["v"]["q50"], got["v"]["max"]) == (3, 1, 2.0, 4.0)
    assert (got["s"]["n"], got["s"]["nulls"], got["s"]["n_unique"], got["s"]["top"], got["s"]["freq"]) == (3, 1, 2, "b", 2)


# sets


def test_sets(spark):
    a = spark.createDataFrame([(x,) for x in "AABC"], "k string")
    b = spark.createDataFrame([(x,) for x in "BCD"], "k string")
    assert values(X.symmetric_difference(a, b, "k")) == [("A", "left"), ("D", "right")]
    assert X.set_relations(a, b, "k").first().asDict() == {
        "is_subset": False, "is_superset": False, "is_disjoint": False, "is_equal": False,
    }
    inside = X.set_relations(b.filter("k = 'B'"), b, "k").first()
    assert inside["is_subset"] and not inside["is_superset"]
    numbered = X.concat_rows([a, b.withColumn("extra", F.lit(1))], ["k"])
    assert [r["row_id"] for r in numbered.orderBy("row_id").collect()] == list(range(7))


def test_dedup_and_marks(spark):
    df = spark.createDataFrame([("a", i) for i in range(6)] + [("b", 9)], "k string, seq int")
    assert values(X.dedup(df, ["k"], ["seq"])) == [("a", 0), ("b", 9)]
    assert values(X.dedup(df, ["k"], ["seq"], keep="last")) == [("a", 5), ("b", 9)]
    assert values(X.dedup_with_count(df, ["k"], ["seq"])) == [("a", 0, 5), ("b", 9, 0)]
    marks = X.mark_duplicates(df, ["k"], ["seq"])
    got = {r["seq"]: (r["dup_keep_first"], r["dup_keep_last"], r["dup_all"]) for r in marks.collect()}
    want = {i: (i > 0, i < 5, True) for i in range(6)}
    assert got == {**want, 9: (False, False, False)}


# cleaning


def test_cleaning_twice_changes_nothing(spark):
    feed = spark.createDataFrame(
        [(1, 0, "x", 10.0), (1, 1, "x", None), (2, 0, None, 5.0), (3, 0, "y", 30.0), (4, 0, "z", 20.0)],
        "id int, attempt int, customer string, amount double",
    )
    once = C.clean_order_feed(feed, "id", ["attempt"], ["id", "customer"], "amount")
    assert values(once, "id", "amount") == [(1, 25.0), (3, 30.0), (4, 20.0)]
    assert values(C.clean_order_feed(once, "id", ["attempt"], ["id", "customer"], "amount")) == values(once)


def test_fill_rules(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (4.0, "b"), (100.0, None)], "v double, s string")
    def fills(frame, rules):
        return frame.sparkSession.range(1).select(*[v.alias(c) for c, v in C.fill_values(frame, rules).items()]).first().asDict()

    assert fills(df, {"v": "median", "s": "mode"}) == {"v": 4.0, "s": "b"}
    assert fills(df, {"v": "mean"}) == {"v": 35.0}
    assert C.fill_nulls(df, {"v": 0.0, "s": "?"}).filter("v = 0 or s = '?'").count() == 2
    assert fills(df.filter("v < 0"), {"v": "median", "s": "mode"}) == {"v": None, "s": None}


def test_times_at_midnight_are_dates(spark):
    df = spark.sql("select timestamp_ntz'2024-01-05' as a, timestamp'2024-01-05 10:00:00' as b")
    assert {r["column"]: r["to_type"] for r in C.narrowing_report(df).collect()} == {"a": "date", "b": "timestamp"}
    assert dict(C.narrow(df).dtypes) == {"a": "date", "b": "timestamp"}


def test_profile_of_every_kind_of_column(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y"), (4, 6.0, "y"), (None, 1.0, None)], "i int, d double, s string")
    rows = {r["column"]: r for r in A.profile(df, ["i", "d"], ["s"]).collect()}
    assert (rows["i"]["n"], rows["i"]["nulls"], rows["i"]["q50"], rows["d"]["max"]) == (3, 1, 2.0, 6.0)
    assert (rows["s"]["n"], rows["s"]["nulls"], rows["s"]["n_unique"], rows["s"]["top"], rows["s"]["freq"]) == (3, 1, 2, "y", 2)


def test_narrowing_loses_nothing(spark):
    df = spark.createDataFrame(
        [(i, i * 1000, 2**40 + i, i / 2, 0.1 * i, "ab"[i % 2], str(i)) for i in range(-100, 100)],
        "a bigint, b bigint, c bigint, d double, e double, f string, g string",
    )
    report = {r["column"]: r["to_type"] for r in C.narrowing_report(df).collect()}
    assert report == {
        "a": "tinyint", "b": "int", "c": "bigint", "d": "float", "e": "double", "f": "category", "g": "string",
    }
    narrow = C.narrow(df)
    assert dict(narrow.dtypes)["a"] == "tinyint" and dict(narrow.dtypes)["d"] == "float"
    assert values(narrow.select(*[F.col(c).cast(t) for c, t in df.dtypes])) == values(df)


# quality


def test_rules_and_quarantine(spark):
    known = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    batch = spark.createDataFrame(
        [(10, 1, "3", 6.0), (11, None, "x", 6.0), (12, 9, "1", 2.5), (12, 2, "1", 2.0), (None, 1, "1", 1.0), (None, 1, "1", 1.0)],
        "id int, customer int, qty string, total double",
    )
    qty = F.col("qty").try_cast("double")
    table = [
        Q.Expect("named", "note", holds=F.col("customer").isNotNull()),
        Q.Expect("once", "stop", single=("id",)),
        Q.Expect("small", "stop", holds=qty.between(1, 2)),
        Q.Expect("on_file", "stop", listed=("customer", known, "id")),
        Q.Expect("size", "stop", size=(1, 100)),
    ]
    found = Q.audit(batch, table)
    summary = {r["rule"]: (r["met"], r["n_broken"], r["n_rows"]) for r in found.summary().collect()}
    assert summary == {"named": (False, 1, 6), "once": (False, 4, 6), "small": (False, 2, 6), "on_file": (False, 2, 6), "size": (True, 0, 6)}
    assert found.accepted().count() == 0
    reasons = {(r["id"], r["customer"]): r["broken_rules"] for r in found.refused().collect()}
    assert reasons[(11, None)] == ["named", "small", "on_file"]
    assert reasons[(12, 2)] == ["once"] and reasons[(None, 1)] == ["once"]
    assert Q.audit(batch, [Q.Expect("size", "stop", size=(7, 9))]).refused().count() == 6
    assert Q.audit(batch.limit(0), table).summary().count() == 5


def test_an_audit_reads_the_batch_once(spark):
    n = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    batch = spark.range(100).repartition(3).mapInArrow(count, "id bigint")
    table = [Q.Expect("once", "stop", single=("id",)), Q.Expect("even", "note", holds=F.col("id") % 2 == 0), Q.Expect("size", "stop", size=(1, 200))]
    found = Q.audit(batch, table)
    assert (found.refused().count(), found.accepted().count(), n.value) == (50, 50, 100)


def test_both_sides_of_an_audit_are_judged_once(spark):
    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    batch = spark.createDataFrame([(1, 1), (1, None), (2, 9), (None, 2), (None, 2), (4, 3)], "id int, v int")
    table = [
        Q.Expect("on_file", "stop", listed=("v", spark.range(5), "id")),
        Q.Expect("once", "stop", single=("id",)),
        Q.Expect("known", "note", holds=F.col("v").isNotNull()),
        Q.Expect("size", "stop", size=(1, 6)),
    ]
    found = Q.audit(batch, table)
    # a join for each of two rules; the size is counted without them
    assert joins(found.refused()) == 2
    accepted, refused = found.split()
    assert (joins(accepted), joins(refused)) == (0, 0)
    assert accepted.columns == ["id", "v"] and accepted.collect() == found.accepted().collect() == [(4, 3)]
    reasons = sorted((r["id"] or 0, r["v"] or 0, r["broken_rules"]) for r in refused.collect())
    assert reasons == sorted((r["id"] or 0, r["v"] or 0, r["broken_rules"]) for r in found.refused().collect())
    assert reasons == [(0, 2, ["once"]), (0, 2, ["once"]), (1, 0, ["on_file", "once", "known"]), (1, 1, ["once"]), (2, 9, ["on_file"])]
    assert Q.audit(batch, []).accepted().count() == 6


def test_a_report_stores_nothing(spark, monkeypatch):
    monkeypatch.setattr(Q, "stage", lambda *_: pytest.fail("a report needs counts only"))
    batch = spark.createDataFrame([(None, 1), (None, 2), (1, None), (1, 7), (2, 7)], "k int, v int")
    table = [Q.Expect("once", "stop", single=("k",)), Q.Expect("on_file", "stop", listed=("v", spark.range(5), "id")), Q.Expect("size", "stop", size=(9, 10))]
    assert {r["rule"]: r["n_broken"] for r in Q.audit(batch, table).summary().collect()} == {"once": 4, "on_file": 3, "size": 5}
    assert {r["rule"]: (r["n_broken"], r["n_rows"]) for r in Q.audit(batch.limit(0), table).summary().collect()}["once"] == (0, 0)


def test_stops_and_schema_changes(spark):
    df = spark.createDataFrame([(1, "2.5"), (2, "x")], "id int, total string")
    assert Q.refuse_unusable(df, ["id"], {"id": 0.5}) is df
    assert Q.refuse_unusable(df.limit(0), ["id"], {"id": 0.5}).count() == 0
    with pytest.raises(Q.BatchRefused, match="absent: gone"):
        Q.refuse_unusable(df, ["id", "gone"], {})
    with pytest.raises(Q.BatchRefused, match="0% filled"):
        Q.refuse_unusable(df.withColumn("id", F.lit(None)), ["id"], {"id": 0.1})
    expected = T.StructType.fromDDL("id int, total double, place struct<lat: double, name: string>")
    changed = df.withColumn("place", F.struct(F.lit("a").alias("lat"), F.lit(3).alias("zone")))
    rows = {r["field"]: (r["change"], r["expected"], r["found"], r["fits"]) for r in Q.schema_changes(expected, changed).collect()}
    assert rows == {
        "total": ("retyped", "double", "string", False),
        "place.lat": ("retyped", "double", "string", False),
        "place.name": ("absent", "string", None, None),
        "place.zone": ("added", None, "int", None),
    }
    with pytest.raises(Q.BatchRefused, match="place.lat, place.name, total"):
        Q.refuse_lost_fields(Q.schema_changes(expected, changed))
    Q.refuse_lost_fields(Q.schema_changes(T.StructType.fromDDL("id int, total double"), df.filter("id = 1").withColumn("new", F.lit(1))))
    assert Q.schema_changes(df.schema, df).count() == 0


def test_record_validation(spark):
    texts = [
        '{"id": 1, "price": 9.5}', '{"id": "2", "price": "3", "stock": false}', '{"id": 3.0, "price": -1, "zone": "Z"}',
        '{"id": 4.5}', "not json",
    ]
    fields = [Q.Field("id", "int"), Q.Field("price", "double", minimum=0), Q.Field("stock", "boolean", False, True)]
    df = spark.createDataFrame([(t,) for t in texts], "doc string")
    got = {
        r["doc"]: (r["id"], r["price"], r["stock"], [f"{e['field']} {e['reason']}" for e in r["errors"]])
        for r in Q.validate_records(df, "doc", fields, unknown="forbid").collect()
    }
    assert got[texts[0]] == (1, 9.5, True, [])
    assert got[texts[1]] == (2, 3.0, False, [])
    assert got[texts[2]] == (3, -1.0, True, ["price must be at least 0", "zone unknown field"])
    assert got[texts[3]][3] == ["id not a valid int", "price field required"]
    assert got[texts[4]][3] == [" not a JSON object"]


def test_records_are_parsed_once(spark):
    fields = [Q.Field("id", "int"), Q.Field("price", "double", minimum=0), Q.Field("stock", "boolean", False, True)]
    docs = spark.range(3).select(F.concat(F.lit('{"id": '), "id", F.lit("}")).alias("doc"))
    kept = Q.validate_records(docs, "doc", fields).filter(F.size("errors") == 0)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


# documents


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, "west", "shipped", 50.0, (("Oslo",),), [("a", 1)]),
            (2, "east", "open", 20.0, (("Rome",),), []),
            (3, "west", "open", None, None, None),
        ],
        "_id int, region string, status string, total double, customer struct<address:struct<city:string>>, "
        "items array<struct<sku:string,qty:int>>",
    )


def found(df, query):
    return sorted(r["_id"] for r in M.find(df, query).collect())


def test_find(orders):
    assert found(orders, {"total": {"$gt": 10}}) == [1, 2]
    assert found(orders, {"total": {"$ne": 20.0}}) == [1, 3]
    assert found(orders, {"total": None}) == [3]
    assert found(orders, {"customer.address.city": "Rome"}) == [2]
    assert found(orders, {"nowhere.at.all": None, "region": "west"}) == [1, 3]
    assert found(orders, {"nowhere": {"$lt": 3}}) == []
    assert found(orders, {"region": {"$in": ["east", "north"]}, "status": "open"}) == [2]
    with pytest.raises(ValueError):
        M.find(orders, {"total": {"$near": 3}})


def test_update_and_delete(orders):
    def cells(df, column):
        return {r["_id"]: r[column] for r in df.collect()}

    assert cells(M.update(orders, {"region": "west"}, {"$inc": {"total": 5}}), "total") == {1: 55.0, 2: 20.0, 3: 5.0}
    first = M.update(orders, {"region": "west"}, {"$set": {"status": "held"}}, first_by=["_id"])
    assert cells(first, "status") == {1: "held", 2: "open", 3: "open"}
    added = M.update(orders, {"region": "east"}, {"$set": {"priority": True}})
    assert cells(added, "priority") == {1: None, 2: True, 3: None}
    item = F.struct(F.lit("z").alias("sku"), F.lit(9).alias("qty"))
    pushed = cells(M.update(orders, {}, {"$push": {"items": item}}), "items")
    assert [len(pushed[i]) for i in (1, 2, 3)] == [2, 1, 1]
    nested = M.update(orders, {"_id": 1}, {"$set": {"customer.address.city": "Bergen"}})
    assert cells(nested.withColumn("c", F.col("customer.address.city")), "c") == {1: "Bergen", 2: "Rome", 3: None}
    replaced = {r["_id"]: r for r in M.replace(orders, {"_id": 2}, {"status": "gone"}).collect()}
    assert replaced[2]["status"] == "gone" and replaced[2]["region"] is None and replaced[1]["region"] == "west"
    assert cells(M.update(orders, {"_id": 1}, {"$unset": ["total"]}), "total") == {1: None, 2: 20.0, 3: None}
    assert sorted(cells(M.delete(orders, {"status": "open"}, first_by=["_id"]), "_id")) == [1, 3]
    assert sorted(cells(M.delete(orders, {"status": "none"}, first_by=["_id"]), "_id")) == [1, 2, 3]
    assert sorted(cells(M.delete(orders, {"status": "open"}), "_id")) == [1]


def test_match_group(orders):
    spec = {"_id": "$region", "n": {"$sum": 1}, "sum": {"$sum": "$total"}, "mean": {"$avg": "$total"}}
    assert values(M.match_group(orders, {"total": {"$gt": 0}}, spec)) == [("east", 1, 20.0, 20.0), ("west", 1, 50.0, 50.0)]


# SQL


def test_bound_values_and_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b' OR 1=1")], "id int, name string")
    sql = "SELECT id FROM {table} WHERE name = :name"
    assert values(B.bound_query(df, sql, name="x' OR '1'='1")) == []
    assert values(B.bound_query(df, sql, name="b' OR 1=1")) == [(2,)]
    assert B.dynamic_filter(df, {"id": 1}, ["id"]).count() == 1
    with pytest.raises(ValueError):
        B.dynamic_filter(df, {"name": "a"}, ["id"])


# loads


def table(spark, rows):
    made = L.KeyedTable(spark, fresh_path(spark, "t"), "id int, v string", ("id",), buckets=3)
    return made.create(spark.createDataFrame(rows, "id int, v string"))


def test_upsert_is_idempotent(spark):
    t = table(spark, [(i, "old") for i in range(10)])
    changes = spark.createDataFrame([(3, "new"), (3, "newer"), (99, "added")], "id int, v string")
    for _ in range(2):
        t.upsert(changes, ["v"])
    got = dict(values(t.read()))
    assert got == {**{i: "old" for i in range(10)}, 3: "newer", 99: "added"}


def test_inserts(spark):
    t = table(spark, [(1, "a")])
    more = spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string")
    t.insert_if_absent(more, ["v"])
    t.insert_if_absent(more, ["v"])
    assert values(t.read()) == [(1, "a"), (2, "c")]
    with pytest.raises(L.LoadRejected):
        t.insert_strict(more)
    with pytest.raises(L.LoadRejected):
        t.insert_strict(spark.createDataFrame([(7, "x"), (7, "y")], "id int, v string"))
    t.insert_strict(spark.createDataFrame([(7, "x")], "id int, v string"))
    assert t.read().count() == 3


def test_atomic_load_and_replacement(spark):
    path = fresh_path(spark, "atomic")
    good = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, v double")
    assert L.atomic_load(good, path, "one", ["id"], F.col("v") > 0) == 2
    for bad in ([(3, 1.0), (4, None)], [(3, 1.0), (3, 2.0)]):
        with pytest.raises(L.LoadRejected):
            L.atomic_load(spark.createDataFrame(bad, "id int, v double"), path, "two", ["id"], F.col("v") > 0)
    assert L.atomic_load(good, path, "one", ["id"], F.col("v") > 0) == 2
    assert L.read_loads(spark, path, "id int, v double").count() == 2


def test_a_load_that_stops_before_its_commit(spark, monkeypatch):
    t = table(spark, [(i, "old") for i in range(10)])
    changes = spark.createDataFrame([(3, "new"), (99, "added")], "id int, v string")
    path, good = fresh_path(spark, "atomic"), spark.createDataFrame([(1, 5.0)], "id int, v double")
    L.atomic_load(good, path, "one", ["id"], F.col("v") > 0)

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(L.Versions, "commit", stop)
        for act in (
            lambda: t.upsert(changes, ["v"]),
            lambda: t.insert_if_absent(changes, ["v"]),
            lambda: L.atomic_load(good, path, "two", ["id"], F.col("v") > 0),
        ):
            with pytest.raises(KeyboardInterrupt):
                act()
    assert dict(values(t.read())) == {i: "old" for i in range(10)}
    assert L.read_loads(spark, path, "id int, v double").count() == 1
    t.upsert(changes, ["v"])
    assert dict(values(t.read())) == {**{i: "old" for i in range(10)}, 3: "new", 99: "added"}


def test_named_loads_and_bucket_numbers(spark):
    t = table(spark, [(1, "a")])
    more = spark.createDataFrame([(7, "x")], "id int, v string")
    for _ in range(2):
        t.insert_strict(more, load="seven")
    assert values(t.read()) == [(1, "a"), (7, "x")]
    assert L.buckets_for(L.stored_bytes(spark.range(1000)), 1000) == 8 and L.buckets_for(80) == 1


def test_addresses_grow_one_bucket_at_a_time(spark):
    hashes = spark.range(-500, 500)
    before = {r.id: r.b for r in hashes.select("id", L.address(F.col("id"), 1).alias("b")).collect()}
    for n in range(2, 20):
        after = {r.id: r.b for r in hashes.select("id", L.address(F.col("id"), n).alias("b")).collect()}
        moved = {(before[k], after[k]) for k in after if before[k] != after[k]}
        low = 1 << ((n - 1).bit_length() - 1)
        assert moved == {(n - 1 - low, n - 1)}  # rows of one bucket only, to the new one
        assert set(after.values()) == set(range(n))
        before = after


def test_a_table_made_empty_grows_by_its_bytes(spark):
    rows = lambda lo, hi, v: spark.range(lo, hi).select("id", F.sha2(F.concat(F.lit(v), F.col("id").cast("string")), 256).alias("v"))
    schema, want = "id bigint, v string", {}
    t = L.KeyedTable(spark, fresh_path(spark, "grows"), schema, ("id",), bucket_bytes=40_000)
    t.create(spark.createDataFrame([], schema))
    numbers = []
    for k in range(10):
        changes = rows(800 * k, 800 * k + 1000, str(k))
        t.upsert(changes, ["v"])
        want.update({r.id: r.v for r in changes.collect()})
        numbers.append(t.versions.state()["buckets"])
    assert dict(values(t.read())) == want
    pieces = t.pieces().collect()
    size = sum(p["bytes"] for p in pieces)
    assert numbers == sorted(numbers) and numbers[0] < numbers[4] < numbers[-1]
    assert size / 40_000 <= numbers[-1] <= 2 * size / 40_000
    assert len({p["_bucket"] for p in pieces}) == len(pieces) == numbers[-1]  # one live folder per bucket
    assert sum(p["rows"] for p in pieces) == len(want)

    # a change of one key writes its own bucket again, and no other
    before = {p["_bucket"]: p["_folder"] for p in pieces}
    t.upsert(rows(5, 6, "again"), ["v"])
    after = {p["_bucket"]: p["_folder"] for p in t.pieces().collect()}
    assert sum(before[b] != f for b, f in after.items()) == 1 and len(after) == len(before)
    assert t.drop_unused() > 0
    assert t.read().count() == len(want)


def test_inserts_are_put_together(spark):
    t = table(spark, [(0, "a")])
    for k in range(1, 2 * L.MOST_PIECES + 4):
        t.insert_if_absent(spark.createDataFrame([(k * 3 + j, "b") for j in range(3)], "id int, v string"), ["v"])
    per_bucket = t.pieces().groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert per_bucket <= L.MOST_PIECES + 1
    assert t.read().count() == 1 + 3 * (2 * L.MOST_PIECES + 3)


def test_few_folders_stay_live(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_FOLDERS", 4)
    t = L.KeyedTable(spark, fresh_path(spark, "t"), "id int, v string", ("id",), buckets=40)
    t.create(spark.createDataFrame([(k, "a") for k in range(200)], "id int, v string"))
    for k in range(9):
        t.upsert(spark.createDataFrame([(k, "b")], "id int, v string"), ["v"])
    assert len(t.versions.state()["folders"]) <= 6
    assert dict(values(t.read())) == {k: "b" if k < 9 else "a" for k in range(200)}


def test_two_writers_of_one_version(spark, monkeypatch):
    """The second writer sees that the version is taken and starts over from the other's rows."""
    t = table(spark, [(1, "a")])
    path = fresh_path(spark, "atomic")
    one_row = lambda k: spark.createDataFrame([(k, "new")], "id int, v string")
    commit, others = L.Versions.commit, []

    def interrupted(self, version, *args, **kwargs):
        if others:
            others.pop()()  # another load commits first
        return commit(self, version, *args, **kwargs)

    monkeypatch.setattr(L.Versions, "commit", interrupted)
    others.append(lambda: t.upsert(one_row(2), ["v"]))
    t.upsert(one_row(3), ["v"])
    others.append(lambda: t.insert_if_absent(one_row(4), ["v"]))
    t.insert_if_absent(spark.createDataFrame([(4, "late"), (5, "new")], "id int, v string"), ["v"])
    assert dict(values(t.read())) == {1: "a", 2: "new", 3: "new", 4: "new", 5: "new"}
    others.append(lambda: t.insert_strict(one_row(6)))
    with pytest.raises(L.LoadRejected):
        t.insert_strict(one_row(6))
    good = spark.createDataFrame([(1, 5.0)], "id int, v double")
    others.append(lambda: L.atomic_load(good, path, "one", ["id"], F.col("v") > 0))
    L.atomic_load(good, path, "two", ["id"], F.col("v") > 0)
    assert values(L.read_loads(spark, path, "id int, v double").select("load_id", "id")) == [("one", 1), ("two", 1)]


def test_only_one_of_many_writers_commits(spark):
    versions = L.Versions(spark, fresh_path(spark, "race"))

    def attempt(k):
        try:
            versions.commit(0, f"load {k}")
            return k
        except L.Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [k for k in pool.map(attempt, range(8)) if k is not None]
    assert len(won) == 1 and versions.state()["load"] == f"load {won[0]}"
    assert versions.has(f"load {won[0]}") and not versions.has("x' or 'a' = 'a")


def test_retry():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return "done"

    assert L.with_retry(flaky, base=1.0, cap=3.0, sleep=waits.append) == "done"
    assert len(waits) == 2 and all(0 <= w <= 3.0 for w in waits)
    with pytest.raises(ConnectionError):
        L.with_retry(lambda: (_ for _ in ()).throw(ConnectionError()), attempts=2, sleep=waits.append)
    with pytest.raises(KeyError):
        L.with_retry(lambda: {}["x"], sleep=lambda _: pytest.fail("must not retry"))
