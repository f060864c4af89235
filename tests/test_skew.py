"""Salting gives what the direct plan gives, and broadcasts are checked."""

from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import custom
from millrace.operators import skew as K
from millrace.plans import physical
from millrace.plans.derived import nested_orders
from millrace.session import drop_stages, stage
from millrace.tables import load


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("c_"), F.col("id") % 37)).when(F.col("id") % 101 != 3, "c_hot").alias("k")
    )
    other = spark.createDataFrame(
        [("c_hot", 1), ("c_hot", 2), ("c_1", 3), ("c_5", 4), ("none", 5), (None, 6)], "k string, w int"
    )
    return big, other


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [10**6, 500, 7])
def test_salted_join_equals_join(sides, how, limit):
    big, other = sides
    want = sorted(map(str, big.join(other, ["k"], how).collect()))
    assert sorted(map(str, K.salted_join(big, other, ["k"], ["id"], how, limit).collect())) == want


def test_salted_join_knows_its_kinds(sides):
    with pytest.raises(ValueError):
        K.salted_join(*sides, ["k"], ["id"], "cross")


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "left_semi", "left_anti"])
def test_spread_join_equals_join(sides, how):
    big, other = sides
    want = sorted(map(str, big.join(other, ["k"], how).collect()))
    assert sorted(map(str, K.spread_join(big, other, ["k"], how).collect())) == want


def test_hundreds_of_hot_keys_and_a_hot_null(spark):
    rows = spark.range(30_000).withColumn("k", F.when(F.col("id") % 3 > 0, F.col("id") % 300))
    pages = K.collect_pages(rows, ["k"], F.col("id"), ["id"], 30, "ids").withColumn("n", F.size("ids")).cache()
    assert pages.agg(F.max("n")).first()[0] == 30
    assert pages.select("k", "page").distinct().count() == pages.count()
    assert pages.filter("page = 0").count() == 201
    assert pages.filter("k is null").agg(F.sum("n")).first()[0] == 10_000
    assert pages.select(F.explode("ids")).distinct().count() == 30_000


@pytest.mark.parametrize("limit", [10**6, 100])
def test_pages_keep_every_element(sides, limit):
    big, _ = sides
    pages = K.collect_pages(big, ["k"], F.col("id"), ["id"], limit, "ids").collect()
    want = {}
    for r in big.collect():
        want.setdefault(r["k"], []).append(r["id"])
    got = {}
    for r in pages:
        assert r["ids"] == sorted(r["ids"])
        got.setdefault(r["k"], []).extend(r["ids"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    hot = [r for r in pages if r["k"] == "c_hot"]
    assert len(hot) == (1 if limit > 10**5 else len({r["page"] for r in hot})) and (limit > 10**5 or len(hot) > 20)


def test_documents_of_large_orders_have_pages(spark):
    folder = "/root/testdata/sf0.001"
    whole, paged = nested_orders(spark, folder), nested_orders(spark, folder, items_per_document=4)
    assert paged.filter("page > 0").count() > 0 and whole.filter("page > 0").count() == 0

    def items(documents):
        rows = documents.select("order_id", F.explode("items").alias("i")).select("order_id", "i.*").collect()
        return sorted(map(tuple, rows))

    assert items(paged) == items(whole)
    assert paged.filter("page = 0").count() == whole.count()
    assert len(items(whole)) == load(spark, folder, "lineitem").join(
        load(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    ).count()


def test_salting_spreads_the_hot_key(sides):
    big, _ = sides
    salted = big.withColumn("s", K.salt_of(["id"], 8)).filter("k = 'c_hot'")
    shares = [r["count"] for r in salted.groupBy("s").count().collect()]
    assert len(shares) == 8 and max(shares) < 0.25 * sum(shares)


def test_salted_sum_keeps_keys_with_underscores(sides):
    big, _ = sides
    direct = {r["k"]: r["s"] for r in big.groupBy("k").agg(F.sum("id").alias("s")).collect()}
    salted = {r["k"]: r["t"] for r in K.salted_sum(big, "k", "id", ["id"], 5, "t").collect()}
    aware = {r["k"]: r["t"] for r in K.skew_aware_sum(big, "k", "id", ["id"], "t").collect()}
    assert salted == direct and aware == direct


def orders_with_a_hot_key(n):
    return [(k, 7 if k % 3 == 0 else None if k % 3 == 1 else k % 20, float(k * 37 % 101), k * 13 % 50) for k in range(n)]


@pytest.mark.parametrize("batch_rows", [7, 10_000])
def test_groups_come_as_streams(spark, batch_rows):
    """A third of all rows in one group, another third under null; no batch is larger than Arrow's limit."""
    rows = orders_with_a_hot_key(600)
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate int")
    expected = set()
    for key in {r[1] for r in rows}:
        price = [r[2] for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[3], r[0]))]
        expected.add((key, len(price), median(price), sum(b > a for a, b in zip(price, price[1:], strict=False))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    try:
        got = physical.rises_and_middle(orders).collect()
        sizes = custom.group_stream(
            orders, ["o_custkey"], ["o_orderkey"], lambda batches: [(max(b.num_rows for b in batches),)], "most int"
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(expected) and set(map(tuple, got)) == expected
    assert max(r["most"] for r in sizes) <= batch_rows


def test_streams_of_many_keys_and_unread_rows(spark):
    rows = [(k % 3, float("nan") if k % 4 == 0 else None if k % 4 == 1 else float(k % 4), k) for k in range(200)]
    df = spark.createDataFrame(rows, "a int, b double, v int")

    def first_two(batches):
        yield tuple(next(batches).column("v").to_pylist()[:2])  # the rest of the group is left unread

    got = custom.group_stream(df, ["a", "b"], ["v"], first_two, "x int, y int").collect()
    want = {}
    for a, b, v in rows:
        want.setdefault((a, str(b)), []).append(v)
    assert sorted(map(tuple, got)) == sorted(tuple(v[:2]) for v in want.values())
    assert custom.group_stream(df.limit(0), ["a"], ["v"], first_two, "x int, y int").collect() == []


def test_summaries_bound_the_counts():
    rng = np.random.default_rng(1)
    keys = np.minimum(rng.zipf(1.3, 20_000), 5000)
    for size in (10, 100, 10_000):
        summary = K.SpaceSaving(size)
        for part in np.array_split(keys, 50):
            summary.add(part)
        true = np.bincount(keys, minlength=5001)
        assert len(summary.keys) <= size and summary.floor <= len(keys) / size
        assert (summary.counts >= true[summary.keys]).all() and (summary.counts - summary.over <= true[summary.keys]).all()
        others = np.setdiff1d(np.arange(5001), summary.keys)
        assert true[others].max(initial=0) <= summary.floor


@pytest.mark.parametrize("counters", [4, 10_000])
def test_heavy_hitters_are_never_missed(spark, monkeypatch, counters):
    """Also when a summary has fewer counters than there are such keys, and the keys are counted."""
    monkeypatch.setattr(K, "COUNTERS", counters)
    monkeypatch.setattr(K.SpaceSaving.__init__, "__defaults__", (counters,))
    rows = spark.range(20_000).select(F.when(F.col("id") % 4 > 0, F.col("id") % 20).alias("k"), (F.col("id") % 2).alias("j"))
    true = {r["h"]: r["n"] for r in rows.groupBy(F.xxhash64("k", "j").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    hot, n = K.heavy_hitters(rows, ["k", "j"], 1000)
    found = {r[K.HASH]: (r["least"], r["most"]) for r in hot.collect()}
    assert n == 20_000
    assert {h for h, m in true.items() if m >= 1000} <= set(found)
    assert all(low <= true[h] <= high for h, (low, high) in found.items())


def test_salted_join_moves_no_rows_by_the_key_alone(spark, tmp_path):
    big, other = str(tmp_path / "big"), str(tmp_path / "other")
    spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k")).write.parquet(big)
    spark.range(2000).select(F.col("id").alias("k"), F.col("id").alias("w")).write.parquet(other)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = K.salted_join(spark.read.parquet(big), spark.read.parquet(other), ["k"], ["id"], rows_per_task=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moves) == 2 and all(K.SALT in line for line in moves)
    assert plan.count("BroadcastExchange") == 2


def test_stages_are_dropped(spark):
    drop_stages(spark)
    kept = stage(spark.range(5), "dropped")
    assert kept.count() == 5 and drop_stages(spark) == 1 and drop_stages(spark) == 0
    with pytest.raises(Exception, match="dropped"):
        spark.read.parquet(kept.inputFiles()[0])


def test_decision(spark, sides):
    big, _ = sides
    assert K.needs_salting(big, "k").first()["salt"] is True
    assert K.needs_salting(big, "id").first()["salt"] is False
    assert K.needs_salting(big.filter("id < 0"), "k").first()["salt"] is False
    counts = {r["k"]: r["count"] for r in big.groupBy("k").count().collect()}
    top = K.needs_salting(big, "k").first()
    assert (top["n_rows"], top["hot_key"], top["hot_rows"]) == (3000, "c_hot", counts["c_hot"])


def test_broadcast_only_when_estimated_small(spark):
    big, dim = spark.range(1000), spark.range(50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = big.join(K.broadcast_within(dim, 400), "id")
        large = big.join(K.broadcast_within(dim, 399), "id")
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
