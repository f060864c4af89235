"""Plans: what reaches the scan, which joins are used, what is kept off Python."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregate import first_look
from millrace.operators.joins import merge_join, store_sorted
from millrace.operators.partitions import plan_facts, plan_text
from millrace.plans import queries
from millrace.plans.joins import join_broadcast, join_sortmerge
from millrace.session import fresh_path, shared
from millrace.tables import load

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    df = queries()["label_range"](spark, FOLDER)
    text = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThanOrEqual(o_orderkey,100), LessThanOrEqual(o_orderkey,900)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_filters_merge_and_move_below_the_projection(spark):
    df = load(spark, FOLDER, "lineitem").withColumn("x", F.col("l_quantity") * 2).filter("l_quantity > 5").filter("l_tax < 0.05")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Filter") == 1 and text.index("Project") < text.index("Filter")


def test_partition_pruning(spark):
    path = fresh_path(spark, "pruned")
    load(spark, FOLDER, "orders").write.partitionBy("o_orderstatus").parquet(path)
    text = plan(spark.read.parquet(path).filter("o_orderstatus = 'O'"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_join_strategies(spark):
    assert "BroadcastHashJoin" in plan(join_broadcast(spark, FOLDER))
    text = plan(join_sortmerge(spark, FOLDER))
    assert "SortMergeJoin" in text
    assert text.index("SortMergeJoin") < text.index("HashAggregate(keys=[l_orderkey")


def test_two_stage_aggregation_and_top_k(spark):
    assert plan(queries()["group_sum"](spark, FOLDER)).count("HashAggregate") == 2
    assert "TakeOrderedAndProject" in plan(queries()["top_k"](spark, FOLDER))
    assert "WindowGroupLimit" in plan(queries()["top_k_per_group"](spark, FOLDER))


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_joins_and_no_row_functions(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    if name != "cross_product":  # a product of two tables is its feature
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "UserDefinedTableFunction" not in text


def test_stored_sides_join_without_moving_or_sorting(spark):
    left, right = spark.range(3000).selectExpr("id", "id % 7 as v"), spark.range(0, 9000, 3).selectExpr("id", "id * 2 as w")
    sides = [store_sorted(x, ["id"], 5) for x in (left, right)]
    joined = merge_join(*sides, ["id"])
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text and "Sort [" not in text
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "id").collect()))
    assert len(sides[0].inputFiles()) == 5
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("sorted_")]
    assert "Exchange" not in plan(merge_join(*sides, ["id"], "outer"))


def test_first_look_scans_thrice_whatever_the_columns(spark):
    found = first_look(load(spark, FOLDER, "lineitem"), ["l_orderkey", "l_linenumber"])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") == 3 and text.count("Limit") == 4  # a local and a global limit at each end
    rows = {r["column"]: r for r in found.collect()}
    assert len(rows) == 11 and all(len(r["head"]) == len(r["tail"]) == 3 for r in rows.values())


def test_json_is_walked_without_python(spark):
    text = plan(queries()["json_paths"](spark, FOLDER))
    assert "InPandas" not in text and "InArrow" not in text and "Python" not in text


def test_a_shared_frame_is_scanned_once(spark):
    path = fresh_path(spark, "shared")
    spark.range(100).selectExpr("id", "id % 3 as k").write.parquet(path)
    with shared(spark.read.parquet(path).filter("id > 10")) as once:
        one, two = once.groupBy("k").count(), once.agg(F.sum("id"))
        both = [plan(x) for x in (one, two)]
        assert all("InMemoryTableScan" in x for x in both)
        assert one.count() == 3 and two.first()[0] == sum(range(11, 100))
        assert once.storageLevel.useDisk
    assert not once.storageLevel.useMemory
    assert "InMemoryTableScan" not in plan(once.groupBy("k").agg(F.max("id")))


def test_plan_facts(spark):
    df = spark.range(100).selectExpr("id", "id % 3 as k")
    assert plan_facts(df) == {"shuffles": 0, "broadcasts": 0, "sorts": 0, "python_steps": 0}
    ranked = df.repartitionByRange(4, "id").sortWithinPartitions("id").mapInArrow(lambda b: b, df.schema)
    assert plan_facts(ranked) == {"shuffles": 1, "broadcasts": 0, "sorts": 1, "python_steps": 1}
    assert plan_facts(df.join(F.broadcast(df.groupBy("k").count()), "k"))["broadcasts"] == 1
    assert "BroadcastHashJoin" in plan(queries()["skew_broadcast_join"](spark, FOLDER))


def test_plan_text(spark):
    assert "Range" in plan_text(spark.range(3))


def test_words_move_as_texts(spark):
    """The one shuffle of the word counts lies below the step that makes a row per word."""
    plan = queries()["udtf_tokens"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")


def test_composed_texts_are_not_all_objects_at_once(spark):
    import pyarrow as pa

    from millrace.plans.physical import _composed

    want = ["\u00e9a", None, "", "a\u00e9"] * 60
    assert _composed(pa.array(["e\u0301a", None, "", "ae\u0301"] * 60)).to_pylist() == want
    assert _composed(pa.array([], pa.string())).to_pylist() == []
