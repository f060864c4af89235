"""Reports on how rows lie in partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as ``explain`` prints it."""
    return df._explain_string(mode=mode) if hasattr(df, "_explain_string") else df._jdf.queryExecution().toString()


def plan_facts(df: DataFrame) -> dict[str, int]:
    """What the physical plan will do, before it runs: shuffles, broadcasts, sorts, and steps in Python."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    count = lambda *names: sum(any(n in line for n in names) for line in lines)
    return {
        "shuffles": count("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin", "Exchange SinglePartition"),
        "broadcasts": count("BroadcastExchange"),
        "sorts": count("Sort ["),
        "python_steps": count("InPandas", "InArrow", "EvalPython"),
    }
