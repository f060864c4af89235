"""Missing values, messy feeds and type narrowing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.aggregate import unpivot_row
from millrace.operators.ordered import exact_quantiles
from millrace.operators.sets import dedup
from millrace.session import stage


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing here, so it becomes null before anything compares with it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def null_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Missing values per column, overall or per segment, in one pass."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
    return counts.select(*by, "n_rows", F.explode(parts).alias("_p")).select(
        *by, "_p.column", "_p.n_null", "n_rows", (F.col("_p.n_null") / F.col("n_rows")).alias("null_share")
    )


def null_marks(columns: Sequence[str]) -> Column:
    """One character per column: X where missing, . where present."""
    return F.concat(*[F.when(F.col(c).isNull(), "X").otherwise(".") for c in columns])


def exact_median(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return exact_quantiles(df, [key], value, {out: 0.5})


def fill_values(df: DataFrame, rules: Mapping[str, object]) -> dict[str, Column]:
    """Fill value per column: a constant, or "mean", "median" or "mode" of the column.

    The computed ones are subqueries of the plan that uses them; nothing is fetched to the driver.
    """

    def value(c: str, rule: object) -> Column:
        if rule == "mean":
            return df.select(F.avg(c)).scalar()
        if rule == "median":
            return exact_quantiles(df, [], c, {"m": 0.5}).select("m").scalar()
        if rule == "mode":
            counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
            best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v")))
            return counts.agg(best.alias("b")).select("b.v").scalar()
        return F.lit(rule)

    return {c: value(c, rule) for c, rule in rules.items()}


def fill_nulls(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Missing values of each column filled by its rule, or left where the rule has no value."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill_values(df, rules).items()})


def split_complete(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, and the others."""
    complete = F.lit(True)
    for c in required:
        complete &= F.col(c).isNotNull()
    return df.filter(complete), df.filter(~complete)


def clean_order_feed(
    df: DataFrame, key: str, order: Sequence[str], required: Sequence[str], amount: str
) -> DataFrame:
    """Last copy per key, without rows lacking required columns, missing amounts set
    to the median. Running it on its own result changes nothing."""
    # staged, because the median takes further passes over it
    kept = stage(dedup(df, [key], order, keep="last").na.drop(subset=list(required)), "feed")
    return fill_nulls(kept, {amount: "median"})


def repair_ingest(df: DataFrame, price: str, quantity: str) -> DataFrame:
    """Drop rows whose price is no number; a missing quantity counts as 0."""
    return (
        df.withColumn(price, F.col(price).try_cast("double"))
        .na.drop(subset=[price])
        .withColumn(quantity, F.coalesce(F.col(quantity), F.lit(0)))
    )


# Integer types from small to large with their bytes; fixed values of Spark's types.
INTEGERS = (("tinyint", 1), ("smallint", 2), ("int", 4), ("bigint", 8))
WIDTH = {**dict(INTEGERS), "float": 4, "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def narrowing_report(df: DataFrame, category_share: float = 0.5) -> DataFrame:
    """Per column the smallest type that holds every value exactly, and bytes before and after.

    Times that all lie at midnight are dates. Text columns are marked low-cardinality when distinct/rows is below ``category_share``.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    ints = [c for c, k in kinds.items() if k in dict(INTEGERS)]
    floats = [c for c, k in kinds.items() if k == "double"]
    texts = [c for c, k in kinds.items() if k == "string"]
    times = [c for c, k in kinds.items() if k in ("timestamp", "timestamp_ntz")]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in ints:
        aggs += [F.min(c).alias(f"{c}.lo"), F.max(c).alias(f"{c}.hi")]
    for c in floats:
        aggs.append(F.count_if(F.col(c).cast("float").cast("double") != F.col(c)).alias(f"{c}.inexact"))
    for c in times:
        aggs.append(F.count_if(F.date_trunc("day", c) != F.col(c)).alias(f"{c}.timed"))
    for c in texts:
        aggs.append(F.count_distinct(c).alias(f"{c}.distinct"))
    row = df.agg(*aggs)
    none = F.lit(None).cast("double")
    out = {}
    for c in ints:
        lo, hi = F.col(f"`{c}.lo`"), F.col(f"`{c}.hi`")
        best = F.lit(kinds[c])
        for name, size in reversed(INTEGERS[: [n for n, _ in INTEGERS].index(kinds[c])]):
            bound = 1 << (8 * size - 1)
            best = F.when((lo >= -bound) & (hi < bound), F.lit(name)).otherwise(best)
        out[c] = (best, none)
    for c in floats:
        out[c] = (F.when(F.col(f"`{c}.inexact`") == 0, "float").otherwise("double"), none)
    for c in times:
        out[c] = (F.when(F.col(f"`{c}.timed`") == 0, "date").otherwise(kinds[c]), none)
    for c in texts:
        share = F.try_divide(F.col(f"`{c}.distinct`"), F.col("_rows"))
        out[c] = (F.when(share < category_share, "category").otherwise("string"), share)
    fixed = {f"{c}.to": to for c, (to, _) in out.items()} | {f"{c}.share": share for c, (_, share) in out.items()}
    report = unpivot_row(
        row.select("_rows", *[v.alias(k) for k, v in fixed.items()]),
        {c: {"to_type": f"{c}.to", "distinct_share": f"{c}.share", "n_rows": "_rows"} for c in out},
    )
    widths = F.create_map(*[F.lit(x) for item in WIDTH.items() for x in item])
    before = F.create_map(*[F.lit(x) for c in out for x in (c, kinds[c])])
    return report.withColumn("from_type", F.try_element_at(before, "column")).select(
        "column",
        "from_type",
        "to_type",
        "distinct_share",
        (F.try_element_at(widths, "from_type") * F.col("n_rows")).alias("bytes_before"),
        (F.try_element_at(widths, "to_type") * F.col("n_rows")).alias("bytes_after"),
    )


def narrow(df: DataFrame) -> DataFrame:
    """Cast each numeric column to the type the report names."""
    rows = narrowing_report(df).filter("bytes_after < bytes_before").collect()  # one row per column
    return df.withColumns({r["column"]: F.col(r["column"]).cast(r["to_type"]) for r in rows})
