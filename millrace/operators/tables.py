"""SQL with bound values, filters from dictionaries, changes of tables by predicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound_query(df: DataFrame, sql: str, **values) -> DataFrame:
    """Run ``sql`` over ``{table}`` with values bound, never pasted into the text."""
    return df.sparkSession.sql(sql, args=values, table=df)


def dynamic_filter(df: DataFrame, filters: Mapping[str, object], allowed: Sequence[str]) -> DataFrame:
    """Rows equal to all given values; a column outside the allow-list is an error."""
    refused = sorted(set(filters) - set(allowed))
    if refused:
        raise ValueError(f"cannot filter by {refused}")
    condition = F.lit(True)
    for column, value in filters.items():
        condition &= F.col(column) == F.lit(value)
    return df.filter(condition)


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; an unknown one keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
