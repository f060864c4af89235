"""Nested documents: safe access, flattening, record normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage


def safe_get(document: Column, path: str, default: str | None = None) -> Column:
    """Text at a path such as ``a.b[0].c`` of a JSON text, or the default."""
    return F.coalesce(F.get_json_object(document, "$." + path), F.lit(default))


def flatten_columns(schema: T.StructType, prefix: str = "") -> list[Column]:
    """Columns that spread nested structs into dotted names; arrays stay as they are."""
    out: list[Column] = []
    for f in schema:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += flatten_columns(f.dataType, path + ".")
        else:
            out.append(F.col(path).alias(path))
    return out


def flatten(df: DataFrame) -> DataFrame:
    return df.select(*flatten_columns(df.schema))


def normalize(df: DataFrame, records: str, meta: Sequence[str], prefix: str) -> DataFrame:
    """One row per element of ``records`` with the parent's ``meta`` fields."""
    kind = df.schema[records].dataType.elementType
    exploded = df.select(*[F.col(m).alias(m) for m in meta], F.explode(records).alias("_r"))
    return exploded.select(*[F.col(f"`{m}`") for m in meta], *[F.col(f"_r.{n}").alias(prefix + n) for n in kind.names])


def _deeper(df: DataFrame, key: str) -> DataFrame:
    """The fields and elements of the objects and arrays in ``v``, one row each, under their paths."""
    inner = df.sparkSession.tvf.variant_explode(F.col("v").outer()).select(F.col("pos"), F.col("key").alias("name"), F.col("value").alias("inner"))
    spread = df.select(key, "path", "v").lateralJoin(inner)
    field = F.when(F.col("path") == "", F.col("name")).otherwise(F.concat("path", F.lit("."), "name"))
    element = F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))
    return spread.select(key, F.when(F.col("name").isNull(), element).otherwise(field).alias("path"), F.col("inner").alias("v"))


def json_paths(df: DataFrame, key: str, document: str) -> DataFrame:
    """(key, path, value) rows for JSON texts of unknown shape, e.g. ``items[0].sku``.

    Texts are parsed once to VARIANT, and one level is unnested at a time until no
    object or array is left. A null text gives no rows, a text that is no JSON stops the
    query, and a scalar text gives one row with an empty path. Texts stay as they are,
    other values are given as JSON. Empty objects and arrays give nothing.
    """
    level = df.filter(F.col(document).isNotNull()).select(key, F.lit("").alias("path"), F.parse_json(document).alias("v"))
    found = None
    while True:
        level = stage(level.withColumn("kind", F.schema_of_variant("v")), "json-level")
        nested = F.col("kind").startswith("OBJECT") | F.col("kind").startswith("ARRAY")
        text = F.when(F.col("kind") == "STRING", F.try_variant_get("v", "$", "string")).otherwise(F.to_json("v"))
        leaves = level.filter(~nested).select(key, "path", text.alias("value"))
        found = leaves if found is None else found.unionByName(leaves)
        inner = level.filter(nested)
        if inner.isEmpty():
            return found
        level = _deeper(inner, key)
