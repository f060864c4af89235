"""File sources and sinks with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
# Characters kept exactly through a write and a read.
EXACT_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
QUOTED = {"quote": '"', "escape": '"', "multiLine": "true", **EXACT_TEXT}


def write(df: DataFrame, kind: str, path: str, **options: str) -> str:
    """Write a frame as csv, json, parquet, orc or text."""
    if kind == "csv":
        options = {"header": "true", **options}
    df.write.format(kind).options(**options).save(path)
    return path


def read(spark: SparkSession, kind: str, path: str, schema, **options: str) -> DataFrame:
    """Read files of one kind with a declared schema."""
    if kind == "csv":
        options = {"header": "true", **options}
    return spark.read.format(kind).schema(schema).options(**options).load(path)


def read_ragged_csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """CSV whose rows may be short or long: missing fields are null, the raw line is kept."""
    return read(
        spark, "csv", path, f"{schema}, {CORRUPT} string", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options
    )


def surplus_fields(line: str, n_columns: int, separator: str = ","):
    """Fields of a long row beyond the declared columns."""
    parts = F.split(line, f"\\Q{separator}\\E")
    return F.slice(parts, n_columns + 1, F.greatest(F.size(parts) - n_columns, F.lit(0)))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines as (good rows, bad lines); blank lines are neither."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(
        "value",
        F.from_json("value", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}).alias("r"),
    )
    good = parsed.filter(F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()).select("r.*").drop(CORRUPT)
    bad = parsed.filter(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()).select("value")
    return good, bad


def null_markers(df: DataFrame, markers: Mapping[str, list[str]] | list[str]) -> DataFrame:
    """Texts that stand for a missing value become null, per column or in all."""
    per_column = markers if isinstance(markers, Mapping) else {c: markers for c in df.columns}
    return df.withColumns({c: F.when(~F.col(c).isin(m), F.col(c)) for c, m in per_column.items()})


def discover(spark: SparkSession, root: str, pattern: str, schema, kind: str = "csv", **options: str) -> DataFrame:
    """All matching files below ``root`` at any depth, with the path each row came from."""
    options = {"header": "true", **options} if kind == "csv" else options
    reader = spark.read.format(kind).schema(schema).options(**options)
    found = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select("*", F.col("_metadata.file_path").alias("file_path"))


def under_prefix(df: DataFrame, root: str, prefix: str) -> DataFrame:
    """Rows of ``discover`` whose object key below ``root`` starts with ``prefix``."""
    key = F.substring_index("file_path", root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    return df.withColumn("key", key).filter(F.col("key").startswith(prefix))


def file_profile(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and lines per file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("n_bytes")
    )
    return lines.groupBy("file_path").agg(F.max("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_lines"))


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    """Status of each single-document JSON file in a ``file=NAME`` tree.

    A bad file (no JSON, no id, an amount that is no number or negative) fails alone.
    """
    files = spark.read.schema("value string, file string").text(path, wholetext=True)
    raw = F.from_json("value", "map<string,string>")
    parsed = files.withColumn("r", raw)
    identifier, amount = F.try_element_at("r", F.lit("id")), F.try_element_at("r", F.lit("amount"))
    number = amount.try_cast("double")
    reason = (
        F.when(F.col("r").isNull(), "not valid JSON")
        .when(identifier.isNull(), "id is missing")
        .when(number.isNull(), "amount is not a number")
        .when(number < 0, "amount is negative")
    )
    return parsed.select(
        "file",
        F.when(reason.isNull(), "loaded").otherwise("failed").alias("status"),
        reason.alias("reason"),
        F.when(reason.isNull(), number).alias("amount"),
    )


def multi_sink(df: DataFrame, kinds: list[str], root: str) -> dict[str, str]:
    """The same frame in several formats below one folder."""
    return {kind: write(df, kind, f"{root}/{kind}") for kind in kinds}


def with_shard(shards: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of several sources with the name of the source each came from."""
    out = None
    for name, df in shards.items():
        part = df.withColumn("shard", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
