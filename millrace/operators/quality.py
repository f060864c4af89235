"""Rule tables over batches, quarantine, batch stops and schema changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.skew import same_keys
from millrace.session import stage


class BatchRefused(Exception):
    """A batch is so broken that nothing of it may be loaded."""


@dataclass(frozen=True)
class Expect:
    """One line of a rule table; exactly one of the last four fields is given.

    ``holds``: a condition on the row, in which null counts as false.
    ``single``: columns whose values, null among them, occur in one row only.
    ``listed``: a column and the table and column in which its value must occur.
    ``size``: least and most rows of the batch; outside of them every row fails.
    """

    name: str
    level: str
    holds: Column | None = None
    single: tuple[str, ...] = ()
    listed: tuple[str, DataFrame, str] | None = None
    size: tuple[int, int] | None = None


def _with_help(rows: DataFrame, expect: Expect, i: int, batch: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` with what the rule needs from outside the row, and the rule as a condition.

    ``batch`` has the same rows before any help, for keys and counts: from ``rows`` they would repeat the joins of earlier rules.
    """
    mark = f"_help_{i}"
    if expect.single:
        keys = batch.groupBy(*[F.col(k).alias(f"{mark}_{k}") for k in expect.single]).agg(F.count(F.lit(1)).alias(mark))
        return same_keys(rows, keys.filter(F.col(mark) > 1), expect.single, f"{mark}_"), F.col(mark).isNull()
    if expect.listed:
        column, table, name = expect.listed
        values = table.select(F.col(name).alias(mark)).filter(F.col(mark).isNotNull()).distinct()
        return rows.join(values, rows[column] == values[mark], "left"), F.col(mark).isNotNull()
    if expect.size:
        return rows, batch.select(F.count(F.lit(1))).scalar().between(*expect.size)
    return rows, F.coalesce(expect.holds, F.lit(False))


@dataclass(frozen=True)
class Audit:
    """A batch held against a rule table: its rows with the names of the rules they break, or counts alone."""

    batch: DataFrame
    table: tuple[Expect, ...]

    @cached_property
    def rows(self) -> DataFrame:
        """The batch with ``broken_rules``, in the order of the table; it is stored once, and all rules read the stored rows."""
        rows = batch = stage(self.batch, "audit")
        none = F.array().cast("array<string>")
        broken = [none]
        for i, expect in enumerate(self.table):
            rows, condition = _with_help(rows, expect, i, batch)
            broken.append(F.when(~condition, F.array(F.lit(expect.name))).otherwise(none))
        # constant arrays put together are compiled code; a filter over an array is not
        return rows.select(*self.batch.columns, F.concat(*broken).alias("broken_rules"))

    def accepted(self) -> DataFrame:
        return self.rows.filter(F.size("broken_rules") == 0).select(*self.batch.columns)

    def refused(self) -> DataFrame:
        return self.rows.filter(F.size("broken_rules") > 0)

    def split(self) -> tuple[DataFrame, DataFrame]:
        """Accepted and refused rows for a caller that reads both: every row is judged once, and the judgement stored."""
        judged = stage(self.rows, "judged")
        return judged.filter(F.size("broken_rules") == 0).select(*self.batch.columns), judged.filter(F.size("broken_rules") > 0)

    def _broken(self, expect: Expect) -> Column:
        """How many rows break a rule, as an aggregate of the batch or a number from its keys alone."""
        if expect.single:
            copies = self.batch.groupBy(*expect.single).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
            return copies.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
        if expect.listed:
            column, table, name = expect.listed
            values = self.batch.groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
            unknown = values.join(table.select(F.col(name).alias("_v")), "_v", "left_anti")
            return unknown.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
        if expect.size:
            return F.when(F.count(F.lit(1)).between(*expect.size), F.lit(0)).otherwise(F.count(F.lit(1)))
        return F.count_if(~F.coalesce(expect.holds, F.lit(False)))

    def summary(self) -> DataFrame:
        """One row per rule: rows in all, rows that break it, and whether none does.

        No row is stored or joined: rules on the row are counted in one pass, rules on
        keys from the counts per key.
        """
        counted = self.batch.agg(F.count(F.lit(1)).alias("n_rows"), *[self._broken(e).cast("bigint").alias(f"n_{i}") for i, e in enumerate(self.table)])
        lines = [
            F.struct(F.lit(i).alias("line"), F.lit(e.name).alias("rule"), F.lit(e.level).alias("level"), F.col(f"n_{i}").alias("n_broken"))
            for i, e in enumerate(self.table)
        ]
        listed = counted.select("n_rows", F.explode(F.array(*lines)).alias("l")).select("l.*", "n_rows")
        return listed.withColumn("met", F.col("n_broken") == 0)


def audit(batch: DataFrame, table: Sequence[Expect]) -> Audit:
    """Try every rule on every row, when rows or counts are asked for."""
    return Audit(batch, tuple(table))


def refuse_unusable(batch: DataFrame, needed: Sequence[str], filled: Mapping[str, float]) -> DataFrame:
    """``batch`` itself, unless a needed column is absent or one is filled no more than its share.

    An empty batch is usable.
    """
    absent = [c for c in needed if c not in batch.columns]
    if absent:
        raise BatchRefused("absent: " + ", ".join(absent))
    shares = batch.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in filled]).first().asDict() if filled else {}
    thin = [f"{c} ({share:.0%} filled)" for c, share in shares.items() if share is not None and share <= filled[c]]
    if thin:
        raise BatchRefused("too empty: " + ", ".join(thin))
    return batch


def leaf_types(kind: T.StructType, above: str = "") -> dict[str, T.DataType]:
    """Type of every field, those inside structs by their dotted path."""
    out: dict[str, T.DataType] = {}
    for f in kind:
        path = f"{above}{f.name}"
        out |= leaf_types(f.dataType, f"{path}.") if isinstance(f.dataType, T.StructType) else {path: f.dataType}
    return out


def schema_changes(expected: T.StructType, batch: DataFrame) -> DataFrame:
    """One row per field that differs: field, change, both types, and whether every value still fits.

    ``change`` is added, absent or retyped; only a retyped field has ``fits``.
    All values are tried in one pass over the batch.
    """
    want, have = leaf_types(expected), leaf_types(batch.schema)
    lost = {
        path: F.count_if(F.col(path).isNotNull() & F.col(path).try_cast(kind).isNull())
        for path, kind in want.items()
        if path in have and have[path] != kind
    }
    kinds = [(p, "added", None, have[p], None) for p in have if p not in want]
    kinds += [(p, "absent", want[p], None, None) for p in want if p not in have]
    kinds += [(p, "retyped", want[p], have[p], n == 0) for p, n in lost.items()]
    text = lambda t: F.lit(t.simpleString() if t else None).cast("string")
    rows = [
        F.struct(
            F.lit(path).alias("field"),
            F.lit(change).alias("change"),
            text(a).alias("expected"),
            text(b).alias("found"),
            (F.lit(None).cast("boolean") if fits is None else fits).alias("fits"),
        )
        for path, change, a, b, fits in kinds
    ]
    empty = "array<struct<field:string,change:string,expected:string,found:string,fits:boolean>>"
    return batch.agg((F.array(*rows) if rows else F.array().cast(empty)).alias("r")).select(F.inline("r"))


def refuse_lost_fields(changes: DataFrame) -> None:
    """Added fields may come; a field that is absent or no longer fits stops the load."""
    lost = sorted(r["field"] for r in changes.filter("change = 'absent' or not fits").select("field").collect())
    if lost:
        raise BatchRefused("absent or no longer fitting: " + ", ".join(lost))


def misfits(df: DataFrame, types: Mapping[str, str]) -> Column:
    """Names of the columns whose value does not fit the declared type."""
    bad = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()]
    return F.array_compact(F.array(*bad))


@dataclass(frozen=True)
class Field:
    """One field of a record: type, whether it is required, default and lower bound."""

    name: str
    kind: str
    required: bool = True
    default: object = None
    minimum: float | None = None


def _typed(text: Column, kind: str) -> Column:
    if kind in ("int", "bigint"):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), F.floor(number).cast(kind))
        return F.coalesce(text.try_cast(kind), whole)
    return text.try_cast(kind)


def validate_records(df: DataFrame, document: str, fields: Sequence[Field], unknown: str = "ignore") -> DataFrame:
    """Parse JSON texts into typed fields and list all errors of each record.

    Values are coerced where that loses nothing, missing optional fields get their
    default. ``unknown="forbid"`` makes any field outside the list an error.
    """
    raw = F.from_json(F.col(document), "map<string,string>")
    # the parsed record comes out of a generator: the planner would else put the parsing itself into each use of it
    df = df.withColumn("_raw", F.explode(F.array(raw)))
    values, errors = [], []

    def problem(name: str | Column, reason: str) -> Column:
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("field"), F.lit(reason).alias("reason"))

    broken = F.col("_raw").isNull()
    errors.append(F.when(broken, problem("", "not a JSON object")))
    for f in fields:
        text = F.try_element_at("_raw", F.lit(f.name))
        value = _typed(text, f.kind)
        absent = text.isNull()
        if f.default is not None:
            values.append(F.when(absent, F.lit(f.default).cast(f.kind)).otherwise(value).alias(f.name))
        else:
            values.append(value.alias(f.name))
        if f.required:
            errors.append(F.when(~broken & absent, problem(f.name, "field required")))
        errors.append(F.when(~absent & value.isNull(), problem(f.name, f"not a valid {f.kind}")))
        if f.minimum is not None:
            errors.append(F.when(value < f.minimum, problem(f.name, f"must be at least {f.minimum}")))
    found = F.array_compact(F.array(*errors))
    if unknown == "forbid":
        extra = unknown_fields(F.map_keys("_raw"), [f.name for f in fields])
        found = F.concat(found, F.coalesce(F.transform(extra, lambda k: problem(k, "unknown field")), F.array().cast(
            "array<struct<field:string,reason:string>>")))
    return df.select(*[c for c in df.columns if c != "_raw"], *values, found.alias("errors"))


def unknown_fields(names: Column, expected: Sequence[str]) -> Column:
    """Field names of a record that are not expected, sorted."""
    return F.array_sort(F.array_except(names, F.array(*[F.lit(n) for n in expected])))


def freshness_volume(df: DataFrame, day: str, load_date: str, max_age: int, low: int, high: int) -> DataFrame:
    """One row: rows, newest day, stale rows, and whether the batch is in the volume band."""
    age = F.datediff(F.lit(load_date).cast("date"), F.col(day))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(day).alias("newest"),
        F.count_if(F.coalesce(age > max_age, F.lit(False))).alias("n_stale"),
    ).withColumn("volume_ok", F.col("n_rows").between(low, high))
