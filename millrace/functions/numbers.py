"""Arithmetic with Python's rules, and casts that do not stop on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(a: Column, b: Column) -> Column:
    """Quotient rounded down; Spark's integer division rounds towards 0."""
    return F.floor(a / b)


def modulo(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor."""
    return (a % b + b) % b


def truncate(x: Column) -> Column:
    return x.cast("bigint")


def half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def to_number(text: Column, kind: str = "double", errors: str = "coerce") -> Column:
    """Text to a number: null for what is none, or an error with ``errors="raise"``."""
    return text.cast(kind) if errors == "raise" else text.try_cast(kind)


def or_default(x: Column, default, blank_is_missing: bool = False) -> Column:
    if blank_is_missing:
        x = F.when(x != "", x)
    return F.coalesce(x, F.lit(default))


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    return price * quantity * (1 - discount)


def narrow_add(a: Column, b: Column, kind: str) -> Column:
    """Sum in a narrow integer type; null where it would overflow, never a wrapped value."""
    return F.try_add(a.try_cast(kind), b.try_cast(kind))
