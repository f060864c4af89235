"""Dates from text, and ages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column, formats: Sequence[str] = ("yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def age_in_days(day: Column, load_date: str) -> Column:
    return F.datediff(F.lit(load_date).cast("date"), day)


def is_stale(day: Column, load_date: str, days: int = 2) -> Column:
    """Older than ``days`` at the load date; an unknown date is not called stale."""
    return F.coalesce(age_in_days(day, load_date) > days, F.lit(False))
