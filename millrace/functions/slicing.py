"""Slices with Python's rules (negative positions, steps, no error out of range)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bound(value: int | None, size: Column, default: Column, low: int, high_shift: int) -> Column:
    """A slice end as a position from 0, clipped to what exists."""
    if value is None:
        return default
    place = size + value if value < 0 else F.lit(value)
    return F.greatest(F.lit(low), F.least(place, size - high_shift))


def array_slice(array: Column, start: int | None = None, stop: int | None = None, step: int = 1) -> Column:
    """``array[start:stop:step]``."""
    if step == 0:
        raise ValueError("slice step cannot be zero")
    size = F.size(array)
    if step == 1:
        lo = _bound(start, size, F.lit(0), 0, 0)
        hi = _bound(stop, size, size, 0, 0)
        return F.slice(array, lo + 1, F.greatest(hi - lo, F.lit(0)))
    if step > 0:
        lo = _bound(start, size, F.lit(0), 0, 0)
        hi = _bound(stop, size, size, 0, 0)
        return F.filter(array, lambda _, i: (i >= lo) & (i < hi) & ((i - lo) % step == 0))
    lo = _bound(start, size, size - 1, -1, 1)
    hi = _bound(stop, size, F.lit(-1), -1, 1)
    return F.reverse(F.filter(array, lambda _, i: (i <= lo) & (i > hi) & ((lo - i) % -step == 0)))


def char_slice(text: Column, start: int | None = None, stop: int | None = None, step: int = 1) -> Column:
    """``text[start:stop:step]`` by characters."""
    if step == 1:
        size = F.length(text)
        lo = _bound(start, size, F.lit(0), 0, 0)
        hi = _bound(stop, size, size, 0, 0)
        return F.substring(text, lo + 1, F.greatest(hi - lo, F.lit(0)))
    characters = F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return F.array_join(array_slice(characters, start, stop, step), "")
