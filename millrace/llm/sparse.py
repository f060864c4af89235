"""Sparse 0/1 and count matrices in compressed rows, with Gustavson's product, on numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """Row ``r`` holds the columns ``cols[starts[r]:starts[r + 1]]`` with the values of the same places."""

    starts: np.ndarray
    cols: np.ndarray
    values: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.sizes())

    def transpose(self, n_cols: int) -> Csr:
        """Counting sort by column keeps the rows of a column in order."""
        at = np.argsort(self.cols, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.cols, minlength=n_cols))])
        return Csr(starts, self.row_numbers()[at], self.values[at])


def from_sizes(sizes: np.ndarray) -> Csr:
    """Row ``r`` owns the next ``sizes[r]`` columns: the incidence of consecutive spans."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], np.int64))


def product(a: Csr, b: Csr, n_cols: int) -> Csr:
    """Row by row: the rows of ``b`` that a row of ``a`` names are scaled and added up.

    All rows are worked on together: each entry of ``a`` is replaced by its row of
    ``b``, then entries of the same row and column are merged. Columns ascend in
    each row.
    """
    width = b.sizes()[a.cols]
    total = np.concatenate([[0], np.cumsum(width)])
    at = np.arange(total[-1]) + np.repeat(b.starts[a.cols] - total[:-1], width)
    keys = np.repeat(a.row_numbers(), width) * n_cols + b.cols[at]
    if (a.values == 1).all() and (b.values == 1).all():
        # counts only: the keys alone are sorted, and a run's length is its value
        if len(keys) and np.any(keys[1:] < keys[:-1]):
            keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return _from_keys(keys[first], np.diff(np.append(first, len(keys))), a.rows, n_cols)
    values = np.repeat(a.values, width) * b.values[at]
    if len(keys) and np.any(keys[1:] < keys[:-1]):
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return _from_keys(keys[first], np.add.reduceat(values, first) if len(first) else np.zeros(0, np.int64), a.rows, n_cols)


def _from_keys(keys: np.ndarray, values: np.ndarray, n_rows: int, n_cols: int) -> Csr:
    """Compressed rows from ascending keys ``row * n_cols + col``."""
    rows, cols = np.divmod(keys, max(n_cols, 1))
    return Csr(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))]), cols, values)
