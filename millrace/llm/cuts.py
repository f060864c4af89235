"""Cuts of texts where byte-level and SentencePiece tokenizers both always cut, found on whole columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Characters beside which a cut is made: no white space, nor such as share their first UTF-8 byte with any that is.
SAFE = "[!-~\u00c0-\u0fff\u4000-\U0010ffff]"


def cut_units(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The units of texts, one after the other, and the place after each text's last.

    A unit begins at each text's start and at every single space between two safe
    characters; this is found on the bytes of all texts at once. An empty text has none.
    """
    column = pa.array(texts, pa.large_string())
    stops = np.frombuffer(column.buffers()[1], np.int64)[: len(texts) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[: stops[-1]]
    wide = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)])  # three bytes before, one after
    first_of_unsafe = np.isin(np.arange(256), (0xC2, 0xE1, 0xE2, 0xE3))
    plain = (np.arange(256) > 0x20) & (np.arange(256) != 0x7F)
    at = np.flatnonzero(data == 0x20)
    before = plain[wide[at + 2]] & ~((wide[at + 2] >= 0x80) & (first_of_unsafe[wide[at + 1]] | first_of_unsafe[wide[at]]))
    after = plain[wide[at + 4]] & ~first_of_unsafe[wide[at + 4]]
    starts = np.sort(np.concatenate([at[before & after], stops[:-1][np.diff(stops) > 0]]), kind="stable")
    starts = starts[np.diff(starts, prepend=-1) > 0]
    offsets = np.append(starts, stops[-1]).astype(np.int64)
    units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), column.buffers()[2] or pa.py_buffer(b""))
    return units, np.searchsorted(starts, stops[1:])
