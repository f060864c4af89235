"""A compressed FM-index over integer symbols, searched backwards for many streams at once.

* The Burrows-Wheeler transform comes from a suffix order on the first ``ORDER``
  symbols, found by doubling; that is enough for patterns up to ``ORDER - 1``.
* It is kept in a wavelet tree of Huffman's shape, so a symbol takes about the
  entropy in bits, all levels in one bit vector with a count per 64 bits.
* Matching statistics: a stream is read from its end. The match is extended to
  the left by two rank queries; where that fails, it is cut at its right end to
  the parent interval by the common prefixes of neighbouring suffixes. Matches
  are cut to ``limit`` symbols, so memory and time don't depend on how long
  equal passages are.

All streams of a call go on in step, so each step is a few array operations.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Suffixes are sorted by this many symbols: six doublings.
ORDER = 64
_STEPS = (32, 16, 8, 4, 2, 1)


def huffman_lengths(counts: np.ndarray) -> np.ndarray:
    """Code length of each symbol; a lone symbol gets one bit."""
    if len(counts) == 1:
        return np.ones(1, np.int64)
    heap = [(n, k) for k, n in enumerate(counts.tolist())]
    heapq.heapify(heap)
    parent, number = [0] * (2 * len(counts) - 1), len(counts)
    while len(heap) > 1:
        a, i = heapq.heappop(heap)
        b, j = heap[0]
        heapq.heapreplace(heap, (a + b, number))
        parent[i] = parent[j] = number
        number += 1
    depth = [0] * number
    for k in range(number - 2, -1, -1):
        depth[k] = depth[parent[k]] + 1
    return np.array(depth[: len(counts)], np.int64)


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Prefix-free codes, written from the highest of 64 bits."""
    order = np.argsort(lengths, kind="stable")
    widths = np.uint64(1) << (np.uint64(63) - (lengths[order] - 1).astype(np.uint64))
    codes = np.empty(len(lengths), np.uint64)
    codes[order] = np.concatenate([[0], np.cumsum(widths[:-1], dtype=np.uint64)])
    return codes


class WaveletTree:
    """Rank of a symbol in any prefix of a sequence of symbols 0 .. size - 1, each of which occurs."""

    def __init__(self, sequence: np.ndarray, size: int) -> None:
        counts = np.bincount(sequence, minlength=size)
        self.lengths = huffman_lengths(counts)
        self.codes = canonical_codes(self.lengths)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        depth = int(self.lengths.max())
        self.starts = np.empty(int(self.lengths.sum()), np.int64)
        codes, lengths, bits, offset = self.codes[sequence], self.lengths.astype(np.int8)[sequence], [], 0
        for level in range(depth):
            self._node_starts(counts, level, offset)
            bit = (codes >> np.uint64(63 - level)).astype(np.uint8) & 1
            bits.append(bit)
            offset += len(bit)
            going = lengths > level + 1
            zeros, ones = going & (bit == 0), going & (bit == 1)
            codes = np.concatenate([codes[zeros], codes[ones]])
            lengths = np.concatenate([lengths[zeros], lengths[ones]])
        packed = np.packbits(np.concatenate(bits), bitorder="little")
        self.words = np.zeros(offset // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])
        self.ones_before = self._ones(self.starts)

    def _node_starts(self, counts: np.ndarray, level: int, offset: int) -> None:
        """Where each symbol's node begins in a level: nodes follow each other by their path read backwards."""
        live = np.flatnonzero(self.lengths > level)
        path = np.zeros(len(live), np.uint64)
        for k in range(level):
            path |= ((self.codes[live] >> np.uint64(63 - k)) & np.uint64(1)) << np.uint64(k)
        nodes, node = np.unique(path, return_inverse=True)
        sizes = np.bincount(node, weights=counts[live], minlength=len(nodes)).astype(np.int64)
        self.starts[self.first[live] + level] = offset + np.concatenate([[0], np.cumsum(sizes)[:-1]])[node]

    def _ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        out = ends.astype(np.int64)
        live, lengths, level = np.arange(len(out)), self.lengths[symbols], 0
        while len(live):
            s = symbols[live]
            cell = self.first[s] + level
            ones = self._ones(self.starts[cell] + out[live]) - self.ones_before[cell]
            bit = (self.codes[s] >> np.uint64(63 - level)) & np.uint64(1)
            out[live] = np.where(bit == 1, ones, out[live] - ones)
            level += 1
            live = live[lengths[live] > level]
        return out


def _suffix_ranks(text: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The order of the suffixes by ``ORDER`` symbols, and their ranks by 1, 2, 4 .. 32."""
    n = len(text)
    rank, ranks, h = text.astype(np.int64), {}, 1
    while True:
        ranks[h] = rank.astype(np.int32)
        after = np.zeros(n, np.int64)
        after[: max(n - h, 0)] = rank[h:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)
        if 2 * h == ORDER:
            return order, ranks
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        h *= 2


def _common_prefixes(order: np.ndarray, ranks: dict[int, np.ndarray]) -> np.ndarray:
    """Common symbols of each suffix with the one before it, up to ``ORDER - 1``; -1 at both ends."""
    n = len(order)
    i, j, common = order[1:].copy(), order[:-1].copy(), np.zeros(max(n - 1, 0), np.int8)
    for h in _STEPS:
        rank = ranks[h]
        inside = (i + h <= n) & (j + h <= n)
        equal = inside & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)])
        common += equal * np.int8(h)
        i += equal * h
        j += equal * h
    return np.concatenate([[-1], common, [-1]]).astype(np.int8)


def _next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value (its own place if none), by jumping along pointers."""
    n = len(values)
    to = np.minimum(np.arange(1, n + 1), n - 1)
    open_ = np.flatnonzero((values[to] >= values) & (to < n - 1))
    while len(open_):
        to[open_] = to[to[open_]]
        open_ = open_[(values[to[open_]] >= values[open_]) & (to[open_] < n - 1)]
    return to


class FmIndex:
    """Index of texts given as one array of symbols 1 .. size - 1, with symbol 0 after each text."""

    def __init__(self, text: np.ndarray, size: int, limit: int) -> None:
        if not 0 < limit < ORDER:
            raise ValueError(f"a match is cut to between 1 and {ORDER - 1} symbols")
        self.n, self.limit = len(text), limit
        order, ranks = _suffix_ranks(text)
        self.tree = WaveletTree(text[order - 1], size)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.common = _common_prefixes(order, ranks)
        self.down = _next_smaller(self.common)
        self.up = len(self.common) - 1 - _next_smaller(self.common[::-1])[::-1]
        # Suffixes with the same first ``limit`` symbols are neighbours: a class.
        edges = np.flatnonzero(self.common[:-1] < limit)
        self.class_start = np.append(edges, self.n)
        self.class_of = np.cumsum(self.common[:-1] < limit) - 1
        self.order = order

    def least_of_class(self, values: np.ndarray) -> np.ndarray:
        """The least value (one per place of the text) among the places of each class."""
        return np.minimum.reduceat(values[self.order], self.class_start[:-1])

    def _extend(self, lo: np.ndarray, hi: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self.tree.rank(np.concatenate([symbols, symbols]), np.concatenate([lo, hi]))
        base = self.smaller[symbols]
        return base + both[: len(lo)], base + both[len(lo) :]

    def _parent(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of the longest shorter prefix with more occurrences."""
        left, right = self.common[lo], self.common[hi]
        depth = np.maximum(left, right)
        new_lo = np.where(left == depth, np.where(depth >= 0, self.up[lo], lo), lo)
        new_hi = np.where(right == depth, np.where(depth >= 0, self.down[hi], hi), hi)
        return new_lo, new_hi, np.maximum(depth, 0).astype(np.int64)

    def matching_statistics(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the streams, the longest match that begins there (``limit`` at most), and its class.

        ``starts`` has the first place of each stream and the end of the last. Symbols
        that the index doesn't have are negative. The class is -1 for shorter matches.
        """
        length, of_class = np.zeros(len(symbols), np.int64), np.full(len(symbols), -1, np.int64)
        sizes = np.diff(starts)
        streams = np.argsort(-sizes, kind="stable")
        ends, sizes = starts[1:][streams], sizes[streams]
        lo, hi, q = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64), np.zeros(len(ends), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -step, side="left"))  # streams longer than ``step``
            at = ends[:live] - 1 - step
            todo = np.arange(live)
            known = symbols[at] >= 0
            gone = todo[~known]
            lo[gone], hi[gone], q[gone] = 0, self.n, 0
            todo = todo[known]
            while len(todo):
                a, b = self._extend(lo[todo], hi[todo], symbols[at[todo]])
                found = b > a
                done = todo[found]
                lo[done], hi[done] = a[found], b[found]
                q[done] += 1
                todo = todo[~found]
                lo[todo], hi[todo], q[todo] = self._parent(lo[todo], hi[todo])
            long = np.flatnonzero(q[:live] > self.limit)
            group = self.class_of[lo[long]]
            lo[long], hi[long], q[long] = self.class_start[group], self.class_start[group + 1], self.limit
            length[at] = q[:live]
            full = q[:live] == self.limit
            of_class[at[full]] = self.class_of[lo[:live][full]]
        return length, of_class
