"""Best-fit packing of documents into sequences of bounded length.

Documents are encoded and cut into pieces; only their lengths and checksums are
kept. The pieces are dealt by a hash over partitions of about a million and
packed there one by one, in the order of the hash, with a fixed number of open
bins. The bins are found by a bitset with one bit for each free space: the
lowest set bit at or above a piece's length is the best fit. A piece that fits
nowhere opens a bin, and if that is one too many the fullest closes. Memory
doesn't depend on the number of pieces, and each partition wastes only what its
own last bins leave free. Pieces as long as a sequence fill one by themselves.

Defined results: a null or empty text is one piece of the end id alone. Rows
with equal ids, nulls too, are packed each for itself. An empty table gives no
rows. Equal lengths and free spaces are settled by the order of the hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, stage
from millrace.llm.words import pieces_for

CAPACITY = 4096
OPEN_BINS = 2048
PIECES_PER_TASK = 1_000_000
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document, with their ids if asked for."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            encoded = pieces_for(path).ids(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids += end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    for column, value in zip(
                        out, (doc, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part), part), strict=True
                    ):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out[:n], types[:n], strict=True)], names=names[:n])

    return map_batches(docs.select("doc_id", "text"), run, PIECE + ", ids binary" * with_ids)


class Bins:
    """A bounded number of open bins, by free space."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN_BINS) -> None:
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.made = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(capacity)]

    def _take(self, free: int) -> int:
        bins = self.at[free]
        got = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return got

    def _put(self, which: int, free: int) -> None:
        if not free:
            return
        self.at[free].append(which)
        self.bits |= 1 << free
        self.open += 1

    def add(self, length: int) -> tuple[int, int]:
        """The bin and the place in it for a piece of this length."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            which = self._take(free)
        else:
            free, which = self.capacity, self.made
            self.made += 1
            if length < self.capacity and self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        self._put(which, free - length)
        return which, self.capacity - free


def pack(found: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """``found``, rows of ``pieces`` that are stored, with sequence_id and offset."""
    tasks = max(1, -(-found.count() // PIECES_PER_TASK))
    key = F.xxhash64("doc_id", "piece", "ids_crc32", "length")
    order = F.xxhash64(key, F.lit(7))  # not the order of the dealing hash
    dealt = found.repartition(tasks, key).sortWithinPartitions(order, "doc_id", "piece", "start", "ids_crc32")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        bins = Bins(capacity, open_bins)
        for batch in batches:
            placed = [bins.add(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema.fields)
    return map_batches(dealt, run, f"{columns}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece with its place."""
    return pack(stage(pieces(docs, path, end_id, capacity), "pieces"), capacity, open_bins)


def sequences(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids, at most ``capacity`` of them."""
    packed = pack(stage(pieces(docs, path, end_id, capacity, with_ids=True), "pieces"), capacity)
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            joined = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32) for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(joined, pa.list_(pa.int32()))], names=["sequence_id", "ids"]
            )

    return map_batches(parts, run, "sequence_id bigint, ids array<int>")
