"""Token ids stored as binary blocks under a pair-replacement grammar.

Documents are put in ascending order of doc_id by a range partition, encoded,
and written in blocks of about a million ids of whole documents. In a block,
frequent pairs of neighbouring symbols are replaced by new symbols, round after
round; the rules, the number of ids each symbol stands for and the replaced
sequence are stored, so any range of ids can be decoded without the rest. No
rule crosses the end of a document. A round takes the most frequent pairs
together; where two of them overlap, the left one wins.

A file is parquet with one row per block (shard, block, n_docs, n_ids, payload).
The payload is little-endian: the mark ``PRG1``, then five unsigned 32-bit counts
(documents, base symbols, rules, sequence length, bytes per sequence symbol), then
doc_id as int64 (the flag of a null id apart, one byte each), ids per document as
uint32, left and right symbol of each rule as uint32, ids each rule stands for as
uint32, and the sequence as uint16 or uint32.

Defined results: a null or empty text is the end id alone. Null doc_ids come
first, repeated ids stand next to each other, each row with its own ids. An
empty table makes no blocks and reads back as no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.llm.words import pieces_for

MARK = b"PRG1"
BLOCK_IDS = 1_000_000
SHARD_BYTES = 24 << 20
ROUNDS = 5
PAIRS_PER_ROUND = 400
LEAST_COUNT = 64
BLOCKS = "shard int, block int, n_docs bigint, n_ids bigint, payload binary"


# --- the grammar of one block ---------------------------------------------------------------


def _frequent(seq: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """The most frequent pairs (left << 32 | right), counted exactly among those whose hash is frequent."""
    left, right = seq[:-1], seq[1:]
    slot = ((left * np.uint32(0x9E3779B1)) ^ (right * np.uint32(0x85EBCA6B))) >> np.uint32(12)
    slot[~inner] = 0
    heavy = np.bincount(slot, minlength=1 << 20) >= LEAST_COUNT
    at = np.flatnonzero(heavy[slot] & inner)
    pairs, counts = np.unique(left[at].astype(np.uint64) << np.uint64(32) | right[at], return_counts=True)
    enough = counts >= LEAST_COUNT
    pairs, counts = pairs[enough], counts[enough]
    best = np.lexsort((pairs, -counts))[:PAIRS_PER_ROUND]
    return np.sort(pairs[best])


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left and right of the rules, ids each stands for, and the sequence.

    ``ends`` holds the place after the last id of each document.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends - 1] = True
    lefts, rights, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
    for _ in range(ROUNDS):
        if len(seq) < 2:
            break
        inner = ~last[:-1]
        chosen = _frequent(seq, inner)
        if not len(chosen):
            break
        # Only pairs whose symbols begin and end chosen pairs need the search.
        begins, finishes = np.zeros((2, base + sum(map(len, lefts))), bool)
        begins[(chosen >> np.uint64(32)).astype(np.int64)] = True
        finishes[(chosen & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(begins[seq[:-1]] & finishes[seq[1:]] & inner)
        keys = seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1]
        rule = np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)
        hit = chosen[rule] == keys
        at, rule = at[hit], rule[hit]
        # In a run of overlapping pairs every second one is replaced, from the left.
        first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        run = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
        at, rule = at[run % 2 == 0], rule[run % 2 == 0]
        known = np.concatenate(sizes)
        size_of = np.concatenate([np.ones(base, np.uint32), known])
        lefts.append((chosen >> np.uint64(32)).astype(np.uint32))
        rights.append((chosen & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        sizes.append(size_of[lefts[-1]] + size_of[rights[-1]])
        seq[at] = (base + len(known) + rule).astype(np.uint32)
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
    return np.concatenate(lefts), np.concatenate(rights), np.concatenate(sizes), seq


class Expansion:
    """The ids each rule stands for, one after the other, for decoding by index arithmetic."""

    def __init__(self, base: int, left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> None:
        self.base = base
        self.starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.sizes = sizes.astype(np.int64)
        self.ids = np.empty(int(self.starts[-1]), np.uint32)
        for k in range(len(left)):
            self.ids[self.starts[k] : self.starts[k + 1]] = np.concatenate([self._one(left[k]), self._one(right[k])])

    def _one(self, symbol: int) -> np.ndarray:
        k = int(symbol) - self.base
        return np.array([symbol], np.uint32) if k < 0 else self.ids[self.starts[k] : self.starts[k + 1]]

    def lengths(self, seq: np.ndarray) -> np.ndarray:
        out = np.ones(len(seq), np.int64)
        rule = seq >= self.base
        out[rule] = self.sizes[seq[rule].astype(np.int64) - self.base]
        return out

    def expand(self, seq: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        lengths = self.lengths(seq) if lengths is None else lengths
        out = np.repeat(seq.astype(np.uint32), lengths)
        rule = seq >= self.base
        if rule.any():
            begin = np.cumsum(lengths) - lengths
            n = lengths[rule]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(begin[rule], n) + step] = self.ids[np.repeat(self.starts[seq[rule].astype(np.int64) - self.base], n) + step]
        return out


# --- the binary block -----------------------------------------------------------------------


def write_block(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """The payload for whole documents and their ids."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    n_ids = np.array([len(x) // 4 for x in ids], "<u4")
    base = int(flat.max()) + 1
    left, right, sizes, seq = compress(flat, np.cumsum(n_ids, dtype=np.int64), base)
    wide = 2 if base + len(left) <= 1 << 16 else 4
    return b"".join(
        [
            MARK,
            struct.pack("<5I", len(ids), base, len(left), len(seq), wide),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            n_ids.tobytes(),
            *(x.astype("<u4").tobytes() for x in (left, right, sizes)),
            seq.astype(f"<u{wide}").tobytes(),
        ]
    )


class Block:
    """A payload opened for reading as a whole, by document or by range."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MARK:
            raise ValueError("not a block of token ids")
        n, base, rules, length, wide = struct.unpack_from("<5I", payload, 4)
        at = 24

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, missing, self.n_ids = part("<i8", n).tolist(), part("u1", n), part("<u4", n)
        self.doc_ids = [None if m else d for d, m in zip(self.doc_ids, missing.tolist(), strict=True)]
        left, right, sizes = (part("<u4", rules) for _ in range(3))
        self.expansion = Expansion(base, left, right, sizes)
        self.seq = part(f"<u{wide}", length)
        self.lengths = self.expansion.lengths(self.seq)
        self.stops = np.cumsum(self.lengths)

    def ids(self) -> np.ndarray:
        return self.expansion.expand(self.seq, self.lengths)

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to ``stop`` of the block; only the symbols that cover them are expanded."""
        if stop <= start:
            return np.empty(0, np.uint32)
        a = int(np.searchsorted(self.stops, start, "right"))
        b = int(np.searchsorted(self.stops, stop, "left")) + 1
        skipped = int(self.stops[a - 1]) if a else 0
        return self.expansion.expand(self.seq[a:b], self.lengths[a:b])[start - skipped : stop - skipped]

    def document(self, k: int) -> np.ndarray:
        ends = np.cumsum(self.n_ids, dtype=np.int64)
        return self.range(int(ends[k] - self.n_ids[k]), int(ends[k]))


# --- writing and reading with Spark ---------------------------------------------------------


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of all documents, in ascending order of doc_id, as blocks below ``path``."""
    end = end_id.to_bytes(4, "little")
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-int(n_bytes) // SHARD_BYTES))
    # Equal ids are told apart by their texts, so one id of very many rows isn't one task.
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        shard, block, names, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def done() -> pa.RecordBatch:
            row = [shard, block, len(names), size // 4, write_block(names, held)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            fields = [f.split(" ")[0] for f in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=fields)

        for batch in batches:
            encoded = pieces_for(tokenizer).ids(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                names.append(doc)
                held.append(ids + end)
                size += len(held[-1])
                if size >= 4 * BLOCK_IDS:
                    yield done()
                    block, names, held, size = block + 1, [], [], 0
        if names:
            yield done()

    map_batches(ordered, run, BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with the number of ids in all blocks before each: first within shards, then over shards."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row per shard of some 10 million ids; the only place where these meet.
    before = shards.select(
        F.col("shard").alias("of"),
        F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)).alias("shard_start"),
    )
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside"))
    starts = starts.join(before, F.col("shard") == F.col("of")).select(
        F.col("shard").alias("s"), F.col("block").alias("b"), (F.col("inside") + F.coalesce("shard_start", F.lit(0))).alias("first_id")
    )
    return blocks.join(starts, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files; the ids too if asked for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, first in zip(batch.column("payload"), batch.column("first_id").to_pylist(), strict=True):
                block = Block(payload.as_py())
                ids = block.ids().astype("<u4")
                n = block.n_ids.astype(np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(block.doc_ids, pa.int64()), pa.array(first + ends - n), pa.array(n), pa.array(sums, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(ends - n, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return map_batches(read_blocks(spark, path).select("payload", "first_id"), run, schema)
