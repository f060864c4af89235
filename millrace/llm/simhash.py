"""Near-duplicates by SimHash fingerprints and a binary trie joined with itself.

Fingerprints are made of the hashes of three-word shingles. The distinct ones
form a binary trie whose upper part is a table of nodes (prefix and number of
fingerprints below). Starting from the pair (root, root), pairs of nodes are
taken down together four bits at a time, the bits in which they differ are added
up, and a pair beyond the error budget is dropped with everything below it. A
pair goes down as long as one of its nodes is large, so a crowded part of the
trie is opened further than the rest and no task holds more than the node limit.
The pairs that are left meet the sorted fingerprints of their two nodes, and a
task walks the two subtrees together in the same way, bit by bit, a whole level
at a time. Links join distinct fingerprints; copies share one and need none.

Defined results: a null text is an empty one; a text without words has
fingerprint zero and is linked like any other. Repeated rows count as copies.
A null doc_id never is a component's name unless all its ids are null. An empty
table gives no rows. Other columns are ignored by ``near_duplicates`` and handed
through by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, packed_rows, stage, text_of, unpacked_rows
from millrace.llm.components import components

SHINGLE_WORDS = 3
HASH_SEED = 42
ERRORS = 2
STEP_BITS = 4
#: A pair of nodes goes further down while one of them has more fingerprints than this.
NODE_FINGERPRINTS = 16_384
HASHES_AT_ONCE = 1 << 16


# --- fingerprints ---------------------------------------------------------------------------


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text; a long text's hashes are counted in blocks."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: only ASCII letters and white space count
    if not words:
        return 0
    width = min(shingle_words, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, HASHES_AT_ONCE):
        part = words[at : min(at + HASHES_AT_ONCE, total) + width - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(width)], strict=False))
        hashes = np.array([xxh64_intdigest(s, HASH_SEED) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, the carried columns, and the text's fingerprint as a signed 64-bit number."""
    texts = docs.select("doc_id", *carried, "text")
    names = [c for c in texts.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found)], names=[*names, "fp"])

    schema = ", ".join(f"{c} {kind}" for c, kind in texts.dtypes if c != "text")
    return map_batches(texts, run, f"{schema}, fp bigint")


def _text_sha(text: Column) -> Column:
    return F.unhex(F.sha2(text_of(text), 256))


# --- the trie joined with itself ------------------------------------------------------------


def _prefix(depth: int) -> Column:
    """The leading bits of a fingerprint as a number; at depth 0 the root."""
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("bigint")


def node_pairs(fps: DataFrame, limit: int = NODE_FINGERPRINTS, errors: int = ERRORS) -> tuple[DataFrame, list[int]]:
    """Pairs (a, b, differ, depth) of trie nodes to be searched, and the depths at which there are any.

    ``fps`` holds distinct fingerprints. A node's number is its prefix.
    """
    n = fps.count()
    spark = fps.sparkSession
    pairs = spark.range(1).select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"), F.lit(0).alias("differ"))
    if n <= limit:
        return pairs.withColumn("depth", F.lit(0)), [0]
    done, depth, open_pairs = [], 0, pairs
    while depth < 64:
        depth += STEP_BITS
        nodes = fps.groupBy(_prefix(depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        nodes = stage(nodes.withColumn("parent", F.shiftrightunsigned("node", STEP_BITS)), "trie-nodes")
        left = nodes.select(F.col("parent").alias("a"), F.col("node").alias("a_node"), F.col("n").alias("a_n"))
        right = nodes.select(F.col("parent").alias("b"), F.col("node").alias("b_node"), F.col("n").alias("b_n"))
        differ = (F.col("differ") + F.bit_count(F.col("a_node").bitwiseXOR(F.col("b_node")) .bitwiseAND(F.lit((1 << STEP_BITS) - 1)))).cast("int")
        below = (
            open_pairs.join(left, "a")
            .join(right, "b")
            .filter((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node")))
            .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), differ.alias("differ"), "a_n", "b_n")
            .filter(F.col("differ") <= errors)
        )
        below = stage(below, "trie-pairs")
        large = (F.col("a_n") > limit) | (F.col("b_n") > limit)
        if depth == 64:
            large = F.lit(False)
        done.append(below.filter(~large).select("a", "b", "differ", F.lit(depth).alias("depth")))
        open_pairs = below.filter(large).select("a", "b", "differ")
        if open_pairs.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, list(range(STEP_BITS, depth + 1, STEP_BITS))


def _children(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, prefix: np.ndarray, bit: int) -> np.ndarray:
    """Where each node's right half begins."""
    return np.searchsorted(keys, prefix | np.uint64(1 << (63 - bit)))


def walk_pair(left: np.ndarray, right: np.ndarray, same: bool, depth: int, differ: int, errors: int = ERRORS) -> tuple[np.ndarray, np.ndarray]:
    """All (x, y) with x from ``left``, y from ``right``, at most ``errors`` differing bits.

    Both are sorted; ``differ`` bits differ in the leading ``depth`` bits that
    each side has in common. With ``same`` both are one node and x < y.
    """
    found_x: list[np.ndarray] = []
    found_y: list[np.ndarray] = []
    lo_a, hi_a = np.array([0]), np.array([len(left)])
    lo_b, hi_b = np.array([0]), np.array([len(right)])
    spent, twin = np.array([differ]), np.array([same])
    for bit in range(depth, 64):
        # Small pairs are compared at once.
        small = (hi_a - lo_a) * (hi_b - lo_b) <= 16
        if small.any():
            wide = (hi_b - lo_b)[small]
            cells = (hi_a - lo_a)[small] * wide
            owner = np.repeat(np.arange(len(cells)), cells)
            cell = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
            x = left[lo_a[small][owner] + cell // wide[owner]]
            y = right[lo_b[small][owner] + cell % wide[owner]]
            near = (np.bitwise_count(x ^ y) <= errors) & ~(twin[small][owner] & (x >= y))
            found_x.append(x[near])
            found_y.append(y[near])
            rest = ~small
            lo_a, hi_a, lo_b, hi_b, spent, twin = (v[rest] for v in (lo_a, hi_a, lo_b, hi_b, spent, twin))
        if not len(spent):
            break
        half = np.uint64(1 << (63 - bit))
        keep = ~np.uint64((1 << (64 - bit)) - 1) if bit else np.uint64(0)
        mid_a = np.searchsorted(left, (left[lo_a] & keep) | half)
        mid_b = np.searchsorted(right, (right[lo_b] & keep) | half)
        apart = spent < errors
        cross = apart & ~twin  # a node paired with itself needs only one of its two crossings
        lo_a, hi_a, lo_b, hi_b, spent, twin = (
            np.concatenate(parts)
            for parts in (
                (lo_a, mid_a, lo_a[apart], mid_a[cross]),
                (mid_a, hi_a, mid_a[apart], hi_a[cross]),
                (lo_b, mid_b, mid_b[apart], lo_b[cross]),
                (mid_b, hi_b, hi_b[apart], mid_b[cross]),
                (spent, spent, spent[apart] + 1, spent[cross] + 1),
                (twin, twin, np.zeros(int(apart.sum()), bool), np.zeros(int(cross.sum()), bool)),
            )
        )
        some = (lo_a < hi_a) & (lo_b < hi_b)
        lo_a, hi_a, lo_b, hi_b, spent, twin = (v[some] for v in (lo_a, hi_a, lo_b, hi_b, spent, twin))
    empty = [np.empty(0, np.uint64)]
    return np.concatenate(found_x or empty), np.concatenate(found_y or empty)


def links(fps: DataFrame, limit: int = NODE_FINGERPRINTS, errors: int = ERRORS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints with at most ``errors`` differing bits, each pair once."""
    pairs, depths = node_pairs(fps, limit, errors)
    held = None
    for depth in depths:
        # The sorted fingerprints of a node in one binary value; only nodes within the limit are asked for.
        wanted = pairs.filter(F.col("depth") == depth)
        wanted = wanted.select(F.col("a").alias("node")).unionByName(wanted.select(F.col("b").alias("node"))).distinct()
        part = (
            fps.withColumn("node", _prefix(depth))
            .join(wanted, "node")
            .groupBy("node")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list("fp")), lambda x: F.lpad(F.hex(x), 16, "0")), "").alias("keys"))
            .select(F.lit(depth).alias("depth"), "node", F.unhex("keys").alias("keys"))
        )
        held = part if held is None else held.unionByName(part)
    held = stage(held, "trie-leaves")
    met = pairs.join(held.select("depth", F.col("node").alias("a"), F.col("keys").alias("left")), ["depth", "a"]).join(
        held.select("depth", F.col("node").alias("b"), F.col("keys").alias("right")), ["depth", "b"]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("a", "b", "depth", "differ")}
                left, right = (np.sort(np.frombuffer(batch.column(c)[k].as_py(), ">u8").astype(np.uint64)) for c in ("left", "right"))
                x, y = walk_pair(left, right, row["a"] == row["b"], row["depth"], row["differ"], errors)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    wide = met.select("a", "b", "depth", "differ", "left", "right").repartition(F.col("a"), F.col("b"))
    return map_batches(wide, run, "a bigint, b bigint")


# --- documents ------------------------------------------------------------------------------


def _classes(marked: DataFrame, limit: int = NODE_FINGERPRINTS) -> DataFrame:
    """fp, root, component_id for each distinct fingerprint of ``marked(doc_id, fp)``."""
    ids = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = stage(components(stage(links(ids.select("fp"), limit), "links")), "roots")
    named = ids.join(roots, ids.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, limit: int = NODE_FINGERPRINTS) -> DataFrame:
    """doc_id, fingerprint and component_id for every row of ``docs``."""
    marked = stage(fingerprints(docs), "marked")
    classes = stage(_classes(marked, limit).drop("root"), "classes")
    return marked.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the least doc_id, nulls last, then of the least hash of its text.

    Rows of one doc_id and one text are in one component, so that the two tell
    all rows apart that may both stay.
    """
    marked = stage(fingerprints(docs, _text_sha(F.col("text")).alias("text_sha")), "marked")
    classes = stage(_classes(marked), "classes")
    alike = marked.join(classes, "fp").groupBy("root", "doc_id", "text_sha").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", "text_sha", "n"))
    heads = alike.groupBy("root").agg(first.alias("h")).select("root", *[F.col(f"h.{c}").alias(c) for c in ("doc_id", "text_sha", "n")])
    rows = packed_rows(docs).withColumn("sha", _text_sha(F.col("row.text")))
    rows = rows.join(heads, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha")))
    once = rows.filter("n = 1").select("row")
    combined = rows.filter("n > 1").groupBy("root").agg(F.first("row").alias("row")).select("row")
    return unpacked_rows(once.unionByName(combined))
