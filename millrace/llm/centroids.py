"""Centroid clustering with heap-ordered bounds.

Every vector keeps the gap between its distance to its own centroid (upper) and
to the next one (lower). When centroids move, the gap shrinks by at most the
drift of the own centroid plus the largest drift of another, which is the same
for all vectors of a cluster. So each cluster has one running offset and a heap
of gaps that were put in with the offset of that time added: a vector has to be
looked at again only when its entry is not above the cluster's offset any more.
Those are popped and compared with all centroids exactly; no other vector is.

Vectors lie in blocks, one row each with its matrix, its heaps and, for every
cluster, the sum and number of its vectors; popped vectors that change cluster
are taken out of one sum and put into another. A round reads the blocks once and
writes them once. Only ``k`` sums come to the driver.

All arithmetic that decides is on integers. Bounds are floating numbers with a
margin, and equal distances always lie within it, so ties are seen by the exact
comparison, where the smaller cluster number wins.

Defined results: only vectors with exactly ``dim`` components, none null or
non-finite, are kept. A component beyond ``LARGEST`` in size is left out in the
same way, as its squared distances would not fit a long. Repeated rows count
each; rows with a null id are clustered but don't start a centroid while others
can. Fewer kept vectors than ``k`` give as many centroids; none give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, stage

#: Largest absolute value of a scaled component: 64 squared differences of twice this fit a long.
LARGEST = 1 << 27
#: Up to this size float64 holds every product and sum of 64 of them exactly.
_EXACT_IN_FLOAT = 1 << 20
#: Gaps up to this, relative to the distance, are not trusted.
MARGIN = 1e-9

BLOCK = "ids array<bigint>, vectors binary, keys binary, rows binary, ends array<int>, sums array<bigint>, counts array<bigint>, popped bigint"


def kept_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """``vec_id, v``: the usable vectors as integers floor(scale * x)."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) * scale <= LARGEST, F.lit(False)))
    return vectors.filter((F.size("embedding") == dim) & usable).select("vec_id", scaled.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose hashed ids come first."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(rank.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to all centroids."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT_IN_FLOAT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


class Heaps:
    """A block's vectors by cluster, each cluster a heap of (gap when put in + offset then, row)."""

    def __init__(self, x: np.ndarray, k: int) -> None:
        self.x, self.k = x, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        self.sums, self.counts = np.zeros((k, x.shape[1]), np.int64), np.zeros(k, np.int64)
        self.popped = 0

    @classmethod
    def load(cls, x, keys, rows, ends, sums, counts) -> Heaps:
        out = cls(x, len(counts))
        pairs = list(zip(keys.tolist(), rows.tolist(), strict=True))
        out.heaps = [pairs[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        out.sums, out.counts = sums.reshape(out.k, -1).copy(), counts.copy()
        return out

    def expired(self, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pop the rows whose entry is not above their cluster's offset, with the cluster they leave."""
        rows, clusters = [], []
        for c, heap in enumerate(self.heaps):
            limit = float(offsets[c])
            limit += MARGIN * (1.0 + abs(limit))
            while heap and heap[0][0] <= limit:
                rows.append(heapq.heappop(heap)[1])
                clusters.append(c)
        return np.array(rows, np.int64), np.array(clusters, np.int64)

    def place(self, rows: np.ndarray, old: np.ndarray | None, centroids: np.ndarray, offsets: np.ndarray) -> None:
        """Compare ``rows`` with all centroids and put them into the heap of the nearest."""
        if not len(rows):
            return
        self.popped = len(rows)
        d = squared_distances(self.x[rows], centroids)
        nearest = d.argmin(1)  # the first of equal ones
        roots = np.sqrt(d.astype(np.float64))
        upper = roots[np.arange(len(rows)), nearest]
        roots[np.arange(len(rows)), nearest] = np.inf
        gap = roots.min(1) - upper
        keys = gap - MARGIN * (1.0 + upper) + offsets[nearest]
        if old is None:
            for c in range(self.k):
                mine = nearest == c
                heap = list(zip(keys[mine].tolist(), rows[mine].tolist(), strict=True))
                heapq.heapify(heap)
                self.heaps[c] = heap
            moved, left = rows, None
        else:
            for key, row, c in zip(keys.tolist(), rows.tolist(), nearest.tolist(), strict=True):
                heapq.heappush(self.heaps[c], (key, row))
            changed = nearest != old
            moved, left, nearest = rows[changed], old[changed], nearest[changed]
        np.add.at(self.sums, nearest, self.x[moved])
        np.add.at(self.counts, nearest, 1)
        if left is not None:
            np.subtract.at(self.sums, left, self.x[moved])
            np.subtract.at(self.counts, left, 1)

    def row(self, ids: pa.Scalar) -> dict:
        pairs = [p for heap in self.heaps for p in heap]
        return {
            "ids": ids,
            "vectors": self.x.astype("<i4").tobytes(),
            "keys": np.array([p[0] for p in pairs], "<f8").tobytes(),
            "rows": np.array([p[1] for p in pairs], "<i4").tobytes(),
            "ends": np.cumsum([len(h) for h in self.heaps]).tolist(),
            "sums": self.sums.ravel().tolist(),
            "counts": self.counts.tolist(),
            "popped": self.popped,
        }


_FIELDS = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("vectors", pa.binary()),
        ("keys", pa.binary()),
        ("rows", pa.binary()),
        ("ends", pa.list_(pa.int32())),
        ("sums", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("popped", pa.int64()),
    ]
)


def _blocks(batch: pa.RecordBatch, dim: int) -> Iterable[tuple[pa.Scalar, Heaps]]:
    for r in batch.to_pylist():
        x = np.frombuffer(r["vectors"], "<i4").astype(np.int64).reshape(-1, dim)
        state = (np.frombuffer(r["keys"], "<f8"), np.frombuffer(r["rows"], "<i4"), r["ends"], np.array(r["sums"], np.int64), np.array(r["counts"], np.int64))
        yield r["ids"], Heaps.load(x, *state)


def _build(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Blocks with every vector compared once; a block is one Arrow batch."""
    k, dim = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
            block = Heaps(x, k)
            block.place(np.arange(len(x)), None, centroids, np.zeros(k))
            yield pa.RecordBatch.from_pylist([block.row(batch.column("vec_id").to_pylist())], _FIELDS)

    return map_batches(vectors, run, BLOCK)


def _again(blocks: DataFrame, centroids: np.ndarray, offsets: np.ndarray) -> DataFrame:
    """Blocks after a move of the centroids: expired vectors are popped and placed anew."""
    dim = centroids.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for ids, block in _blocks(batch, dim):
                rows, old = block.expired(offsets)
                block.place(rows, old, centroids, offsets)
                yield pa.RecordBatch.from_pylist([block.row(ids)], _FIELDS)

    return map_batches(blocks, run, BLOCK)


def _totals(blocks: DataFrame, k: int, dim: int) -> tuple[list[list[int]], list[int]]:
    """Sum and number of the vectors of each cluster, exact whatever their number; k rows reach the driver."""
    by_cell = (
        blocks.select(F.posexplode("sums"))
        .groupBy("pos")
        .agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
        .select((F.col("pos") / dim).cast("int").alias("c"), (F.col("pos") % dim).alias("d"), "s")
    )
    sums = [[0] * dim for _ in range(k)]
    for r in by_cell.collect():
        sums[r["c"]][r["d"]] = int(r["s"])
    counts = [0] * k
    for r in blocks.select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        counts[r["pos"]] = int(r["n"])
    return sums, counts


def moved(centroids: np.ndarray, sums: list[list[int]], counts: list[int]) -> np.ndarray:
    """Each centroid as the floor of its vectors' mean; empty ones stay."""
    return np.array([[s // n for s in row] if n else list(c) for c, row, n in zip(centroids.tolist(), sums, counts, strict=True)], np.int64)


def drift_of(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What a gap of each cluster loses at most: the own drift plus the largest of another centroid."""
    drift = np.sqrt(((after - before).astype(np.float64) ** 2).sum(1)) * (1 + 1e-12)
    others = np.array([np.delete(drift, c).max(initial=0.0) for c in range(len(drift))])
    return drift + others


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1) -> tuple[DataFrame, np.ndarray, list[int]]:
    """``vec_id, cluster, distance`` of every kept vector, the final centroids, and how many vectors each pass compared."""
    kept = stage(kept_vectors(vectors, dim, scale), "vectors")
    centroids = first_centroids(kept, k, seed)
    k = len(centroids)
    if not k:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids, []
    blocks = stage(_build(kept, centroids), "blocks")
    offsets, compared = np.zeros(k), []
    for _ in range(rounds):
        sums, counts = _totals(blocks, k, dim)
        after = moved(centroids, sums, counts)
        offsets = offsets + drift_of(centroids, after)
        centroids = after
        blocks = stage(_again(blocks, centroids, offsets), "blocks")
        compared.append(int(blocks.agg(F.sum("popped")).first()[0] or 0))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for ids, block in _blocks(batch, dim):
                where = np.empty(len(ids), np.int32)
                for c, heap in enumerate(block.heaps):
                    where[[r for _, r in heap]] = c
                distance = ((block.x - centroids[where]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(where, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return map_batches(blocks, rows, "vec_id bigint, cluster int, distance bigint"), centroids, compared


def centroid_report(vectors: DataFrame, **parameters: int) -> DataFrame:
    """Each kept vector with its cluster, the inertia of the cluster and of all, and its centroid's digest."""
    found, centroids, _ = cluster(vectors, **parameters)
    found = stage(found, "clusters")
    # one row per cluster, at most k
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(r["cluster_inertia"] for r in by_cluster)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    names = [(r["cluster"], r["cluster_inertia"], total, digest[r["cluster"]]) for r in by_cluster]
    table = found.sparkSession.createDataFrame(names, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
