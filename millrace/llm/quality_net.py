"""Quality classifier: random-indexing word vectors, pooled, under a small network.

Tokens (words and runs of marks, capital words apart from others, and one for
any repetition of the token before) fall into a
fixed number of hash buckets. Each bucket has an index vector, a few +1 and -1 in
places that its number gives; its word vector is the sum of the index vectors
of all tokens that stand within two places of it anywhere in the corpus, turned to unit
length about the corpus mean, plus its own index vector. A document is the mean
of its tokens' vectors, rare tokens weighing more. A network with one hidden
layer, written in numpy and trained on labelled documents, gives a logit; a
temperature fitted on a part kept from training turns it into a probability.

The corpus sums and frequencies cover every document; the table has a size that
doesn't depend on the corpus (buckets times dimensions, 4 MB) and may be sent to
every task. Labels are used from at most ``TRAIN_ROWS`` rows, chosen by a hash.

Defined results: null and empty texts have the zero vector, whose score is the
network's value there. Without labels of both kinds every score is the share of
label 1 (1 without any label, so that nothing is thrown away). Repeated rows are
scored each for itself. An empty table gives no rows. Null labels are left out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, stage

BUCKETS = 16_384
DIMENSIONS = 64
NONZERO = 2
WINDOW = 2
RARE = 1e-3
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 60
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 5) = 0"

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


class _Buckets(dict):
    """The bucket of each token seen, emptied when full."""

    def __missing__(self, token: str) -> int:
        key = f"^{token.lower()}" if len(token) > 1 and token.isupper() else token.lower()
        got = zlib.crc32(key.encode()) % BUCKETS
        if len(self) > 400_000:
            self.clear()
        if len(token) <= 64:
            self[token] = got
        return got


_BUCKET = _Buckets()


#: Stands for a token that is the same as the one before it.
AGAIN = zlib.crc32(b"=") % BUCKETS


def tokens(text: str | None) -> np.ndarray:
    """The buckets of a text's tokens, in order; a token right after its like is ``AGAIN``."""
    ids = np.fromiter(map(_BUCKET.__getitem__, _TOKEN.findall(text or "")), np.int32)
    ids[1:][ids[1:] == ids[:-1]] = AGAIN
    return ids


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors, the same everywhere; a last row for the gap between documents has signs 0."""
    n = np.arange(BUCKETS * NONZERO, dtype=np.uint64)
    mixed = (n + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    places = (mixed % np.uint64(DIMENSIONS)).astype(np.int64).reshape(BUCKETS, NONZERO)
    signs = 1.0 - 2.0 * ((mixed >> np.uint64(40)) & np.uint64(1)).astype(float).reshape(BUCKETS, NONZERO)
    return np.vstack([places, np.zeros((1, NONZERO), np.int64)]), np.vstack([signs, np.zeros((1, NONZERO))])


class ContextSums:
    """Sums of neighbours' index vectors and token counts of the texts that were added."""

    def __init__(self) -> None:
        self.sums = np.zeros((BUCKETS + 1) * DIMENSIONS)
        self.n = np.zeros(BUCKETS, np.int64)
        self.places, self.signs = index_vectors()

    def add(self, texts: list[np.ndarray]) -> None:
        gap = np.full(WINDOW, BUCKETS, np.int32)
        ids = np.concatenate([part for t in texts for part in (t, gap)] or [gap]).astype(np.int64)
        self.n += np.bincount(ids, minlength=BUCKETS + 1)[:BUCKETS]
        for k in range(1, WINDOW + 1):
            for here, there in ((ids[:-k], ids[k:]), (ids[k:], ids[:-k])):
                for s in range(NONZERO):
                    self.sums += np.bincount(here * DIMENSIONS + self.places[there, s], self.signs[there, s], len(self.sums))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.n)
        return used, self.n[used], np.rint(self.sums.reshape(-1, DIMENSIONS)[used]).astype(np.int64)


def in_parts(arrays: Iterable[np.ndarray], most: int = 1 << 20) -> Iterable[list[np.ndarray]]:
    part, size = [], 0
    for a in arrays:
        part.append(a)
        size += len(a)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def context_table(docs: DataFrame) -> DataFrame:
    """bucket, n and the summed dimensions over all documents; tasks send their sums, added up by bucket."""
    names = ["bucket", "n", *(f"v{k}" for k in range(DIMENSIONS))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = ContextSums()
        for batch in batches:
            for part in in_parts(tokens(t.as_py()) for t in batch.column("text")):
                total.add(part)
        used, n, sums = total.rows()
        for at in range(0, len(used), 4096):
            cut = slice(at, at + 4096)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used[cut], n[cut], *sums[cut].T)], names=names)

    sums = map_batches(docs.select("text"), run, ", ".join(f"{c} bigint" for c in names))
    return sums.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names[1:]])


def word_vectors(table: DataFrame) -> np.ndarray:
    """One weighted vector for each bucket; the table has no more rows than there are buckets."""
    n, sums = np.zeros(BUCKETS), np.zeros((BUCKETS, DIMENSIONS))
    for batch in table.toArrow().to_batches():
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        n[columns[0]] = columns[1]
        sums[columns[0]] = np.column_stack(columns[2:])
    share = n / max(1.0, n.sum())
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    unit -= (unit * share[:, None]).sum(axis=0)
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMENSIONS))
    for s in range(NONZERO):
        np.add.at(own, (np.arange(BUCKETS), places[:-1, s]), signs[:-1, s])
    weight = RARE / (RARE + share)
    return ((unit + own) * weight[:, None]).astype(np.float32)


def pooled(texts: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """The mean vector of each text, long texts in blocks."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for k, ids in enumerate(texts):
        for at in range(0, len(ids), 1 << 16):
            out[k] += vectors[ids[at : at + (1 << 16)]].sum(axis=0)
        out[k] /= max(1, len(ids))
    return out


class Network:
    """Standardised input, one hidden layer of tanh units, one logit, a temperature."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.temperature, self.constant = np.zeros(DIMENSIONS), np.ones(DIMENSIONS), 1.0, None
        self.parts = [
            rng.normal(0, DIMENSIONS**-0.5, (DIMENSIONS, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, HIDDEN**-0.5, HIDDEN),
            np.zeros(1),
        ]

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.parts
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
        """Adam on four fifths of the rows, the temperature on the last fifth."""
        if len(set(y.tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 1.0
            return self
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        kept, learned = order[: len(x) // 5], order[len(x) // 5 :]
        self.mean, self.scale = x[learned].mean(axis=0), x[learned].std(axis=0) + 1e-6
        first, second, step = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts], 0
        for _ in range(EPOCHS):
            order = rng.permutation(learned)
            for at in range(0, len(order), 256):
                rows = order[at : at + 256]
                step += 1
                for k, g in enumerate(self._gradients(x[rows], y[rows])):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    size = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.parts[k] = self.parts[k] - size * first[k] / (np.sqrt(second[k]) + 1e-8)
        if len(kept) >= 20:
            z, t = self.logits(x[kept]), y[kept]
            loss = lambda temp: np.mean(np.logaddexp(0, z / temp) - t * z / temp)
            self.temperature = float(min(np.geomspace(0.25, 8, 81), key=loss))
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w1, b1, w2, b2 = self.parts
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w1 + b1)
        off = (1 / (1 + np.exp(-np.clip(h @ w2 + b2[0], -30, 30))) - y) / len(x)
        back = np.outer(off, w2) * (1 - h * h)
        return [x.T @ back + 1e-4 * w1, back.sum(axis=0), h.T @ off + 1e-4 * w2, off.sum(keepdims=True)]


def examples(labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """The labelled ids that may be learned from, at most ``most``, by a hash of the id."""
    named = labels.filter(f"doc_id IS NOT NULL AND quality IS NOT NULL AND NOT ({HELD_OUT})")
    named = named.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of the corpus and the trained network."""
    vectors = word_vectors(context_table(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            x = pooled([tokens(t.as_py()) for t in batch.column("text")], shared.value)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), DIMENSIONS).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), rows], names=["doc_id", "quality", "x"])

    # At most train_rows small rows, whatever the corpus; texts need no shuffle for them.
    labelled = docs.select("doc_id", "text").join(F.broadcast(examples(labels, train_rows)), "doc_id")
    found = map_batches(labelled, run, "doc_id bigint, quality int, x array<float>")
    # Of a labelled id that several rows have, one vector; bounded by train_rows.
    rows = found.groupBy("doc_id").agg(F.min("x").alias("x"), F.max("quality").alias("quality")).orderBy("doc_id").collect()
    x = np.array([r.x for r in rows], float).reshape(-1, DIMENSIONS)
    return vectors, Network().train(x, np.array([float(r.quality > 0) for r in rows]))


def quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train_rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        vectors, network = shared.value
        for batch in batches:
            scores = [network.scores(pooled(part, vectors)) for part in in_parts(tokens(t.as_py()) for t in batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(scores or [np.empty(0)]).astype(float))], names=["doc_id", "score"]
            )

    scored = map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, score double")
    held_out = F.coalesce(F.expr(HELD_OUT), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
