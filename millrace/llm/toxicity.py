"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are runs of four and five characters within words, with the word's edges
as characters; the terms kept are those that labelled toxic examples hold far
more often than the others, a bounded list. Documents are vectors of such
terms, weighted by the logarithm of their count and by inverse document
frequency over all documents. The labelled examples lie in an inverted
index whose postings are cut into blocks of examples, with the largest weight
of each block: a document's upper bound for each block follows from these
alone, blocks are opened from the highest bound down, and none is opened that
cannot beat the k-th best example so far, so the neighbours are exact. Their
votes count by similarity; a logistic curve fitted on the examples themselves,
each scored without itself, turns the vote into a probability. The neighbours
are returned as evidence.

Labels are used from at most ``TRAIN_ROWS`` rows, chosen by a hash of the id;
terms' document frequencies cover every document and every document is scored.

Defined results: null and empty texts, and texts without any term, get the
share of toxic rows among labelled texts without a term (0 without labels).
Equal similarities are settled by the examples' order of id. Repeated rows are
scored each for itself; of a labelled id that several documents have, one
vector is an example. An empty table gives no rows. Null labels are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, stage

GRAM_SIZES = (4, 5)
#: Labelled rows that are examples, at most.
TRAIN_ROWS = 20_000
#: Terms that are kept, at most; each is in so many toxic examples and so much more frequent there.
TERMS = 4096
LEAST_TOXIC = 5
LEAST_LIFT = 4.0
NEIGHBOURS = 15
BLOCK_EXAMPLES = 64
PRIOR_WEIGHT = 0.3
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 5) = 0"

_LETTERS = re.compile(r"[\W\d_]+")
_TABLE_GRAMS = 300_000


# --- terms ----------------------------------------------------------------------------------


def normal(text: str | None) -> str:
    """Lower-case words between single spaces, with a space at both ends."""
    return _LETTERS.sub(" ", f" {(text or '').lower()} ")


def gram_counts(labelled: DataFrame) -> DataFrame:
    """gram, toxic, other: in how many labelled texts of each kind a run of characters occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            grams = list(seen[1].keys() | seen[0].keys())
            out = [pa.array(grams), *(pa.array([c[g] for g in grams], pa.int64()) for c in (seen[1], seen[0]))]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(out, names=["gram", "toxic", "other"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                grams: set[str] = set()
                for word in set(normal(text).split()):
                    edged = f" {word} "
                    for n in GRAM_SIZES:
                        grams.update(edged[i : i + n] for i in range(len(edged) - n + 1))
                seen[1 if toxic else 0].update(grams)
                if len(seen[0]) + len(seen[1]) > _TABLE_GRAMS:
                    yield rows()
        yield rows()

    found = map_batches(labelled.select("text", "toxic"), run, "gram string, toxic bigint, other bigint")
    return found.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def choose_terms(labelled: DataFrame, n_toxic: int, n_other: int, most: int = TERMS) -> list[str]:
    """The runs of characters that tell toxic examples best, a bounded list."""
    lift = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("other") + 0.5) / (n_other + 1))
    ranked = (
        gram_counts(labelled)
        .filter(F.col("toxic") >= LEAST_TOXIC)
        .withColumn("lift", lift)
        .filter(F.col("lift") >= LEAST_LIFT)
        .orderBy((F.col("toxic") * F.ln("lift")).desc(), "gram")
        .limit(most)
    )
    return [r.gram for r in ranked.select("gram").collect()]


class Matcher:
    """Counts of the terms in a text, by one pass of an automaton over it."""

    def __init__(self, terms: list[str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for k, term in enumerate(terms):
            self.automaton.add_word(term, k)
        self.some = bool(terms)
        if self.some:
            self.automaton.make_automaton()

    def counts(self, text: str | None) -> tuple[list[int], list[int]]:
        if not (self.some and text):
            return [], []
        found = sorted(Counter(k for _, k in self.automaton.iter(normal(text))).items())
        return [k for k, _ in found], [n for _, n in found]


# --- the block-max index --------------------------------------------------------------------


class BlockMaxIndex:
    """Unit vectors of the examples by term, in blocks of examples with each term's largest weight."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK_EXAMPLES) -> None:
        owner = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors] or [np.empty(0, int)]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or [np.empty(0)]).astype(np.float64)
        order = np.lexsort((owner, term))
        self.n, self.block, self.n_blocks = len(vectors), block, -(-len(vectors) // block)
        self.owner, self.weight = owner[order], weight[order]
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        # A term's blocks: their number, their first posting, their largest weight.
        key = term[order] * max(1, self.n_blocks) + self.owner // block
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.block_of, self.block_first = self.owner[first] // block, first
        self.block_stop = np.append(first[1:], len(key))
        self.block_max = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.term_blocks = np.searchsorted(term[order][first], np.arange(n_terms + 1)) if len(first) else np.zeros(n_terms + 1, int)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples that share a term, the best first, ties by number."""
        spans = [(self.term_blocks[t], self.term_blocks[t + 1]) for t in terms]
        lists = np.concatenate([np.arange(a, b) for a, b in spans] or [np.empty(0, np.int64)]).astype(np.int64)
        if not len(lists):
            return np.empty(0, np.int64), np.empty(0)
        q = np.repeat(weights, [b - a for a, b in spans])
        bound = np.bincount(self.block_of[lists], q * self.block_max[lists], self.n_blocks)
        ranked = np.argsort(-bound, kind="stable")
        ranked = ranked[bound[ranked] > 0]
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        step = 4
        for at in range(0, len(ranked), step):
            blocks = ranked[at : at + step]
            if len(best) == k and bound[blocks[0]] < best[-1] - 1e-12:
                break
            wanted = np.isin(self.block_of[lists], blocks)
            opened, qs = lists[wanted], q[wanted]
            sizes = self.block_stop[opened] - self.block_first[opened]
            within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            postings = np.repeat(self.block_first[opened], sizes) + within
            owners, back = np.unique(self.owner[postings], return_inverse=True)
            scores = np.bincount(back, np.repeat(qs, sizes) * self.weight[postings])
            if without >= 0:
                scores, owners = scores[owners != without], owners[owners != without]
            best_ids, best = np.concatenate([best_ids, owners]), np.concatenate([best, scores])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
        return best_ids, best


# --- the model ------------------------------------------------------------------------------


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_curve(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with a weak pull to (1, 0)."""
    x = np.column_stack([_logit(raw), np.ones(len(raw))])
    at = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (p - y) + 0.5 * (at - [1.0, 0.0])
        at = at - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2), gradient)
    return max(float(at[0]), 0.05), float(at[1])


class Model:
    """Terms, their weights, the indexed examples and the curve; small enough to go to every task."""

    def __init__(self, terms: list[str], idf: np.ndarray, prior: float, empty_score: float) -> None:
        self.terms, self.idf, self.prior, self.empty_score = terms, idf, prior, empty_score
        self.ids, self.labels, self.curve = [], np.empty(0), (1.0, 0.0)
        self.index = BlockMaxIndex([], len(terms))
        self._matcher, self._known = None, {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_matcher": None, "_known": {}}

    def counts(self, text: str | None) -> tuple[list[int], list[int]]:
        if self._matcher is None:
            self._matcher = Matcher(self.terms)
        return self._matcher.counts(text)

    def vector(self, terms: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.asarray(terms, np.int64)
        w = (1 + np.log(np.asarray(counts, float))) * self.idf[t]
        return t, w / max(np.sqrt((w * w).sum()), 1e-12)

    def vote(self, vector: tuple[np.ndarray, np.ndarray], without: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        ids, sims = self.index.nearest(*vector, without=without)
        weight = sims * sims
        raw = ((weight * self.labels[ids]).sum() + PRIOR_WEIGHT * self.prior) / (weight.sum() + PRIOR_WEIGHT)
        return float(raw), ids, sims

    def learn(self, ids: list[int], labels: np.ndarray, counted: list[tuple[list[int], list[int]]]) -> None:
        """Index the examples that have a term and fit the curve on them."""
        vectors = [self.vector(*c) for c in counted]
        # Neighbouring numbers for like examples, so that blocks differ in their largest weights.
        order = sorted(range(len(ids)), key=lambda i: (labels[i], int(vectors[i][0][np.argmax(vectors[i][1])]), ids[i]))
        vectors = [vectors[i] for i in order]
        self.ids, self.labels = [ids[i] for i in order], np.asarray([labels[i] for i in order], float)
        self.index = BlockMaxIndex(vectors, len(self.terms))
        if len(vectors):
            raw = np.array([self.vote(v, without=i)[0] for i, v in enumerate(vectors)])
            self.curve = fit_curve(raw, self.labels)

    def score(self, terms: list[int], counts: list[int]) -> tuple[float, list[dict]]:
        """The probability and the nearest examples; equal vectors are looked up once."""
        if not len(terms):
            return self.empty_score, []
        key = (tuple(terms), tuple(counts)) if len(terms) < 12 else None
        if key in self._known:
            return self._known[key]
        raw, ids, sims = self.vote(self.vector(terms, counts))
        p = float(1 / (1 + np.exp(-np.clip(self.curve[0] * _logit(np.array(raw)) + self.curve[1], -30, 30))))
        evidence = [
            {"doc_id": self.ids[i], "similarity": float(s), "toxic": int(self.labels[i])}
            for i, s in zip(ids[:5].tolist(), sims[:5].tolist(), strict=True)
        ]
        if key:
            if len(self._known) > 50_000:
                self._known.clear()
            self._known[key] = (p, evidence)
        return p, evidence


def examples(labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """The labelled ids that may be learned from, at most ``most``, by a hash of the id."""
    named = labels.filter(f"doc_id IS NOT NULL AND toxic IS NOT NULL AND NOT ({HELD_OUT})")
    named = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id with the numbers and counts of its terms."""
    model = Model(terms, np.ones(len(terms)), 0.0, 0.0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            found = [model.counts(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([f[k] for f in found], pa.list_(pa.int32())) for k in (0, 1))],
                names=["doc_id", "terms", "counts"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, terms array<int>, counts array<int>")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[Model, DataFrame]:
    """The model and the stored vectors of all documents."""
    chosen = stage(examples(labels, train_rows), "examples")
    # The chosen ids are at most train_rows small rows, whatever the corpus; texts need no shuffle for them.
    labelled = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    sizes = {r.t: r.n for r in labelled.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = sizes.get(True, 0), sizes.get(False, 0)
    terms = choose_terms(labelled, n_toxic, n_other) if n_toxic else []
    found = stage(vectors(docs, terms), "vectors")
    n = found.count()
    df = np.zeros(len(terms))
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        df[r.t] = r.n
    # Of a labelled id that several rows have, one vector; bounded by train_rows.
    rows = found.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("terms", "counts")).alias("v"), F.max("toxic").alias("toxic")).collect()
    rows.sort(key=lambda r: r.doc_id)
    bare = [r.toxic > 0 for r in rows if not r.v.terms]
    prior = sum(r.toxic > 0 for r in rows) / len(rows) if rows else 0.0
    model = Model(terms, np.log((1 + n) / (1 + df)) + 1, prior, sum(bare) / len(bare) if bare else prior)
    full = [r for r in rows if r.v.terms]
    model.learn([r.doc_id for r in full], np.array([float(r.toxic > 0) for r in full]), [(r.v.terms, r.v.counts) for r in full])
    return model, found


EVIDENCE = "array<struct<doc_id: bigint, similarity: double, toxic: int>>"


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence for every row of ``docs``."""
    model, found = fit(docs, labels, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            scored = [shared.value.score(t, c) for t, c in zip(*(batch.column(k).to_pylist() for k in ("terms", "counts")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([p for p, _ in scored], pa.float64()), pa.array([e for _, e in scored], kind)],
                names=["doc_id", "score", "evidence"],
            )

    scored = map_batches(found, run, f"doc_id bigint, score double, evidence {EVIDENCE}")
    held_out = F.coalesce(F.expr(HELD_OUT), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def civil_rows(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    model, _ = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            keep = [shared.value.score(*shared.value.counts(t.as_py()))[0] < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
