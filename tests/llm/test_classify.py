"""Classifiers against brute force and held-out labels."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import quality_net, toxicity
from millrace.tables import load
from tests.llm.support import ODD_TEXTS, no_documents, odd_documents

LARGE = "/root/testdata/sf0.1"


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 60), st.integers(1, 6), st.integers(1, 5))
def test_nearest_examples_are_exact(seed, n, k, block):
    rng = np.random.default_rng(seed)
    vectors = []
    for _ in range(n):
        terms = np.unique(rng.integers(0, 12, rng.integers(1, 6)))
        w = rng.integers(1, 4, len(terms)).astype(float)  # few values, so that there are ties
        vectors.append((terms, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex(vectors, 12, block)
    dense = np.zeros((n, 12))
    for row, (t, w) in zip(dense, vectors, strict=True):
        row[t] = w
    for without in (-1, 0):
        t, w = vectors[0]
        ids, sims = index.nearest(t, w, k, without=without)
        truth = dense[:, t] @ w
        allowed = [i for i in range(n) if truth[i] > 0 and i != without]
        best = sorted((-truth[i] for i in allowed))[:k]
        assert np.allclose(sorted(-sims), best) and np.allclose(truth[ids], sims)


def test_terms_are_counted_with_their_overlaps():
    matcher = toxicity.Matcher([" abc", "bcab", "cabc", "abc "])
    assert matcher.counts("Abcabc, abc! 1 abca") == ([0, 1, 2, 3], [3, 1, 1, 2])
    assert toxicity.Matcher([]).counts("x") == ([], [])


def held_out(df, labels, label):
    rows = df.join(labels.select("doc_id", label), "doc_id").filter("held_out").select("score", label).collect()
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    rank = s.argsort().argsort()
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum()), s, y


def test_toxicity_on_held_out_labels(spark):
    docs, labels = load(spark, LARGE, "documents"), load(spark, LARGE, "labels")
    got = toxicity.toxicity(docs, labels).cache()
    assert got.count() == docs.count()
    area, s, y = held_out(got, labels, "toxic")
    assert area > 0.85 and (s[y == 1] >= 0.5).mean() > 0.7 and (s[y == 0] >= 0.5).mean() < 0.02
    assert abs(s.mean() - y.mean()) < 0.03
    row = got.orderBy(F.col("score").desc()).first()
    assert row.evidence and all(0 < e.similarity <= 1.000001 for e in row.evidence)
    kept = toxicity.civil_rows(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.filter("score < 0.5").count()


def test_quality_on_held_out_labels(spark):
    docs, labels = load(spark, LARGE, "documents"), load(spark, LARGE, "labels")
    got = quality_net.quality(docs, labels)
    area, s, y = held_out(got, labels, "quality")
    assert area > 0.95 and (s[y == 1] >= 0.3).mean() > 0.97 and (s[y == 0] < 0.3).mean() > 0.8
    assert abs(s.mean() - y.mean()) < 0.03


@pytest.mark.parametrize("score", [toxicity.toxicity, quality_net.quality])
def test_awkward_rows(spark, score):
    docs = odd_documents(spark)
    ids = [(k, k % 2, (k + 1) % 2) for k in range(len(ODD_TEXTS))] + [(None, 1, 1), (5, None, None), (3, 1, 0), (999, 1, 1)]
    labels = spark.createDataFrame(ids, "doc_id bigint, quality int, toxic int")
    got = score(docs, labels).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0) for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in got)
    empty = {r.score for r in got if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1
    assert score(no_documents(spark), labels).count() == 0
    none = score(docs, labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1 and none[0].predicted == (1 if score is quality_net.quality else 0)


def test_word_vectors_are_sums_of_neighbours(spark):
    text = "The cat, the CAT sat sat sat.\nA mat"
    ids = quality_net.tokens(text)
    assert ids[6:8].tolist() == [quality_net.AGAIN] * 2
    places, signs = quality_net.index_vectors()
    expected = np.zeros((quality_net.BUCKETS, quality_net.DIMENSIONS))
    for i, a in enumerate(ids):
        for j, b in enumerate(ids):
            if 0 < abs(i - j) <= quality_net.WINDOW:
                np.add.at(expected[a], places[b], signs[b])
    docs = spark.createDataFrame([(1, text), (2, None), (3, text)], "doc_id bigint, text string")
    table = quality_net.context_table(docs).collect()
    assert {r.bucket: r.n for r in table} == {int(b): 2 * int((ids == b).sum()) for b in set(ids.tolist())}
    for r in table:
        assert list(r[2:]) == (2 * expected[r.bucket]).tolist()


def test_network_gradients_and_temperature():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, quality_net.DIMENSIONS)), rng.integers(0, 2, 40).astype(float)
    net = quality_net.Network()
    loss = lambda: np.mean(np.logaddexp(0, net.logits(x)) - y * net.logits(x))
    grads = net._gradients(x, y)
    for k, at in ((0, (3, 5)), (1, (4,)), (2, (7,)), (3, (0,))):
        kept = net.parts[k][at]
        net.parts[k][at] = kept + 1e-6
        high = loss()
        net.parts[k][at] = kept - 1e-6
        low = loss()
        net.parts[k][at] = kept
        decay = 1e-4 * kept if k in (0, 2) else 0
        assert abs((high - low) / 2e-6 - (grads[k][at] - decay)) < 1e-5
    assert quality_net.Network().train(x[:5], np.ones(5)).scores(x).tolist() == [1.0] * 40
