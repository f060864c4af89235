"""Centroid clustering against plain integers."""

import hashlib
import math

import numpy as np

from millrace.llm import centroids
from millrace.llm.common import load
from tests.llm.support import FOLDER

SCHEMA = "vec_id bigint, embedding array<float>, cluster int, d int"


def plain(rows, k=16, rounds=3, dim=64, scale=64, seed=1):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x) * scale <= centroids.LARGEST for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    middle = [v for _, v in start]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((distance(v, c), n) for n, c in enumerate(middle))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        middle = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(middle)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in found), key=str)


def result(df, **parameters):
    return sorted(map(tuple, centroids.centroid_report(df, **parameters).collect()), key=str)


def test_table(spark):
    df = load(spark, FOLDER, "embeddings")
    assert result(df) == plain([(r.vec_id, r.embedding) for r in df.collect()])


def test_ties_odd_rows_and_other_columns(spark):
    rng = np.random.default_rng(5)
    # few different values, so most distances tie; clusters that run empty; copies; a null id
    rows = [(k, [float(x) for x in rng.integers(-1, 2, 3)]) for k in range(300)]
    rows += [(7, [0.0, 0.0, 0.0])] * 200 + [(None, [1.0, -1.0, 0.5]), (400, None), (401, []), (402, [1.0, 2.0]), (403, [1.0, None, 2.0])]
    rows += [(404, [1.0, float("nan"), 2.0]), (405, [1.0, float("inf"), 2.0]), (406, [3e7, 0.0, 0.0]), (407, [2e6, -2e6, 1.0]), (408, [-2e6, 0.1, 0.2])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    for k in (1, 2, 5, 16):
        assert result(df, k=k, dim=3) == plain(stored, k=k, dim=3)


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 1.5], 0, 0), (2, [-0.5, 0.25], 0, 0)], SCHEMA)
    assert result(df, dim=2) == plain([(1, [0.5, 1.5]), (2, [-0.5, 0.25])], dim=2)
    assert result(df.limit(0)) == []


def test_only_expired_vectors_are_compared(spark):
    """Far apart groups: after the first pass no gap runs out."""
    rng = np.random.default_rng(6)
    rows = [(k, (rng.normal(0, 0.05, 4) + 50 * (k % 4)).tolist(), 0, 0) for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    for seed in range(1, 40):  # a start with one centroid in each group
        if len({round(c[0] / 3200) for c in centroids.first_centroids(centroids.kept_vectors(df, 4, 64), 4, seed).tolist()}) == 4:
            break
    _, _, compared = centroids.cluster(df, k=4, dim=4, seed=seed)
    assert compared == [0, 0, 0]
    assert result(df, k=4, dim=4, seed=seed) == plain([(r.vec_id, r.embedding) for r in df.collect()], k=4, dim=4, seed=seed)
