"""Repeated passages: the index against plain search, the operator against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fm_index, substring_dedup
from millrace.llm.common import load
from tests.llm.support import FOLDER, no_documents, odd_documents


def plain(rows, window):
    """What is left of each text, by a dictionary of all windows."""
    order = lambda i: float("inf") if i is None else i
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first: dict = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < order(i):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=by_null)


def by_null(row):
    return tuple((x is None, x) for x in row)


def result(df, **parameters):
    left = substring_dedup.without_repeats(df, **parameters)
    rows = left.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    return sorted(map(tuple, rows), key=by_null)


def longest(hay, needle, limit):
    """Longest match of the beginning of ``needle`` in ``hay``, and where full matches begin."""
    best, full = 0, []
    for s in range(len(hay)):
        n = 0
        while n < min(limit, len(needle), len(hay) - s) and hay[s + n] == needle[n]:
            n += 1
        best = max(best, n)
        if n == limit:
            full.append(s)
    return best, full


def test_matching_statistics_and_classes():
    rng = np.random.default_rng(1)
    for _ in range(60):
        size = int(rng.integers(2, 6))
        texts = [rng.integers(1, size, int(rng.integers(1, 60))) for _ in range(int(rng.integers(1, 8)))]
        texts.append(np.ones(80, np.int64))
        names, text = np.unique(np.concatenate([np.append(t, 0) for t in texts]), return_inverse=True)
        limit = int(rng.integers(1, 20))
        index = fm_index.FmIndex(text, len(names), limit)
        queries = [rng.integers(1, len(names) + 1, int(rng.integers(0, 50))) for _ in range(5)] + [t[:30] for t in texts]
        symbols = np.concatenate([np.where(q < len(names), q, -1) for q in queries])
        starts = np.concatenate([[0], np.cumsum([len(q) for q in queries])])
        lengths, classes = index.matching_statistics(symbols, starts)
        values = rng.integers(0, 1000, len(text))
        least = index.least_of_class(values)
        for a, b in zip(starts, starts[1:], strict=False):
            for k in range(a, b):
                best, full = longest(text.tolist(), symbols[k:b].tolist(), limit)
                assert lengths[k] == best
                assert (classes[k] >= 0) == bool(full)
                if full:
                    assert least[classes[k]] == values[full].min()


def test_ranks_of_a_wavelet_tree():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 200):
        sequence = np.concatenate([np.arange(size), np.minimum(rng.zipf(1.5, 3000) - 1, size - 1)])
        tree = fm_index.WaveletTree(sequence, size)
        symbols, ends = rng.integers(0, size, 500), rng.integers(0, len(sequence) + 1, 500)
        assert tree.rank(symbols, ends).tolist() == [int((sequence[:e] == s).sum()) for s, e in zip(symbols, ends, strict=True)]
        # a symbol takes its code's bits only, within a bit of the entropy
        share = np.bincount(sequence) / len(sequence)
        assert tree.lengths[sequence].mean() <= 1 - (share * np.log2(share)).sum()


def test_a_match_is_shorter_than_the_order():
    with pytest.raises(ValueError):
        fm_index.FmIndex(np.zeros(1, np.int64), 1, fm_index.ORDER)


def awkward():
    """Few words, so that windows repeat inside texts; phrases in many surroundings; null and repeated ids."""
    rng = random.Random(3)
    some = lambda letters, n: " ".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    rows = [(rng.choice([None, *range(40)]), some("abcde", 60) + " x y z w v u t s r q p o n m l k j " + some("abc", 60)) for _ in range(60)]
    rows += [(rng.randrange(40), "z " * rng.randrange(300)) for _ in range(20)]
    rows += [(100 + k, rng.choice(rows)[1][:200] + "\t" + rng.choice(rows)[1][-150:]) for k in range(60)]
    return rows + [rows[0]] * 40


@pytest.mark.parametrize("parameters", [{"hot_segments": 3, "shard_words": 500}, {}])
def test_short_windows_with_hot_phrases(spark, parameters):
    rows = awkward()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(df, window=8, anchor=3, **parameters) == plain(rows, 8)


def test_odd_rows(spark):
    df = odd_documents(spark)
    assert result(df) == plain([(r.doc_id, r.text) for r in df.collect()], 50)
    # other columns go through, whatever their names
    assert substring_dedup.passages(df).select("row.*").columns == df.columns


def test_no_rows(spark):
    assert result(no_documents(spark)) == []


def test_documents(spark):
    df = load(spark, FOLDER, "documents")
    got = result(df)
    assert got == plain([(r.doc_id, r.text) for r in df.collect()], 50)
    assert sum(r[2] for r in got) > 0


def test_spans_of_a_planted_passage(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, f"a b {passage} c"), (2, f"d {passage} e f"), (3, passage), (4, " ".join(f"w{k}" for k in range(49)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["spans"] for r in substring_dedup.passages(df).select("row.doc_id", "spans").collect()}
    covered = {k: {x for s in v for x in range(s["begin"], s["finish"])} for k, v in found.items() if v}
    assert covered == {2: set(range(1, 61)), 3: set(range(60))}
