"""Alignment of two tokenizers against a walk over byte ranges; the matrix product against dense ones."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from millrace.llm import alignment
from millrace.llm.common import load
from millrace.llm.cuts import cut_units
from millrace.llm.sparse import Csr, from_sizes, product
from tests.llm.support import FOLDER, no_documents, odd_documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def spans(ids, sizes):
    ends = np.cumsum([sizes[i] for i in ids]).tolist()
    return list(zip([0, *ends], ends, ids, strict=False))


def plain(aligner, rows):
    """Whole texts, one after the other, by the ranges of their tokens."""
    each, counts = [], Counter()
    for _, text in rows:
        (ids_a,), (ids_b,) = aligner.encode([" " + text]) if text else ([[]], [[]])
        if not text or not aligner.spells(" " + text, ids_a, ids_b):
            each.append(([], [], [], []))
            continue
        a, b = spans(ids_a, aligner.size_a), spans(ids_b, aligner.size_b)
        links, low = [], 0
        for start, stop, x in a:
            while b[low][1] <= start:
                low += 1
            k = low
            while k < len(b) and b[k][0] < stop:
                links.append((x, b[k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        group = lambda tokens, lo, hi: ",".join(str(t) for _, e, t in tokens if lo < e <= hi)
        groups = [f"{group(a, lo, hi)}|{group(b, lo, hi)}" for lo, hi in zip([0, *cuts], cuts, strict=False)] if len(a) < 2000 else None
        each.append((ids_a, ids_b, groups, links))
        counts.update(set(links))
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), (ids_a, ids_b, groups, links) in zip(rows, each, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "" if groups == [] else None
        best = sum(counts[p] == top[p[0]] for p in links)
        out.append((doc_id, len(ids_a), len(ids_b), None if groups is None else len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out


def check(aligner, df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    null = lambda r: tuple((x is None, x) for x in r[:3] + r[4:7])
    got = sorted((tuple(r)[:8] for r in alignment.align(df, A, B).collect()), key=null)
    want = sorted(plain(aligner, rows), key=null)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] + g[4:7] == w[:3] + w[4:7]
        if w[3] is not None:  # the plain way to write groups is too slow for the longest texts
            assert (g[3], g[7]) == (w[3], w[7])
    return want


def test_odd_rows_and_other_columns(spark, aligner):
    check(aligner, odd_documents(spark))


def test_random_texts(spark, aligner):
    rng = random.Random(1)
    letters = ["a", "b", " ", "  ", "▁", "\t", "\n", "<s>", "</s>", "é", "́", "ⅷ", "　", "'s", "t", "你", "0", "<|endoftext|>", "<0x41>", "\x00", "\U0001f600"]
    rows = [(k, "".join(rng.choice(letters) for _ in range(rng.randrange(30)))) for k in range(1500)]
    want = check(aligner, spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert 100 < sum(w[1] > 0 for w in want) < 1500


def test_documents(spark, aligner):
    check(aligner, load(spark, FOLDER, "documents"))


def test_counts_over_many_blocks(spark, aligner, monkeypatch):
    """Blocks of a few texts each; a pair in several blocks is counted in all."""
    df = load(spark, FOLDER, "documents").filter("length(text) < 3000").repartition(7)
    assert len({r.block for r in alignment.blocks(df, A, B).select("block").collect()}) == 7
    check(aligner, df)


def test_no_rows(spark):
    assert alignment.align(no_documents(spark), A, B).collect() == []


def test_shared_group_links(aligner):
    (place,) = aligner.places([" internationalisation"]).tolist()
    (ids_a,), (ids_b,) = aligner.encode([" internationalisation"])
    sizes = [tuple(len(x.split(",")) for x in g.split("|")) for g in aligner.known.groups[place].split(";") if g]
    assert (sum(a for a, _ in sizes), sum(b for _, b in sizes)) == (len(ids_a), len(ids_b))
    n_a, n_b, n_groups, n_links, n_group_links = aligner.known.numbers[place]
    assert (n_a, n_b, n_groups) == (len(ids_a), len(ids_b), len(sizes))
    assert n_group_links == sum(a * b for a, b in sizes) >= n_links


def test_units_are_cut_where_both_cut():
    texts = ["", " a b  c", " ", "", " x", "  y z ", " é b 你 “ c", " s▁ t ▁ u\x7f v"]
    cut, ends = cut_units(texts)
    assert ["".join(cut.to_pylist()[i:j]) for i, j in zip([0, *ends], ends, strict=False)] == texts
    assert cut.to_pylist() == [" a", " b  c", " ", " x", "  y", " z ", " é", " b", " 你 “ c", " s▁ t ▁ u\x7f v"]


def test_a_small_table_gives_the_same(spark, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "JOINED_CHARS", 40)
    small = alignment.Aligner(A, B)
    texts = ["one two three", "one▁ two", "two  three ", "x" * 300 + " three one"]
    for _ in range(2):
        got = [alignment._block(small, 0, [1], [t])["known"] for t in texts]
        small.known.chars = 1 << 40  # emptied by the next block
    assert got == [alignment._block(aligner, 0, [1], [t])["known"] for t in texts]


def test_product_of_matrices():
    rng = np.random.default_rng(3)

    def compressed(dense):
        rows, cols = np.nonzero(dense)
        return Csr(np.concatenate([[0], np.cumsum((dense != 0).sum(1))]), cols, dense[rows, cols])

    def dense_of(m, n_cols):
        out = np.zeros((m.rows, n_cols), np.int64)
        np.add.at(out, (m.row_numbers(), m.cols), m.values)
        return out

    for _ in range(50):
        i, j, k = rng.integers(1, 8, 3)
        a, b = rng.integers(0, 3, (i, j)), rng.integers(0, 3, (j, k))
        got = product(compressed(a), compressed(b), k)
        assert (dense_of(got, k) == a @ b).all()
        assert (dense_of(compressed(b).transpose(k), j) == b.T).all()
    assert product(from_sizes(np.zeros(0, np.int64)), from_sizes(np.zeros(0, np.int64)), 0).rows == 0
