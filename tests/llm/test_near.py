"""Fingerprints, trie links, components, exact copies and quality rules against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import adaptive_rules, components, digest_index, queries, simhash
from millrace.session import fresh_path
from millrace.tables import SCHEMAS, load
from tests.llm.support import FOLDER, SCHEMA, no_documents, odd_documents
from tools.check import compare


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_pairs(values, errors=2):
    values = np.array(sorted(set(values)), np.uint64)
    return {(int(a), int(b)) for k, a in enumerate(values) for b in values[k + 1 :][np.bitwise_count(values[k + 1 :] ^ a) <= errors]}


def near_values(rng, n):
    """Fingerprints in crowds: random ones, and others a few bits away from them."""
    base = rng.integers(0, 2**64, n // 8, dtype=np.uint64)
    out = [base, np.array([0, 1, 3, 2**64 - 1, 2**63], np.uint64)]
    for _ in range(6):
        flips = np.uint64(1) << rng.integers(0, 64, len(base), dtype=np.uint64) | np.uint64(1) << rng.integers(0, 64, len(base), dtype=np.uint64)
        out.append(base ^ flips)
    crowd = np.uint64(0xABCDEF0123456789) ^ rng.integers(0, 2**20, n // 4, dtype=np.uint64)
    return np.unique(np.concatenate([*out, crowd]))


def test_walk_finds_every_close_pair():
    values = near_values(np.random.default_rng(5), 1200)
    x, y = simhash.walk_pair(values, values, True, 0, 0)
    found = list(zip(x.tolist(), y.tolist(), strict=True))
    assert len(found) == len(set(found)) and set(found) == close_pairs(values.tolist())


@pytest.mark.parametrize("limit", [40, 100_000])
def test_links_over_many_nodes(spark, limit):
    values = near_values(np.random.default_rng(6), 800)
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(fps, limit).collect()]
    assert len(found) == len(set(found))
    assert {(min(p), max(p)) for p in found} == close_pairs(values.tolist())


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5), (2000, 5)]
    edges += [(3000, 3000 + k) for k in range(1, 200)]
    got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    linked = {n for e in edges for n in e if e[0] != e[1]}
    expected = roots({n for e in edges for n in e}, edges)
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {n: expected[n] for n in linked}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates(spark):
    for docs in (load(spark, FOLDER, "documents"), odd_documents(spark)):
        rows = docs.select("doc_id", "text").collect()
        prints = [plain_fingerprint(r.text) for r in rows]
        classes = roots(set(prints), close_pairs(prints))
        least = defaultdict(list)
        for r, p in zip(rows, prints, strict=True):
            least[classes[p]].append(r.doc_id)
        name = {c: min((d for d in ids if d is not None), default=None) for c, ids in least.items()}
        expected = Counter((r.doc_id, f"{p:016x}", name[classes[p]]) for r, p in zip(rows, prints, strict=True))
        for limit in (16, 100_000):
            assert Counter(map(tuple, simhash.near_duplicates(docs, limit).collect())) == expected
        kept = simhash.one_of_each(docs)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(n for n in name.values() if n is not None)
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_null_and_repeated_ids_lose_no_component(spark):
    far = [" ".join(f"{w}{k}" for k in range(60)) for w in ("apple", "stone", "river", "cloud", "glass", "metal")]
    copy = far[3].upper()  # the same words and so the same fingerprint
    rows = [(None, far[0]), (None, far[1]), (None, far[1]), (7, far[2]), (7, far[3]), (3, copy), (8, far[4]), (8, far[4]), (8, far[0]), (None, far[5])]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], SCHEMA)
    kept = Counter((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect())
    assert kept == Counter([(8, far[0]), (None, far[1]), (7, far[2]), (3, copy), (8, far[4]), (None, far[5])])


def test_long_text_in_blocks(monkeypatch):
    text = "Some words are HERE, and more of them. " * 300 + "end"
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_groups(rows):
    groups = defaultdict(list)
    for k, (doc, text) in enumerate(rows):
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(bare.encode()).hexdigest()].append((-len(text or ""), doc is None, doc or 0, k, doc))
    return groups


def test_exact_copies(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = Counter()
    for sha, members in plain_groups(rows).items():
        first = min(members)
        for m in members:
            expected[m[4], first[4], len(members), m is first, sha] += 1
    got = digest_index.deduplicate(docs).drop("n_chars")
    assert Counter(map(tuple, got.collect())) == expected
    kept = digest_index.distinct(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(min(m)[4] for m in plain_groups(rows).values())
    assert digest_index.distinct(no_documents(spark)).count() == 0


def test_index_lasts_over_batches(spark):
    docs = load(spark, FOLDER, "documents")
    path = fresh_path(spark, "index")
    index = digest_index.DigestIndex.create(spark, path)
    first = docs.filter("doc_id % 2 = 0")
    once = sorted(map(tuple, index.add(first, "a").collect()))
    n = index.rows().count()
    assert sorted(map(tuple, index.add(first, "a").collect())) == once and index.rows().count() == n
    again = digest_index.DigestIndex.open(spark, path, index.buckets)
    second = again.add(docs, "b").collect()
    held = {r[4]: r[1] for r in once}
    assert all(not r.kept and r.keep_id == held[r.text_sha256] for r in second if r.text_sha256 in held)
    assert again.rows().count() == again.rows().select("digest").distinct().count() == docs.select(digest_index.digest_of(F.col("text"))).distinct().count()
    plan = docs.select(digest_index.digest_of(F.col("text")).alias("digest")).join(again.rows().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1


def test_an_index_keeps_its_bucket_number(spark, monkeypatch):
    monkeypatch.setattr(digest_index, "ROWS_PER_BUCKET", 10)
    path = fresh_path(spark, "index")
    docs = load(spark, FOLDER, "documents")
    index = digest_index.DigestIndex.create(spark, path)
    index.add(docs.filter("doc_id % 2 = 0"), "a")
    index.close()
    with pytest.raises(ValueError):
        digest_index.DigestIndex.open(spark, path, index.buckets + 8)
    again = digest_index.DigestIndex.open(spark, path)
    assert again.buckets == index.buckets == 8

    # a batch that fails before it is appended changes nothing, and a table that has grown gets more buckets
    before = again.rows().count()
    with monkeypatch.context() as m:
        m.setattr(digest_index.DigestIndex, "_append", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            again.add(docs, "b")
    assert again.rows().count() == before
    grown = again.rebucket()
    assert grown.buckets == -(-before // 10) > 8 and grown.rows().count() == before
    known = {bytes(r[0]) for r in grown.rows().select("digest").collect()}
    rows = grown.add(docs, "b").collect()
    assert not [r for r in rows if r.kept and bytes.fromhex(r.text_sha256) in known]
    assert len(rows) == docs.count() and sum(r.kept for r in rows) == grown.rows().count() - before
    grown.close()
    assert not [t for t in spark.catalog.listTables() if t.name in (index.table, again.table, grown.table)]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    n_symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts_and_cutoffs(spark, monkeypatch):
    monkeypatch.setattr(adaptive_rules, "LEAST_ROWS", 5)
    for docs in (load(spark, FOLDER, "documents"), odd_documents(spark)):
        rows = docs.select("doc_id", "text", "lang", "source").collect()
        report = adaptive_rules.quality_report(docs).collect()
        expected = Counter((r.doc_id, *plain_counts(r.text)) for r in rows)
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in report) == expected

        def cut(values, measure):
            v = sorted(x >> max(0, x.bit_length() - 6) << max(0, x.bit_length() - 6) for x in values)
            point = lambda p: v[-(-len(v) * p // 100) - 1]
            return point(50) + 4 * max(point(75) - point(50), adaptive_rules.FLOORS[measure])

        for r in report:
            for measure in adaptive_rules.FLOORS:
                for same in (("lang", "source"), ("lang",), ()):
                    group = [q[measure] for q in report if all(q[c] == r[c] for c in same)]
                    if len(group) >= 5 or not same:
                        break
                assert r[f"cut_{measure}"] == cut(group, measure)
            good = not r.base_failed and all(r[m] <= r[f"cut_{m}"] for m in adaptive_rules.FLOORS)
            assert r.kept == good
        kept = adaptive_rules.good_rows(docs)
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in report if r.kept)
    assert adaptive_rules.quality_report(no_documents(spark)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    result = con.execute(queries.oracle_sql()[name])
    verdict = compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in result.description], result.fetchall())
    assert verdict.startswith("ok"), verdict
    native = name.startswith(("op6_", "op10_"))  # these use DataFrame operations only
    assert not native or not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
