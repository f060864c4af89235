"""Counts, ids, files, packing and byte pairs against the tokenizers library itself."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import byte_pairs, grammar_ids, packing, queries, token_counts
from millrace.llm.words import Pieces, pieces_for
from millrace.session import fresh_path
from millrace.tables import load
from tests.llm.support import FOLDER, ODD_TEXTS, no_documents, odd_documents

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def rows_of(df):
    return df.select("doc_id", "text").collect()


def packed_ids(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def test_counts_are_the_librarys(spark, word):
    for docs in (load(spark, FOLDER, "documents"), odd_documents(spark)):
        expected = Counter((r.doc_id, len((r.text or "").encode()), len(ids(word, r.text))) for r in rows_of(docs))
        got = token_counts.token_counts(docs, WORD).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == expected
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts.token_counts(no_documents(spark), WORD).count() == 0


def test_counts_of_other_kinds_of_tokenizers(spark, byte):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = odd_documents(spark)
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, BYTE).collect()} == {r.doc_id: len(ids(byte, r.text)) for r in rows_of(docs)}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, MODEL).collect()} == {r.doc_id: len(model.encode(r.text or "")) for r in rows_of(docs)}


ALPHABET = st.sampled_from(list("aAbtTsSe'.,!%&$*#|<> \n\t\r\x0b\x0c\x1c\x85\xa0éÉİßΣ1²你　​😀"))


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=30) | st.text(max_size=20))
def test_any_text_is_cut_as_the_library_cuts(text):
    for path, kind in ((WORD, "words"), (BYTE, "runs")):
        pieces = pieces_for(path)
        assert pieces.cut == kind
        assert np.frombuffer(next(iter(pieces.ids([text]))), "<u4").tolist() == ids(pieces.tokenizer, text)
    coder = byte_pairs.byte_pairs(BYTE)
    found = next(iter(coder.encode([text]))).tolist()
    assert found == ids(pieces.tokenizer, text)
    assert coder.decode(found) == pieces.tokenizer.decode(found, skip_special_tokens=False)



def test_a_full_table_is_emptied():
    small, large = Pieces(WORD, table_pieces=5), Pieces(WORD)
    texts = [t for t in ODD_TEXTS if t] * 2
    assert list(small.ids(texts, 50)) == list(large.ids(texts))


def test_guess_and_check_on_all_words(byte):
    coder = byte_pairs.BytePairs(BYTE)
    rng = np.random.default_rng(1)
    some = [coder.bytes[k] for k in rng.integers(0, 50000, 3000)]
    words = [a + b + c for a, b, c in zip(some, some[1:], some[2:], strict=False)]
    assert [list(np.frombuffer(ids, "<i4")) for ids in coder.encode_words(words)] == [coder.exact(w) for w in words]
    assert 0 < coder.failed < coder.checked
    left, right = rng.integers(0, 50000, 20000), rng.integers(0, 50000, 20000)
    known = np.array([k in set(coder.guess.values()) for k in range(50257)])
    both = known[left] & known[right]
    left, right = left[both], right[both]
    truth = [coder.exact(coder.bytes[a] + coder.bytes[b]) == [a, b] for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    assert coder.compatible(left, right).tolist() == truth
    for w in (b"a" * 5000, b"abc" * 2000, " 你好".encode() * 500):
        assert coder.exact(w) == byte.encode(w.decode(), add_special_tokens=False).ids


def test_byte_pairs_round_trip(spark, byte):
    for docs in (load(spark, FOLDER, "documents"), odd_documents(spark)):
        expected = Counter()
        for r in rows_of(docs):
            found = ids(byte, r.text)
            text = byte.decode(found, skip_special_tokens=False)
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, found)), text)]
            expected[r.doc_id, len(found), *sha] += 1
        assert Counter(map(tuple, byte_pairs.round_trip(docs, BYTE).collect())) == expected
    docs = odd_documents(spark)
    encoded = byte_pairs.encode_documents(docs, BYTE)
    back = byte_pairs.decode_documents(encoded, BYTE).collect()
    assert Counter((r.doc_id, r.text or "") for r in back) == Counter((r.doc_id, r.text or "") for r in rows_of(docs))
    assert byte_pairs.round_trip(no_documents(spark), BYTE).count() == 0


def test_blocks_decode_whole_and_in_part():
    rng = np.random.default_rng(3)
    docs = [rng.choice([5, 6, 7, 8, 49405], p=[0.4, 0.3, 0.2, 0.05, 0.05], size=n).astype("<u4").tobytes() for n in (1, 3000, 1, 777, 20000)]
    payload = grammar_ids.write_block([3, None, 5, 5, -2], docs)
    block = grammar_ids.Block(payload)
    flat = np.frombuffer(b"".join(docs), "<u4")
    assert block.doc_ids == [3, None, 5, 5, -2]
    assert (block.ids() == flat).all() and len(payload) < flat.nbytes / 3
    for k, d in enumerate(docs):
        assert block.document(k).astype("<u4").tobytes() == d
    for a, b in rng.integers(0, len(flat) + 1, (200, 2)):
        assert (block.range(a, b) == flat[a:b]).all()


def test_file_of_ids(spark, word, monkeypatch):
    for docs, shard_bytes in ((load(spark, FOLDER, "documents"), 50_000), (odd_documents(spark), 20_000)):
        monkeypatch.setattr(grammar_ids, "SHARD_BYTES", shard_bytes)
        path = fresh_path(spark, "ids")
        grammar_ids.write_ids(docs, path, WORD, 2)
        assert spark.read.parquet(path).select("shard").distinct().count() > 2
        got = grammar_ids.read_documents(spark, path, with_ids=True).orderBy("start").collect()
        assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows_of(docs)), key=lambda d: (d is not None, d))
        at = 0
        for r in got:
            assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), packed_ids(r.ids))
            at += r.n_tokens
        expected = Counter((r.doc_id, tuple(ids(word, r.text) + [2])) for r in rows_of(docs))
        assert Counter((r.doc_id, tuple(r.ids)) for r in got) == expected
    path = fresh_path(spark, "ids")
    grammar_ids.write_ids(no_documents(spark), path, WORD, 2)
    assert grammar_ids.read_documents(spark, path).count() == 0


def check_packing(rows, capacity=4096):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, word, monkeypatch):
    for docs, each in ((load(spark, FOLDER, "documents"), 10**6), (odd_documents(spark), 10)):
        monkeypatch.setattr(packing, "PIECES_PER_TASK", each)
        got = packing.pack_documents(docs, WORD).collect()
        expected = Counter()
        for r in rows_of(docs):
            found = ids(word, r.text) + [1]
            for k in range(0, len(found), 4096):
                part = found[k : k + 4096]
                expected[r.doc_id, k // 4096, k, len(part), packed_ids(part)] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
        used = check_packing(got)
        if each > 10:
            assert used <= 1.02 * sum(r.length for r in got) / 4096 + 1
    assert packing.pack_documents(no_documents(spark), WORD).count() == 0
    whole = packing.sequences(odd_documents(spark), WORD).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(ids(word, r.text)) + 1 for r in rows_of(odd_documents(spark)))


def test_words_that_change_when_lowered_or_composed(word):
    """Letters whose lower case or composed form is several characters, and others that never are words of letters alone."""
    letters = ["a", "Z", "\u0130", "e\u0301", "\u00df", "\u1e9e", "\ufb01", "\u01c5", "\u02b0", "\uac00", "\u1100\u1161", "\u00aa", "\u2177", "\u212b", "\u2126", "\ufdfa", "\u0915\u093f"]
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(letters, rng.integers(1, 7))) for _ in range(rng.integers(1, 9))) for _ in range(2000)]
    pieces = Pieces(WORD, table_pieces=500)
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.ids(texts, 20_000)] == [ids(word, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 5))
def test_bins_are_the_best_fitting_of_those_open(lengths, most):
    bins, free, order = packing.Bins(50, most), {}, 0
    for n in lengths:
        which, offset = bins.add(n)
        fits = [f for f in free.values() if f >= n]
        if fits:
            assert free[which] == min(fits) and offset == 50 - free[which]
        else:
            assert which == order and offset == 0
            order += 1
            free[which] = 50
            if n < 50 and len(free) > most:
                # of equally full bins the one that was used last
                used = {k: place for place, k in enumerate(free)}
                del free[min((k for k in free if k != which), key=lambda k: (free[k], -used[k]))]
        free[which] = free.pop(which) - n
        if not free[which]:
            del free[which]
        assert len(free) == bins.open and Counter(free.values()) == Counter({f: len(b) for f, b in enumerate(bins.at) if b})


@pytest.mark.parametrize("name", ["op4_grammar_ids", "op7_token_counts", "op8_guess_and_check", "op9_best_fit"])
def test_queries_cover_all_documents(spark, name):
    found = queries.queries()[name](spark, FOLDER)
    assert found.select("doc_id").distinct().count() == load(spark, FOLDER, "documents").count()
