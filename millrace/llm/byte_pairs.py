"""Byte-level byte-pair encoding by guess and check, and its decoding.

A distinct word is first cut greedily into the longest tokens. That guess is what
merging would give if no two neighbours could have merged otherwise, which is
checked for all neighbours of all new words of a batch at once: undo the merges
at the border of two tokens, the latest first, and see whether an earlier merge
across the border was possible. Only words that fail are merged step by step.

Texts are cut into units at single spaces, each distinct unit into runs of non-space
characters, whose results are kept in a bounded table, and these by the
tokenizer's pattern into words. Special strings
inside a text get their own id, as the library's default has it.

Defined results: a null text is an empty one, with no ids. Repeated rows are
encoded each for itself. Bytes that are no text are decoded to U+FFFD. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import ChainMap
from collections.abc import Iterable, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.common import map_batches
from millrace.llm.cuts import cut_units
from millrace.llm.words import _RUNS, SPACE_CLASS, by_size

_WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE_CLASS}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE_CLASS}]+(?![^{SPACE_CLASS}])|[{SPACE_CLASS}]+"
)
TABLE_RUNS = 500_000
LONGEST_KEPT = 64
NEVER_INT = 1 << 40
NEVER = np.int64(NEVER_INT)


def byte_letters() -> dict[str, int]:
    """The published byte alphabet of byte-level tokenizers: printable bytes stand for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class BytePairs:
    """Vocabulary, merges and the bounded table of one tokenizer file."""

    def __init__(self, path: str, table_runs: int = TABLE_RUNS) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        model, vocab = spec["model"], spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.bytes[k] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, k in self.special.items():
            self.bytes[k] = content.encode()
        self._special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Tokens by the order of their merge: single bytes first, then merge k at 256 + k.
        self.of_byte = {self.bytes[k]: k for k in vocab.values() if len(self.bytes[k]) == 1}
        self.order = np.full(size, -1, np.int64)
        self.order[list(self.of_byte.values())] = 0
        self.halves = np.full((size, 2), -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for k, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            made = vocab["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")]
            self.merge.setdefault((a, b), (k + 1, made))
            if self.order[made] < 0:
                self.order[made], self.halves[made] = k + 1, (a, b)
        keys = np.array([a << 32 | b for a, b in self.merge], np.int64)
        at = np.argsort(keys)
        self.pair_keys, self.pair_order = keys[at], np.array([r for r, _ in self.merge.values()], np.int64)[at]
        self.pair_made = np.array([k for _, k in self.merge.values()], np.int64)[at]
        # A token may be guessed only if merging its own bytes gives it.
        many = [k for k in vocab.values() if len(self.bytes[k]) > 1 and self.order[k] > 0]
        merged = self.exact_many([self.bytes[k] for k in many])
        self.guess = {self.bytes[k]: k for k in self.of_byte.values()} | {self.bytes[k]: k for k, ids in zip(many, merged, strict=True) if ids == k.to_bytes(4, "little")}
        self.trie()
        self.limit = table_runs
        self.table: dict[str, bytes] = {}  # packed ids, which Python's collector need not follow
        self.checked = self.failed = 0

    # --- one word ---

    def exact(self, word: bytes) -> list[int]:
        """The word's tokens by merging, always the earliest merge that is possible, from the left."""
        ids = [self.of_byte[word[i : i + 1]] for i in range(len(word))]
        if len(ids) > 256:
            return self._exact_long(ids)
        find, none = self.merge.get, (NEVER_INT, 0)
        # The merge of each neighbouring pair; only the two beside a merge change.
        found = [find(p, none) for p in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best[0] == NEVER_INT:
                break
            i = found.index(best)
            ids[i] = best[1]
            del ids[i + 1], found[i]
            if i < len(found):
                found[i] = find((ids[i], ids[i + 1]), none)
            if i:
                found[i - 1] = find((ids[i - 1], ids[i]), none)
        return ids

    def exact_many(self, words: list[bytes]) -> list[bytes]:
        """The same for many words, as packed 32-bit ids: in each step every word that can does its earliest merge."""
        byte_ids = np.array([self.of_byte.get(bytes([b]), -1) for b in range(256)], np.int64)
        ids = byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        out = [b""] * len(words)
        order = self._order_of(ids[:-1], ids[1:], owner[1:] == owner[:-1])
        while len(ids):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(order, first)
            sizes = np.diff(np.append(first, len(ids)))
            done = least == NEVER
            if done.any():
                gone = np.repeat(done, sizes)
                flat, ends = ids[gone].astype("<i4").tobytes(), (4 * np.cumsum(sizes[done])).tolist()
                for k, i, j in zip(owner[first[done]].tolist(), [0, *ends], ends, strict=False):
                    out[k] = flat[i:j]
                ids, owner, order = ids[~gone], owner[~gone], order[~gone]
                continue
            best = np.flatnonzero(order == np.repeat(least, sizes))
            best = best[np.diff(owner[best], prepend=-1) > 0]  # the leftmost of each word
            ids[best] = self.pair_made[np.searchsorted(self.pair_keys, ids[best] << 32 | ids[best + 1])]
            stay = np.ones(len(ids), bool)
            stay[best + 1] = False
            now = best - np.arange(len(best))  # the places after as many merges before them
            ids, owner, order = ids[stay], owner[stay], order[stay]
            for side in (now - 1, now):
                side = side[side >= 0]
                right = np.minimum(side + 1, len(ids) - 1)
                order[side] = self._order_of(ids[side], ids[right], (owner[side] == owner[right]) & (side < right))[:-1]
        return out

    def _order_of(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """The order of the merge of each pair, NEVER where there is none, and one NEVER more at the end."""
        keys = left << 32 | right
        place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.append(np.where(joined & (self.pair_keys[place] == keys), self.pair_order[place], NEVER), NEVER)

    def _exact_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for words of any length."""
        import heapq

        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(self.merge[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merge]
        heapq.heapify(heap)
        alive = [True] * len(ids)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or (ids[i], ids[j]) != p:
                continue
            ids[i], alive[j], after[i] = self.merge[p][1], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (q := (ids[x], ids[y])) in self.merge:
                    heapq.heappush(heap, (self.merge[q][0], x, q))
        return [t for t, live in zip(ids, alive, strict=True) if live]

    def trie(self) -> None:
        """The guessable tokens by their bytes: children of a node by ``node * 256 + byte``, and the token that ends at each node."""
        child: dict[int, int] = {}
        ends = [-1]
        for token, k in self.guess.items():
            node = 0
            for byte in token:
                key = node * 256 + byte
                node = child.get(key, 0)
                if not node:
                    node = child[key] = len(ends)
                    ends.append(-1)
            ends[node] = k
        keys = np.fromiter(child, np.int64, len(child))
        order = np.argsort(keys)
        self.trie_keys, self.trie_nodes = keys[order], np.fromiter(child.values(), np.int64, len(child))[order]
        self.trie_ends = np.array(ends, np.int64)

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place of all words, going down the trie for all of them at once: tokens and their number by word."""
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.concatenate([[0], stops[:-1]])
        live, owners, tokens = np.flatnonzero(at < stops), [], []
        while len(live):
            place, node = at[live], np.zeros(len(live), np.int64)
            best, best_end = np.full(len(live), -1, np.int64), place.copy()
            on = np.arange(len(live))
            while len(on):
                key = node[on] * 256 + data[place[on]]
                found = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
                hit = self.trie_keys[found] == key
                on = on[hit]
                node[on] = self.trie_nodes[found[hit]]
                place[on] += 1
                token = self.trie_ends[node[on]]
                whole = on[token >= 0]
                best[whole], best_end[whole] = token[token >= 0], place[whole]
                on = on[place[on] < stops[live[on]]]
            owners.append(live)
            tokens.append(best)
            at[live] = best_end
            live = live[at[live] < stops[live]]
        if not owners:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate(owners)
        return np.concatenate(tokens)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    # --- all neighbours at once ---

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of left and right together leaves them two tokens."""
        good = np.ones(len(left), bool)
        at, a, b = np.arange(len(left)), left.astype(np.int64), right.astype(np.int64)
        # Merges of this order and later are done too late to cross the border.
        limit = np.full(len(left), NEVER)
        while len(at):
            keys = a << 32 | b
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            across = np.where(self.pair_keys[place] == keys, self.pair_order[place], NEVER)
            wrong = across < limit
            good[at[wrong]] = False
            oa, ob = self.order[a], self.order[b]
            go_on = ~wrong & ((oa > 0) | (ob > 0))
            at, a, b, oa, ob = (v[go_on] for v in (at, a, b, oa, ob))
            # Undo the later merge; of the same merge on both sides the left one is done first.
            undo_left = oa > ob
            limit = np.where(undo_left, oa, ob + 1)
            a, b = np.where(undo_left, self.halves[a, 1], a), np.where(undo_left, b, self.halves[b, 0])
        return good

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word: guessed, checked together, merged exactly where the check fails."""
        flat, sizes = self.greedy(words)
        owner = np.repeat(np.arange(len(words)), sizes)
        again = np.zeros(0, np.int64)
        if len(flat) > 1:
            inner = owner[1:] == owner[:-1]
            codes = np.sort(flat[:-1][inner] << 32 | flat[1:][inner])
            pairs = codes[np.diff(codes, prepend=-1) != 0]
            good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
            bad = ~good[np.searchsorted(pairs, flat[:-1][inner] << 32 | flat[1:][inner])]
            again = owner[1:][inner][bad]
            again = again[np.diff(again, prepend=-1) != 0]
        self.checked, self.failed = self.checked + len(words), self.failed + len(again)
        ids, ends = flat.astype("<i4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        out = [ids[i:j] for i, j in zip([0, *ends], ends, strict=False)]
        short = [k for k in again.tolist() if len(words[k]) <= 256]
        for k, exact in zip(short, self.exact_many([words[k] for k in short]), strict=True):
            out[k] = exact
        for k in again.tolist():
            if len(words[k]) > 256:
                out[k] = array("i", self.exact(words[k])).tobytes()
        return out

    # --- texts ---

    def runs(self, text: str) -> list[str]:
        if self._special_split is None or "<" not in text:
            return _RUNS.findall(text)
        out: list[str] = []
        for k, part in enumerate(self._special_split.split(text)):
            # A special string is marked by a letter that no run begins with.
            out += ["\x00" + part] if k % 2 else _RUNS.findall(part)
        return out

    def learn(self, runs: Iterable[str]) -> Mapping[str, bytes]:
        """The packed ids of runs, by the table, which has the new ones from now on; long ones are not kept."""
        table = self.table
        if len(table) > self.limit:
            table.clear()
        names = [r for r in dict.fromkeys(runs) if r not in table]
        special = {n: self.special[n[1:]].to_bytes(4, "little") for n in names if n[0] == "\x00" and n[1:] in self.special}
        cut = {n: _WORDS.findall(n) for n in names if n not in special}
        words = [w for w in dict.fromkeys(chain.from_iterable(cut.values())) if w not in table]
        fresh = dict(zip(words, self.encode_words([w.encode() for w in words]), strict=True))
        kept = {w: ids for w, ids in fresh.items() if len(w) <= LONGEST_KEPT}
        rare = special if len(kept) == len(fresh) else special | fresh
        table.update(kept)
        known = ChainMap(rare, table) if rare else table
        joined = {n: b"".join([known[w] for w in c]) for n, c in cut.items() if len(c) > 1}
        table.update((n, ids) for n, ids in joined.items() if len(n) <= LONGEST_KEPT)
        rare = rare | {n: ids for n, ids in joined.items() if len(n) > LONGEST_KEPT}
        return ChainMap(rare, table) if rare else table

    def encode(self, texts: list[str | None], batch_chars: int = 4 << 20) -> Iterable[np.ndarray]:
        """The ids of each text, in order: those of its distinct units are found once and gathered."""
        for part in by_size(texts, batch_chars):
            units, ends = cut_units([t or "" for t in part])
            coded = units.dictionary_encode()
            cut = [self.runs(u) for u in coded.dictionary.to_pylist()]
            table = self.learn(chain.from_iterable(cut))
            each = [table[c[0]] if len(c) == 1 else b"".join([table[r] for r in c]) for c in cut]
            starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) // 4)])
            flat = np.frombuffer(b"".join(each), "<i4")
            places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(starts)[places]
            total = np.concatenate([[0], np.cumsum(sizes)])
            ids = flat[np.arange(total[-1]) + np.repeat(starts[places] - total[:-1], sizes)]
            yield from np.split(ids, total[ends[:-1]])

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_OPEN: dict[str, BytePairs] = {}


def byte_pairs(path: str) -> BytePairs:
    """One table per Python worker and tokenizer."""
    if path not in _OPEN:
        _OPEN[path] = BytePairs(path)
    return _OPEN[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of every row of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            found = list(byte_pairs(path).encode(batch.column("text").to_pylist()))
            ends = np.cumsum([0, *map(len, found)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found or [np.empty(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with ``ids``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = [byte_pairs(path).decode(ids.as_py() or []) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them, in one pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        coder = byte_pairs(path)
        decimal = np.array([b"%d" % k for k in range(len(coder.bytes))], object)
        token = np.array([*coder.bytes, b""], object)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for ids in coder.encode(batch.column("text").to_pylist()):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b",".join(decimal[ids].tolist())).hexdigest())
                text = b"".join(token[ids].tolist()).decode("utf-8", "replace")
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
