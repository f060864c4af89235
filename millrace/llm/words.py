"""Token ids of texts by way of their distinct words, for use inside tasks.

A byte-pair tokenizer works on each pre-token alone, so a text may be cut
wherever its pre-tokenizer always cuts, and each distinct piece encoded once
by the library. The cuts depend on the tokenizer's file:

* white space dropped and letters lower-cased: at ASCII white space, and
  between an ASCII letter and a following ``. , ! ? ; : % & $ * #`` (marks of
  special strings such as ``<|endoftext|>`` are not among these);
* byte-level with its usual pattern: before a run of non-space characters
  with at most one space in front, and around the white space between;
* others: no cut; the whole text is one piece.

The cuts, and the search for distinct pieces, run on whole Arrow columns; ids are
gathered by index arithmetic. Pieces are looked up in a table that is emptied when it is full, so memory is
bounded however many distinct words there are. Special strings inside a text
are handled by the library, as its default does.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import ChainMap
from collections.abc import Iterable
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTER_AND_MARK = "([a-z])([.,!?;:%&$*#])"
# White space as the byte-level pattern sees it (Unicode White_Space, without U+001C to U+001F).
SPACE_CLASS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUNS = re.compile(f" ?[^{SPACE_CLASS}]+|[{SPACE_CLASS}]+(?![^{SPACE_CLASS}])|[{SPACE_CLASS}]")

TABLE_PIECES = 800_000
WORDS_AT_ONCE = 32_768
LONGEST_KEPT = 64


def cutting(path: str) -> str:
    """Which cuts are safe for a tokenizer file: words, runs or whole."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normalizer, pre = json.dumps(spec.get("normalizer")), spec.get("pre_tokenizer") or {}
    if '"Lowercase"' in normalizer and "\\\\s+" in normalizer and '"Removed"' in json.dumps(pre):
        return "words"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and normalizer == "null":
        return "runs"
    return "whole"


def word_ends(path: str) -> np.ndarray | None:
    """Which ids end a word, where the model marks them."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    mark, vocab = model.get("end_of_word_suffix"), model["vocab"]
    if not mark:
        return None
    ends = np.zeros(max(vocab.values()) + 1024, bool)  # ids of added tokens follow those of the model
    ends[[k for token, k in vocab.items() if token.endswith(mark)]] = True
    return ends


class Pieces:
    """Ids of texts as little-endian unsigned 32-bit integers, or their number."""

    def __init__(self, path: str, table_pieces: int = TABLE_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task on each core
        from tokenizers import Tokenizer

        self.path, self.limit, self.cut = path, table_pieces, cutting(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.table: dict = {}
        special = [(t.content, k) for k, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special]
        self.ends = word_ends(path) if self.cut == "words" else None
        self.mark, self.mark_id = special[-1] if special and special[-1][0].startswith("<|") else (None, None)

    def cut_texts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts in one array, and the place after the last piece of each text."""
        if self.cut == "words":
            marked = [k for k, t in enumerate(texts) if "<|" in t]
            if marked:
                # Where a special string may stand its letters and edges must stay as they are.
                plain = [[p.decode() for p in t.encode().split()] if "<|" in t else self._words(pa.array([t])).flatten().to_pylist() for t in texts]
                return pa.array([p for ps in plain for p in ps], pa.string()), np.cumsum([len(ps) for ps in plain])
            words = self._words(pa.array(texts, pa.string()))
            return words.flatten(), words.offsets.to_numpy()[1:].astype(np.int64) - words.offsets[0].as_py()
        runs = [_RUNS.findall(t) if self.cut == "runs" and "<|" not in t else [t] for t in texts]
        return pa.array([r for rs in runs for r in rs], pa.string()), np.cumsum([len(rs) for rs in runs])

    @staticmethod
    def _words(texts: pa.Array) -> pa.ListArray:
        return pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), _LETTER_AND_MARK, r"\1 \2"))

    def _ids_of(self, names: list[str]) -> list[bytes]:
        """The ids of distinct pieces, from the table or the library; long ones are not kept."""
        table = self.table
        if len(table) > self.limit:
            table.clear()
        new = [n for n in names if n not in table]
        plain = [n for n in new if n.isalpha() and n.lower() == n and is_normalized("NFC", n)] if self.ends is not None else []
        found = dict(zip(plain, self._encode_plain(plain), strict=True))
        new = [n for n in new if n not in found]
        found.update(zip(new, self._encode_each(new), strict=True))
        rare = {n: ids for n, ids in found.items() if len(n) > LONGEST_KEPT}
        table.update(found)
        for n in rare:
            del table[n]
        found = ChainMap(rare, table) if rare else table
        return [found[n] for n in names]

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct pieces one after the other, their starts, and for each place its piece; the texts' ends in places."""
        pieces, ends = self.cut_texts([t or "" for t in texts])
        coded = pieces.dictionary_encode()
        parts = self._ids_of(coded.dictionary.to_pylist())
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4)])
        return np.frombuffer(b"".join(parts), "<u4"), starts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends

    def counts(self, texts: list[str | None], batch_bytes: int = 4 << 20) -> Iterable[int]:
        """The number of ids of each text, in order."""
        for part in by_size(texts, batch_bytes):
            _, starts, places, ends = self._encode(part)
            total = np.concatenate([[0], np.cumsum(np.diff(starts)[places])])
            yield from np.diff(total[np.concatenate([[0], ends])]).tolist()

    def ids(self, texts: list[str | None], batch_bytes: int = 4 << 20) -> Iterable[bytes]:
        """The ids of each text, in order; texts are worked on in batches of about ``batch_bytes`` characters."""
        for part in by_size(texts, batch_bytes):
            flat, starts, places, ends = self._encode(part)
            sizes = np.diff(starts)[places]
            total = np.concatenate([[0], np.cumsum(sizes)])
            # Every id's place in ``flat``: where its piece starts there, and how far it is into the piece.
            at = np.arange(total[-1]) + np.repeat(starts[places] - total[:-1], sizes)
            raw = flat[at].tobytes()
            edges = (4 * total[np.concatenate([[0], ends])]).tolist()
            for a, b in zip(edges, edges[1:], strict=False):
                yield raw[a:b]

    def _encode_plain(self, names: list[str]) -> Iterable[bytes]:
        """The ids of words of small letters alone, many at a time: the last id of each is one that ends a word."""
        for at in range(0, len(names), WORDS_AT_ONCE):
            part = names[at : at + WORDS_AT_ONCE]
            lots = [" ".join(part[k : k + 64]) for k in range(0, len(part), 64)]
            coded = self.tokenizer.encode_batch_fast(lots, add_special_tokens=False)
            flat = np.fromiter(chain.from_iterable(e.ids for e in coded), np.int64)
            stops = (4 * (np.flatnonzero(self.ends[flat]) + 1)).tolist()
            if len(stops) != len(part):
                yield from self._encode_each(part)
                continue
            raw, start = flat.astype("<u4").tobytes(), 0
            for stop in stops:
                yield raw[start:stop]
                start = stop

    def _encode_each(self, names: list[str]) -> Iterable[bytes]:
        """The ids of each piece.

        Words are encoded many at a time with a special string between them, whose
        id marks their ends; words that hold the beginning of one go by themselves.
        """
        joined = self.cut == "words" and self.mark is not None
        for at in range(0, len(names), 512):
            part = names[at : at + 512]
            if joined and not any("<|" in x for x in part):
                whole = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0].ids
                raw, start = array("I", whole), 0
                for _ in part[:-1]:
                    stop = raw.index(self.mark_id, start)
                    yield raw[start:stop].tobytes()
                    start = stop + 1
                yield raw[start:].tobytes()
            else:
                for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False):
                    yield array("I", e.ids).tobytes()


def by_size(texts: list[str | None], most: int) -> Iterable[list[str | None]]:
    """Consecutive texts in lists of about equal size; a longer text is a list of its own."""
    part, size = [], 0
    for t in texts:
        n = len(t or "")
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += n
    if part:
        yield part


_OPEN: dict[str, Pieces] = {}


def pieces_for(path: str) -> Pieces:
    """One table per Python worker and tokenizer, kept from task to task."""
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]
