"""Alignment of two tokenizers over the same bytes, by products of incidence matrices.

A is a byte-level tokenizer that sees a space and the text, B a SentencePiece
model that adds the space itself. A text is cut into units where both always
cut: before a single space between two characters that are no white space. Each
distinct unit is encoded once, many in one text, as their ends are cuts too; a
bounded table keeps what is known of them. Over the bytes of all units

* ``A`` and ``B`` have a row per token and a column per byte, in compressed rows;
* A·Bᵀ, row by row, links the tokens that overlap (values: shared bytes);
* with ``G`` a row per token and a column per group, G_A·G_Bᵀ links the tokens
  of the same group (groups end where tokens of both end);
* texts x units times units x id pairs gives how often each text holds each pair.

First pass: every block of texts becomes one row of a staged table, with its
distinct id pairs, its texts x pairs matrix and what is known of each text. The
pairs are counted over all blocks by one grouped sum. Second pass: the counts of
a block's own pairs are joined to it (never the table of all pairs) and a
matrix-vector product gives the sums per text.

Defined results: null and empty texts, and texts whose tokens of either side don't
spell a space and the text (a text with U+2581, for one), have no tokens, zeros
and an empty digest. A unit that doesn't spell itself has its text encoded whole to
decide. A null id stays null. Repeated rows are documents of their own, in the
counts too. A long text without spaces is one unit and held whole, as any text
is. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, stage
from millrace.llm.cuts import SAFE, cut_units
from millrace.llm.sparse import Csr, from_sizes, product
from millrace.llm.words import by_size

_REGULAR = re.compile(f" {SAFE}(?:.*{SAFE})?", re.DOTALL)
BLOCK_CHARS = 8 << 20
#: Units are encoded this many characters at a time.
JOINED_CHARS = 1 << 16
PART_CHARS = 1 << 19
#: The table of units is emptied when it holds more characters.
TABLE_CHARS = 3 << 20

NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")
BLOCK = (
    "block bigint, doc_id array<bigint>, known array<struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,n_group_links:bigint,groups_sha256:string>>, "
    "pair_a array<int>, pair_b array<int>, pair_docs array<int>, starts binary, cols binary, times binary"
)
DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, n_group_links bigint"


def _byte_of_letter() -> dict[str, int]:
    """The byte alphabet of byte-level tokenizers: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Known:
    """What is known of units, as columns: whether they are spelled, five numbers, their links and their groups as text."""

    def __init__(self) -> None:
        self.place: dict = {}
        self.chars = 0
        self.good = np.zeros(0, bool)
        self.numbers = np.zeros((0, len(NUMBERS)), np.int64)
        self.links = Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.groups: list[str] = []

    def add(self, names: list, good: np.ndarray, numbers: np.ndarray, links: Csr, groups: list[str]) -> None:
        first = len(self.groups)
        self.place.update(zip(names, range(first, first + len(names)), strict=True))
        self.good = np.concatenate([self.good, good])
        self.numbers = np.concatenate([self.numbers, numbers])
        starts = np.concatenate([self.links.starts, self.links.starts[-1] + links.starts[1:]])
        self.links = Csr(starts, np.concatenate([self.links.cols, links.cols]), np.concatenate([self.links.values, links.values]))
        self.groups += groups
        self.chars += sum(map(len, names))


class Aligner:
    """Both tokenizers with the bytes of their entries, and a bounded table of units."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_of_letter()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        entries = {k: bytes(letters[c] for c in t) for t, k in spec["model"]["vocab"].items()}
        entries |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.bytes_a = [entries.get(k, b"") for k in range(max(entries) + 1)]
        self.bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # the entries' bytes one after the other, and the ids as text with what follows them in a group
        self.flat_bytes = [from_bytes(x) for x in (self.bytes_a, self.bytes_b)]
        self.text = {
            (side, mark): np.array([f"{k}{mark}" for k in range(n)], object) for side, n in (("a", len(self.size_a)), ("b", len(self.size_b))) for mark in (",", "|" if side == "a" else ";")
        }
        self.known = Known()

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def encode(self, spaced: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for texts that begin with the space that B adds by itself."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        return ids_a, self.b.encode([s[1:] for s in spaced], num_threads=1)

    def spells(self, spaced: str, ids_a: list[int], ids_b: list[int]) -> bool:
        own = spaced.encode()
        return b"".join(map(self.bytes_a.__getitem__, ids_a)) == own == b"".join(map(self.bytes_b.__getitem__, ids_b))

    def _spelled(self, side: int, ids: np.ndarray, ends: np.ndarray, own: np.ndarray, own_ends: np.ndarray) -> np.ndarray:
        """Which of the texts, that lie one after the other in ``own``, have tokens (up to ``ends``) that spell them."""
        of_ids = self.flat_bytes[side]
        sizes = np.diff(of_ids.starts)[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        edges = total[np.concatenate([[0], ends])]
        good = np.diff(edges) == np.diff(np.concatenate([[0], own_ends]))
        if not good.all():
            return good  # lengths differ: the caller looks at the others without these
        at = np.arange(total[-1]) + np.repeat(of_ids.starts[ids] - total[:-1], sizes)
        wrong = np.flatnonzero(of_ids.cols[at] != own)
        good[np.searchsorted(own_ends, wrong, side="right")] = False
        return good

    def _encoded(self, texts: list[str], units: list[list[str]]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
        """Which texts both sides spell with their units' ends kept; ids of A and B and the units' ends in bytes, of those."""
        ids_a, ids_b = self.encode(texts)
        keep = list(range(len(texts)))
        while keep:
            own = "".join([texts[k] for k in keep]).encode()
            sizes = [[len(u.encode()) for u in units[k]] for k in keep]
            own_ends, unit_ends = np.cumsum([sum(x) for x in sizes]), np.cumsum([n for x in sizes for n in x])
            flat = [np.fromiter(chain.from_iterable(ids[k] for k in keep), np.int64) for ids in (ids_a, ids_b)]
            good = np.ones(len(keep), bool)
            for side, ids in enumerate((ids_a, ids_b)):
                ends = np.cumsum([len(ids[k]) for k in keep])
                good &= self._spelled(side, flat[side], ends, np.frombuffer(own, np.uint8), own_ends)
                if good.all():
                    hit = np.isin(unit_ends, np.cumsum((self.size_a, self.size_b)[side][flat[side]]))
                    good[np.searchsorted(own_ends, unit_ends[~hit])] = False
            if good.all():
                return keep, flat[0], flat[1], unit_ends
            keep = [k for k, g in zip(keep, good, strict=True) if g]
        none = np.zeros(0, np.int64)
        return [], none, none, none

    def align(self, names: list, spaced: list[str]) -> None:
        """Add units to what is known: all that can be are encoded together, the others one by one."""
        regular = [k for k, u in enumerate(spaced) if _REGULAR.fullmatch(u)]
        alone = sorted(set(range(len(spaced))) - set(regular))
        lots, size = [[]], 0
        for k in regular:
            if size > JOINED_CHARS:
                lots.append([])
                size = 0
            lots[-1].append(k)
            size += len(spaced[k])
        lots = [lot for lot in lots if lot]
        alone += [k for lot in self._in_parts(names, spaced, lots) for k in lot]
        bad = [k for lot in self._in_parts(names, spaced, [[k] for k in alone]) for k in lot]
        empty = Csr(np.zeros(len(bad) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.known.add([names[k] for k in bad], np.zeros(len(bad), bool), np.zeros((len(bad), len(NUMBERS)), np.int64), empty, [""] * len(bad))

    def _in_parts(self, names: list, spaced: list[str], lots: list[list[int]]) -> list[list[int]]:
        """Align the lots, a bounded number of characters at once; gives those that couldn't be."""
        left, part, size = [], [], 0
        for lot in [*lots, None]:
            if part and (lot is None or size > PART_CHARS):
                done = self._align(names, spaced, part)
                left += [x for j, x in enumerate(part) if j not in done]
                part, size = [], 0
            if lot is not None:
                part.append(lot)
                size += sum(len(spaced[k]) for k in lot)
        return left

    def _align(self, names: list, spaced: list[str], lots: list[list[int]]) -> set[int]:
        """Align lots of units, each encoded as one text; gives the lots that could be."""
        units = [[spaced[k] for k in lot] for lot in lots]
        keep, flat_a, flat_b, unit_ends = self._encoded(["".join(u) for u in units], units)
        if not keep:
            return set()
        a, b = from_sizes(self.size_a[flat_a]), from_sizes(self.size_b[flat_b])
        overlap = product(a, b.transpose(b.starts[-1]), len(flat_b))
        # A group ends at every byte where a token of A and one of B end.
        ends = np.intersect1d(a.starts[1:], b.starts[1:], assume_unique=True)
        group_a, group_b = np.searchsorted(ends, a.starts[1:]), np.searchsorted(ends, b.starts[1:])
        one = lambda g: Csr(np.arange(len(g) + 1), g, np.ones(len(g), np.int64))
        shared = product(one(group_a), one(group_b).transpose(len(ends)), len(flat_b))
        n = len(unit_ends)
        unit_a, unit_b = np.searchsorted(unit_ends, a.starts[1:]), np.searchsorted(unit_ends, b.starts[1:])
        of_group, of_link = np.searchsorted(unit_ends, ends), unit_a[overlap.row_numbers()]
        counted = (unit_a, unit_b, of_group, of_link, unit_a[shared.row_numbers()])
        numbers = np.stack([np.bincount(x, minlength=n) for x in counted], 1)
        codes = flat_a[overlap.row_numbers()] * len(self.size_b) + flat_b[overlap.cols]
        links = Csr(np.concatenate([[0], np.cumsum(numbers[:, 3])]), codes, np.ones(len(codes), np.int64))
        # each id with the sign that follows it, those of A before those of B in a group
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        signs = [np.where(last_a, self.text["a", "|"][flat_a], self.text["a", ","][flat_a]), np.where(last_b, self.text["b", ";"][flat_b], self.text["b", ","][flat_b])]
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        pieces = np.concatenate(signs)[order].tolist()
        whole = "".join(pieces)
        edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))])
        stops = edges[np.cumsum(numbers[:, 0] + numbers[:, 1])].tolist()
        groups = [whole[i:j] for i, j in zip([0, *stops], stops, strict=False)]
        self.known.add([names[k] for lot in keep for k in lots[lot]], np.ones(n, bool), numbers, links, groups)
        return set(keep)

    def places(self, names: list[str]) -> np.ndarray:
        """Where each unit stands in what is known, after aligning the new ones."""
        place = self.known.place
        new = [u for u in names if u not in place]
        if new:
            self.align(new, new)
        return np.fromiter(map(place.__getitem__, names), np.int64, len(names))


def from_bytes(entries: list[bytes]) -> Csr:
    """Entries one after the other, their bytes as columns."""
    flat = np.frombuffer(b"".join(entries), np.uint8)
    return Csr(np.concatenate([[0], np.cumsum([len(x) for x in entries])]), flat, flat)


_OPEN: dict[tuple[str, str], Aligner] = {}


def aligner_for(path_a: str, path_b: str) -> Aligner:
    """One per Python worker and pair of tokenizers, kept from task to task."""
    key = (path_a, path_b)
    if key not in _OPEN:
        _OPEN[key] = Aligner(path_a, path_b)
    return _OPEN[key]


def _sums(of: Csr, values: np.ndarray) -> np.ndarray:
    """Matrix times vector."""
    total = np.concatenate([[0], np.cumsum(of.values * values[of.cols])])
    return total[of.starts[1:]] - total[of.starts[:-1]]


def _of_texts(aligner: Aligner, texts: list[str | None]) -> Csr:
    """Texts x known units, an entry per unit in its order; texts that aren't spelled have none."""
    if aligner.known.chars > TABLE_CHARS:
        aligner.known = Known()
    full = [k for k, t in enumerate(texts) if t]
    units, ends = cut_units([" " + texts[k] for k in full])
    coded = units.dictionary_encode()
    names = coded.dictionary.to_pylist()
    cols = aligner.places(names)[coded.indices.to_numpy(zero_copy_only=False)]
    sizes = np.zeros(len(texts), np.int64)
    sizes[full] = np.diff(ends, prepend=0)
    of = Csr(np.concatenate([[0], np.cumsum(sizes)]), cols, np.ones(len(cols), np.int64))
    unsure = np.unique(of.row_numbers()[~aligner.known.good[of.cols]]).tolist()
    if not unsure:
        return of
    whole = [(texts[k],) for k in unsure]  # a name that no unit has
    new = [w for w in dict.fromkeys(whole) if w not in aligner.known.place]
    for w in new:
        aligner._align([w], [" " + w[0]], [[0]])
    rows = [of.cols[i:j].tolist() for i, j in zip(of.starts, of.starts[1:], strict=False)]
    for k, w in zip(unsure, whole, strict=True):
        rows[k] = [aligner.known.place[w]] if w in aligner.known.place else []
    cols = np.array([c for r in rows for c in r], np.int64)
    return Csr(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), cols, np.ones(len(cols), np.int64))


def _block(aligner: Aligner, number: int, doc_ids: list[int | None], texts: list[str | None]) -> dict:
    of = _of_texts(aligner, texts)
    known, width = aligner.known, len(aligner.size_b)
    used, cols = np.unique(of.cols, return_inverse=True)
    of = Csr(of.starts, cols, of.values)
    sizes = known.links.sizes()[used]
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(total[-1]) + np.repeat(known.links.starts[used] - total[:-1], sizes)
    pairs, pair = np.unique(known.links.cols[at], return_inverse=True)
    of_pairs = product(of, Csr(total, pair, np.ones(len(pair), np.int64)), len(pairs))
    numbers = np.stack([_sums(of, known.numbers[used, c]) for c in range(len(NUMBERS))], 1).tolist()
    parts, edges, places = [known.groups[k] for k in used.tolist()], of.starts.tolist(), of.cols.tolist()
    facts = []
    for n, a, b in zip(numbers, edges, edges[1:], strict=False):
        digest = hashlib.sha256("".join([parts[c] for c in places[a:b]])[:-1].encode()).hexdigest() if n[0] else ""
        facts.append(dict(zip(NUMBERS, n, strict=True)) | {"groups_sha256": digest})
    return {
        "block": number,
        "doc_id": doc_ids,
        "known": facts,
        "pair_a": (pairs // width).tolist(),
        "pair_b": (pairs % width).tolist(),
        "pair_docs": np.bincount(of_pairs.cols, minlength=len(pairs)).tolist(),
        "starts": of_pairs.starts.astype("<i8").tobytes(),
        "cols": of_pairs.cols.astype("<i4").tobytes(),
        "times": of_pairs.values.astype("<i4").tobytes(),
    }


_KNOWN = pa.struct([(n, pa.int64()) for n in NUMBERS] + [("groups_sha256", pa.string())])
_FIELDS = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("known", pa.list_(_KNOWN))]
    + [(n, pa.list_(pa.int32())) for n in ("pair_a", "pair_b", "pair_docs")]
    + [(n, pa.binary()) for n in ("starts", "cols", "times")]
)


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """First pass: a row per block of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        aligner, number = aligner_for(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            at = 0
            for part in by_size(texts, BLOCK_CHARS):
                yield pa.RecordBatch.from_pylist([_block(aligner, number, ids[at : at + len(part)], part)], _FIELDS)
                at, number = at + len(part), number + 1

    return map_batches(docs.select("doc_id", "text"), run, BLOCK)


def _with_counts(key, block: pa.Table, pairs: pa.Table) -> pa.Table:
    """Second pass over one block: its texts x pairs matrix times the pairs' counts."""
    (r,) = block.to_pylist()
    n_docs, n_pairs = len(r["doc_id"]), len(r["pair_a"])
    count, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
    place = pairs.column("place").to_numpy()
    count[place], best[place] = pairs.column("n_docs").to_numpy(), pairs.column("best").to_numpy().astype(np.int64)
    of = Csr(np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["cols"], "<i4").astype(np.int64), np.frombuffer(r["times"], "<i4").astype(np.int64))
    known = {n: [k[n] for k in r["known"]] for n in (*NUMBERS, "groups_sha256")}
    of_sums = {"n_best": _sums(of, best), "count_sum": _sums(of, count)} if n_docs else {"n_best": [], "count_sum": []}
    columns = {"doc_id": r["doc_id"], **known, **of_sums}
    order = [f.split(" ")[0] for f in DOC.split(", ")]
    return pa.table({n: pa.array(columns[n], pa.string() if n == "groups_sha256" else pa.int64()) for n in order})


def pair_counts(blocks_: DataFrame) -> DataFrame:
    """``a, b, n_docs, best``: in how many documents a pair is linked, and whether that is the most of its a."""
    counts = (
        blocks_.select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_docs")).alias("p"))
        .groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
        .agg(F.sum(F.col("p.pair_docs").cast("bigint")).alias("n_docs"))
    )
    counts = stage(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))  # at most a row per id of A
    return counts.join(most, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, and how common its links are."""
    first = stage(blocks(docs, path_a, path_b), "alignments")
    own = first.select("block", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("place", "p"))
    own = own.select(F.col("block").alias("of_block"), "place", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
    counted = own.join(pair_counts(first), ["a", "b"]).select("of_block", "place", "n_docs", "best")
    kept = first.select("block", "doc_id", "known", "pair_a", "starts", "cols", "times")
    return kept.groupBy("block").cogroup(counted.groupBy("of_block")).applyInArrow(_with_counts, DOC)
