"""Repeated passages by FM-indexes over shards of the corpus.

A passage is a run of ``window`` words. Every window of a text falls to one shard,
named by the window's rarest-looking part: the least hash among its runs of
``ANCHOR`` words. Equal windows have equal anchors, so they meet in one shard, and
neighbouring windows mostly share theirs, so a text falls into a few *segments*, runs of
windows with one anchor.

1. Segments leave the texts as hashes only. Equal ones are combined before any
   shuffle, and anchors seen in one document alone are dropped: their windows
   can't repeat.
2. An anchor with more than ``HOT_SEGMENTS`` different segments (a phrase that
   very many texts hold in different surroundings) is replaced by the windows
   themselves: each becomes a segment of its own under its own hash, and again
   those of one document alone are dropped. So no shard grows with one phrase.
3. Each different segment is taken once from the text of its first document and
   sent to its shard.
4. A shard builds an FM-index of its segments and streams them through it by
   backward search. The matching statistics say where a match reaches ``window``
   words; the class of such a place gives the smallest doc_id that the window
   starts in.
5. The places of all equal segments are joined to those intervals, and words
   of windows that a smaller doc_id holds are removed.

Words count as equal when their 64-bit hashes are.

Defined results: words are runs of other than the six ASCII white-space
characters; null, empty and blank texts have none, and texts of fewer words than
a window keep all. Windows don't reach across documents. A null doc_id counts as
larger than any other, and rows of one doc_id (or of none) are one document: they take
nothing from each other. Repeated rows are each returned. A text of any length is cut
into segments of at most ``LONGEST`` windows; its words are held by one task.
An empty table gives no rows. ``passages`` and ``without_repeats`` hand all columns
of the input through, whatever their names, inside one struct.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, packed_rows, stage, text_of
from millrace.llm.fm_index import FmIndex
from millrace.llm.words import by_size

WINDOW = 50
#: Words of an anchor.
ANCHOR = 16
#: Windows of a segment at most.
LONGEST = 256
#: An anchor with more different segments is taken apart.
HOT_SEGMENTS = 2_000
#: Words of a shard, about.
SHARD_WORDS = 1 << 20
#: Stands for a null doc_id.
LAST = (1 << 63) - 1

BATCH_CHARS = 16 << 20
SEGMENT = "d bigint, th bigint, key bigint, seg bigint, start int, n int"
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes of all texts one after the other, and the place after each text's last word."""
    lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
    words = lists.flatten()
    coded = words.dictionary_encode()
    names = coded.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    places = coded.indices.to_numpy(zero_copy_only=False)
    full = np.array([bool(w) for w in names], bool)[places] if len(places) else np.zeros(0, bool)
    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    ends = np.concatenate([[0], np.cumsum(full)])[offsets[1:]]
    return table[places[full]], ends


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any run of words from prefix sums of hash times a power, modulo 2**64."""

    def __init__(self, words: np.ndarray, base: int) -> None:
        n = len(words)
        inverse = pow(base, -1, 1 << 64)
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
        self.back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]))
        self.sums = np.concatenate([[np.uint64(0)], np.add.accumulate(words * powers[:-1])])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.back[starts])


def _least_in_run(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments_of(words: np.ndarray, ends: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Document, key, content hash, first word and number of windows of each segment; words count over all texts."""
    none = np.zeros(0, np.int64)
    n = len(words) - window + 1
    if n < 1:
        return none, none, none, none, none
    rolling = Rolling(words, _BASES[0])
    at = np.arange(len(words) - anchor + 1)
    keys = _least_in_run(rolling.of(at, at + anchor), window - anchor + 1)
    doc = np.searchsorted(ends, np.arange(n), side="right")
    inside = np.arange(n) + window <= ends[doc]
    fresh = np.ones(n, bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    places = np.flatnonzero(fresh)
    since = np.arange(n) - np.repeat(places, np.diff(np.append(places, n)))
    first = np.flatnonzero(inside & (since % LONGEST == 0))
    # A document's windows are consecutive, so a segment ends before the next one or at the document's last window.
    last = np.minimum(np.append(first[1:], n), ends[doc[first]] - window + 1) if len(first) else first
    content = rolling.of(first, last + window - 1)
    return doc[first], keys[first].view(np.int64), content.view(np.int64), first, last - first


def _order(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(LAST))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(_order().alias("d"), F.xxhash64("text").alias("th"), F.col("text"))


def _segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            d, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "th"))
            at = 0
            for part in by_size(batch.column("text").to_pylist(), BATCH_CHARS):
                words, ends = word_hashes(part)
                doc, key, seg, first, n = segments_of(words, ends, window, anchor)
                start = first - np.concatenate([[0], ends])[doc]
                columns = [d[at + doc], th[at + doc], key, seg, start.astype(np.int32), n.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "th", "key", "seg", "start", "n"])
                at += len(part)

    return map_batches(_texts(docs), run, SEGMENT)


def _spans_by_text(spans: DataFrame, *fields: str) -> DataFrame:
    """The spans of each text (bounded by its length) as one array; equal rows are combined."""
    return spans.groupBy("d", "th").agg(F.collect_set(F.struct(*fields)).alias("spans"))


def _windows(docs: DataFrame, hot: DataFrame, window: int) -> DataFrame:
    """Each window of the hot segments as a segment of its own, under two hashes of its words."""
    rows = _texts(docs).join(_spans_by_text(hot, "start", "n"), ["d", "th"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for d, th, text, spans in zip(*(batch.column(c).to_pylist() for c in ("d", "th", "text", "spans")), strict=True):
                words, _ = word_hashes([text])
                at = np.concatenate([np.arange(s["start"], s["start"] + s["n"]) for s in spans])
                key, seg = (Rolling(words, base).of(at, at + window).view(np.int64) for base in _BASES)
                same = np.full(len(at), d, np.int64), np.full(len(at), th, np.int64)
                columns = [*same, key, seg, at.astype(np.int32), np.ones(len(at), np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "th", "key", "seg", "start", "n"])

    return map_batches(rows, run, SEGMENT)


def _different(segments: DataFrame) -> DataFrame:
    """One row per different segment: its first document and place, and the largest doc_id that holds it."""
    return segments.groupBy("key", "seg", "n").agg(F.min(F.struct("d", "th", "start")).alias("first"), F.max("d").alias("top"))


def _repeated(different: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys that more than one document holds, with their number of different segments; the segments under them."""
    different = stage(different, "different-segments")
    keys = different.groupBy("key").agg(F.min("first.d").alias("lo"), F.max("top").alias("hi"), F.count(F.lit(1)).alias("kinds"))
    return stage(keys.filter("lo < hi").select("key", "kinds"), "repeated-keys"), different


def _with_words(docs: DataFrame, different: DataFrame, window: int) -> DataFrame:
    """Each different segment with its words' hashes, taken from its first document."""
    places = different.select("first.d", "first.th", "first.start", "n", "key", "seg", "top")
    rows = _texts(docs).dropDuplicates(["d", "th"]).join(_spans_by_text(places, "start", "n", "key", "seg", "top"), ["d", "th"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for d, text, spans in zip(*(batch.column(c).to_pylist() for c in ("d", "text", "spans")), strict=True):
                words, _ = word_hashes([text])
                cut = [words[s["start"] : s["start"] + s["n"] + window - 1].tobytes() for s in spans]
                columns = [pa.array([s[c] for s in spans], pa.int64()) for c in ("key", "seg", "top")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([d] * len(spans), pa.int64()), pa.array(cut, pa.binary())], names=["key", "seg", "top", "d", "words"])

    return map_batches(rows, run, "key bigint, seg bigint, top bigint, d bigint, words binary")


def _search(window: int):
    def run(table: pa.Table) -> pa.Table:
        """Index the shard's segments, stream them through it, and report the intervals that a smaller doc_id holds."""
        column = {c: table.column(c).to_numpy() for c in ("key", "seg", "top", "d")}
        parts = table.column("words").to_pylist()
        sizes = np.array([len(p) // 8 for p in parts], np.int64)
        names, places = np.unique(np.frombuffer(b"".join(parts), np.uint64), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        text = np.zeros(len(places) + len(parts), np.int64)
        owner = np.repeat(np.arange(len(parts)), sizes)
        text[np.arange(len(places)) + owner] = places + 1
        index = FmIndex(text, len(names) + 1, window)
        least = index.least_of_class(np.repeat(column["d"], sizes + 1))
        _, found = index.matching_statistics(places + 1, starts)
        at = np.flatnonzero(found >= 0)
        value, own = least[found[at]], owner[at]
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
        first = np.flatnonzero(new)
        stop = np.append(first[1:], len(at))
        keep = value[first] < column["top"][own[first]]  # else no document with this segment has a larger doc_id
        first, stop = first[keep], stop[keep]
        who, begin = own[first], at[first] - starts[own[first]]
        end = at[stop - 1] - starts[who] + window
        columns = [column["key"][who], column["seg"][who], value[first], begin.astype(np.int32), end.astype(np.int32)]
        return pa.table(dict(zip(("key", "seg", "least", "begin", "finish"), map(pa.array, columns), strict=True)))

    return run


def intervals(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot_segments: int = HOT_SEGMENTS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``d, th, begin, finish``: the words of each text that windows of a smaller doc_id cover."""
    found = stage(_segments(docs, window, anchor), "segments")
    keys, different = _repeated(_different(found))
    hot_keys = keys.filter(F.col("kinds") > hot_segments).select("key")
    wanted = different.join(keys.filter(F.col("kinds") <= hot_segments).select("key"), "key", "left_semi")
    if not hot_keys.isEmpty():
        single = stage(_windows(docs, found.join(hot_keys, "key", "left_semi"), window), "windows")
        # equal windows are one row here: their key alone says whether they repeat
        wanted = wanted.unionByName(_different(single).filter(F.col("first.d") < F.col("top")))
        found = found.unionByName(single)
    wanted = stage(wanted, "wanted-segments")
    words = wanted.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    shard = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-words // shard_words)))).alias("shard")
    sent = _with_words(docs, wanted, window).select(shard, "key", "seg", "top", "d", "words")
    search = _search(window)

    def of_shard(table: pa.Table) -> pa.Table:
        return search(table)

    repeats = stage(sent.groupBy("shard").applyInArrow(of_shard, "key bigint, seg bigint, least bigint, begin int, finish int"), "repeats")
    return found.join(repeats, ["key", "seg"]).filter("least < d").select("d", "th", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("finish")).alias("finish"))


def passages(docs: DataFrame, **parameters: int) -> DataFrame:
    """``row, spans``: every row of the input with the spans of words (first, one after the last) to remove; null for none."""
    spans = _spans_by_text(stage(intervals(docs, **parameters), "intervals"), "begin", "finish")
    rows = packed_rows(docs).withColumn("d", F.coalesce("row.doc_id", F.lit(LAST))).withColumn("th", F.xxhash64("row.text"))
    return rows.join(spans, ["d", "th"], "left").select("row", "spans")


def without_repeats(docs: DataFrame, **parameters: int) -> DataFrame:
    """``row, n_words, n_removed, kept``: what is left of each text, its words joined by one space."""
    found = passages(docs, **parameters)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            numbers, removed, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = text.encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    gone[s["begin"]] += 1
                    gone[s["finish"]] -= 1
                if spans:
                    left = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                    kept.append(b" ".join([words[k] for k in left]).decode())
                    removed.append(len(words) - len(left))
                else:
                    kept.append(b" ".join(words).decode())
                    removed.append(0)
                numbers.append(len(words))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(numbers, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["row", "n_words", "n_removed", "kept"])

    # the text itself goes through once, the other columns as they are
    rows = found.select(F.col("row").dropFields("text").alias("row"), text_of(F.col("row.text")).alias("text"), "spans")
    kind = rows.schema["row"].dataType.simpleString()
    return map_batches(rows, run, f"row {kind}, n_words bigint, n_removed bigint, kept string")


__all__ = ["intervals", "passages", "without_repeats"]
