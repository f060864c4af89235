"""Token counts: lengths only leave the task that encodes.

Rows come in Arrow batches. Their texts are regrouped into batches of about
equal bytes, each text is cut where the tokenizer always cuts, so a very long
text is many small pieces, every distinct piece of a batch is encoded once in
one batch call, and the lengths are added up per text. SentencePiece models
make no such promise about cuts, so their texts are encoded whole.

Defined results: a null or empty text has 0 bytes and 0 tokens. Repeated rows
are counted each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_batches
from millrace.llm.words import by_size, pieces_for

BATCH_BYTES = 4 << 20
_MODELS: dict = {}


def lengths(path: str, texts: list[str | None]) -> Iterable[int]:
    """Tokens of each text, without added ones."""
    if path.endswith(".model"):
        import sentencepiece

        if path not in _MODELS:
            _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        for part in by_size(texts, BATCH_BYTES):
            yield from (len(ids) for ids in _MODELS[path].encode([t or "" for t in part], num_threads=1))
        return
    yield from pieces_for(path).counts(texts, BATCH_BYTES)


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = list(lengths(path, texts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
