"""Windows over streams, by time and by count, on Spark's own state."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from millrace.operators.load import replace_partitions
from millrace.streaming.events import EPOCH


def time_windows(stream: DataFrame, column: str, size: str, slide: str | None, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Tumbling or (with ``slide``) overlapping windows of event time."""
    window = F.window(column, size, slide) if slide else F.window(column, size)
    return stream.groupBy(window, *keys).agg(*aggs)


#: Groups that the keys of a stream are dealt to by hash; a checkpoint holds state by these, so the number stays as it is.
BUCKETS = 1024
BUCKET = "_bucket"
KEY = "_key"


def _by_bucket(stream: DataFrame, key: str, columns: Sequence[str], step: Callable, out: str, state: str) -> DataFrame:
    """Call ``step`` once per bucket of keys and micro-batch, not once per key: a call costs far more than a key's few rows.

    A key is a text there that is never null; ``_from_text`` gives it back.
    """
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    dealt = stream.select(F.pmod(F.xxhash64(text), F.lit(BUCKETS)).alias(BUCKET), text.alias(KEY), *dict.fromkeys(columns))
    return dealt.groupBy(BUCKET).applyInPandasWithState(step, out, state, "append", "NoTimeout")


def _from_text(kind: str) -> Column:
    return F.when(F.col(KEY) != "", F.substr(F.col(KEY), F.lit(2))).cast(kind)


def _in_order(frames: Iterable[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    """A bucket's rows of one micro-batch; those of a key are in their order."""
    return pd.concat(list(frames), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)


def _held(state: GroupState, names: Sequence[str]) -> dict[str, list]:
    return json.loads(state.get[0]) if state.exists else {name: [] for name in names}


def _numbered(earlier: Sequence[str], keys: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key, of the earlier ones first, and the keys by number."""
    return pd.factorize(np.array([*earlier, *keys], dtype=object))


def count_windows(stream: DataFrame, key: str, order: Sequence[str], value: str, n: int) -> DataFrame:
    """One total per ``n`` consecutive rows of a key; the open window waits in Spark's keyed state.

    The state of a key is three numbers: windows done, and count and sum of the open
    one. A key's rows are ordered within each micro-batch; a task holds those of
    one bucket of keys and micro-batch. The key's type must cast to text and back.
    """

    def step(group: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        rows, known = _in_order(frames, order), _held(state, ["keys", "done", "held", "total"])
        number, keys = _numbered(known["keys"], rows[KEY])
        own = number[len(known["keys"]) :]
        done, held, total = (np.zeros(len(keys), kind) for kind in ("int64", "int64", "float64"))
        for numbers, name in ((done, "done"), (held, "held"), (total, "total")):
            numbers[: len(known[name])] = known[name]
        place = held[own] + pd.Series(own).groupby(own).cumcount().to_numpy()
        sums = rows[value].astype("float64").fillna(0.0).groupby([own, place // n]).sum()
        of, window = (sums.index.get_level_values(i).to_numpy() for i in (0, 1))
        sums = sums.to_numpy() + np.where(window == 0, total[of], 0.0)
        seen = held + np.bincount(own, minlength=len(keys))
        shut = window < (seen // n)[of]
        out = pd.DataFrame({KEY: keys[of[shut]], "window_no": done[of[shut]] + window[shut], "total": sums[shut]})
        total[of] = 0.0
        total[of[~shut]] = sums[~shut]
        after = {"keys": keys, "done": done + seen // n, "held": seen % n, "total": total}
        state.update((json.dumps({name: x.tolist() for name, x in after.items()}),))
        yield out

    kind = stream.schema[key].dataType.simpleString()
    out = _by_bucket(stream, key, [*order, value], step, f"{KEY} string, window_no bigint, total double", "open string")
    return out.select(_from_text(kind).alias(key), "window_no", "total")


def _mean_of_last(values: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Mean of each value and the up to ``n - 1`` before it in its group, where ``place`` counts from 0; NaN is left out."""
    known = ~np.isnan(values)
    total, count, filled = np.zeros(len(values)), np.zeros(len(values), "int64"), np.where(known, values, 0.0)
    for back in range(min(n - 1, place.max(initial=0)), -1, -1):
        at = np.flatnonzero(place >= back)
        total[at] += filled[at - back]
        count[at] += known[at - back]
    return np.divide(total, count, out=np.full(len(values), np.nan), where=count > 0)


def moving_average(stream: DataFrame, key: str, order: Sequence[str], row_id: str, value: str, n: int) -> DataFrame:
    """Average of the last ``n`` rows of a key for every row; the state holds its last n-1 values.

    A task holds the rows of one bucket of keys and micro-batch. The key's type must cast to text and back.
    """

    def step(group: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        rows, known = _in_order(frames, order), _held(state, ["keys", "tail"])
        number, keys = _numbered(known["keys"], rows[KEY])
        # rows of a key side by side, those of the state first
        by_key = np.argsort(number, kind="stable")
        values = np.concatenate([np.array(known["tail"], "float64"), rows[value].to_numpy("float64", na_value=np.nan)])[by_key]
        sizes = np.bincount(number, minlength=len(keys))
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        averages = _mean_of_last(values, place, n)
        tail = np.repeat(sizes, sizes) - place < n
        state.update((json.dumps({"keys": keys[number[by_key][tail]].tolist(), "tail": values[tail].tolist()}),))
        new = by_key >= len(known["keys"])
        ids = rows[row_id].iloc[by_key[new] - len(known["keys"])]
        yield pd.DataFrame({row_id: ids.to_numpy(), "average": averages[new]})

    kind = stream.schema[row_id].dataType.simpleString()
    return _by_bucket(stream, key, [row_id, *order, value], step, f"{row_id} {kind}, average double", "tails string")


def recompute_days(
    spark: SparkSession, schema: str, raw_path: str, out_path: str, summarize: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """Keep raw rows by (day, epoch) and recompute each day a micro-batch touches.

    A late row changes the summary of its day whenever it comes, and a repeated
    batch gives the same table.
    """

    def consume(batch: DataFrame, epoch: int) -> None:
        replace_partitions(batch.withColumn(EPOCH, F.lit(epoch)), raw_path, ["day", EPOCH])
        touched = batch.select("day").distinct()
        raw = spark.read.schema(f"{schema}, {EPOCH} int").parquet(raw_path).filter(F.col(EPOCH) <= epoch)
        replace_partitions(summarize(raw.join(touched, "day", "left_semi")), out_path, ["day"])

    return consume
