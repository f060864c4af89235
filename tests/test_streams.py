"""Streams: repeated micro-batches, state over batches, restarts."""

import random

from pyspark.sql import functions as F

from millrace.session import fresh_path
from millrace.streaming import events as S
from millrace.streaming import windows as W

SCHEMA = "user_id bigint, ts int, event_id bigint, value double"


def batches(seed=5, n=120, size=30):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3]), i, i, float(rng.randrange(100))) for i in range(n)]
    return rows, [rows[i : i + size] for i in range(0, n, size)]


def test_repeated_batch_replaces_itself(spark):
    path = fresh_path(spark, "sink")
    sink = S.epoch_sink(path)
    for epoch in (0, 0, 1, 1):
        sink(spark.range(5 + epoch), epoch)
    assert spark.read.parquet(path).count() == 11


def run_parts(spark, parts, build, schema):
    df = spark.createDataFrame([(*r, i) for i, part in enumerate(parts) for r in part], SCHEMA + ", part int")
    slices = [F.col("part") == i for i in range(len(parts))]
    return S.collect_arrivals(df, slices, build, schema).collect()


def test_count_windows_over_batches(spark):
    rows, parts = batches()
    emitted = run_parts(
        spark, parts, lambda s: W.count_windows(s, "user_id", ["ts", "event_id"], "value", 4), "user_id bigint, window_no bigint, total double"
    )
    got = {(r["user_id"], r["window_no"]): r["total"] for r in emitted}
    want = {}
    for user in {r[0] for r in rows}:
        values = [r[3] for r in rows if r[0] == user]
        want.update({(user, i): sum(values[4 * i : 4 * i + 4]) for i in range(len(values) // 4)})
    assert got == want and len(emitted) == len(got)


def test_moving_average_over_batches(spark):
    rows, parts = batches(6)
    emitted = run_parts(
        spark, parts, lambda s: W.moving_average(s, "user_id", ["ts", "event_id"], "event_id", "value", 3), "event_id bigint, average double"
    )
    got = {r["event_id"]: r["average"] for r in emitted}
    for i, r in enumerate(rows):
        last = [x[3] for x in rows[: i + 1] if x[0] == r[0]][-3:]
        assert abs(got[r[2]] - sum(last) / len(last)) < 1e-9
    assert len(got) == len(rows) == len(emitted)


def test_many_keys_are_few_calls(spark, monkeypatch):
    monkeypatch.setattr(W, "BUCKETS", 3)
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(40)]), i, i, rng.choice([None, float(i % 17)])) for i in range(400)]
    source, checkpoints = fresh_path(spark, "keyed"), [fresh_path(spark, "cp") for _ in range(2)]
    averages, totals = fresh_path(spark, "averages"), fresh_path(spark, "totals")
    for part in (rows[:250], rows[250:]):
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(source)
        stream = S.stream_files(spark, source, SCHEMA)
        mean = W.moving_average(stream, "user_id", ["ts", "event_id"], "event_id", "value", 4)
        S.run_batches(mean, S.epoch_sink(averages), checkpoints[0])
        S.run_batches(W.count_windows(stream, "user_id", ["ts", "event_id"], "value", 4), S.epoch_sink(totals), checkpoints[1])
    assert all(spark.read.format("statestore").load(path).count() <= 3 for path in checkpoints)
    got = {r["event_id"]: r["average"] for r in spark.read.parquet(averages).collect()}
    own = {user: [r for r in rows if r[0] == user] for user, *_ in rows}
    assert len(own) == 41 and len(got) == len(rows)
    for group in own.values():
        for i, r in enumerate(group):
            last = [x[3] for x in group[max(0, i - 3) : i + 1] if x[3] is not None]
            assert got[r[2]] == (sum(last) / len(last) if last else None)
    want = {(u, i // 4): sum(x[3] or 0.0 for x in group[i : i + 4]) for u, group in own.items() for i in range(0, len(group) - 3, 4)}
    assert {(r["user_id"], r["window_no"]): r["total"] for r in spark.read.parquet(totals).collect()} == want


def test_late_rows_change_their_day(spark):
    raw, out = fresh_path(spark, "raw"), fresh_path(spark, "out")
    consume = W.recompute_days(
        spark, "id int, day string", raw, out, lambda df: df.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    )
    for epoch, rows in enumerate([[(1, "a"), (2, "a"), (3, "b")], [(4, "b")], [(5, "a")]]):
        batch = spark.createDataFrame(rows, "id int, day string")
        consume(batch, epoch)
        consume(batch, epoch)
    assert {r["day"]: r["n"] for r in spark.read.parquet(out).collect()} == {"a": 3, "b": 2}


def test_restart_reads_nothing_twice(spark):
    source, out, checkpoint = (fresh_path(spark, x) for x in ("src", "out", "cp"))
    for start in (0, 10, 10, 20):
        spark.range(start, start + 10).write.mode("append").parquet(source)
        S.run_batches(S.stream_files(spark, source, "id bigint"), S.epoch_sink(out), checkpoint)
        S.run_batches(S.stream_files(spark, source, "id bigint"), S.epoch_sink(out), checkpoint)
    assert spark.read.parquet(out).count() == 40
