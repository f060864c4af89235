"""Ordered operators: plain and split plans against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered as O

ROWS_PER_TASK = [10**6, 20]


def rows(seed=3, n=400):
    """Three keys in four belong to one hot key; values have gaps at both ends."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = None if i % 40 == 7 else ("hot" if rng.random() < 0.75 else rng.choice("abcde"))
        value = None if rng.random() < 0.4 else float(rng.randrange(1, 100))
        out.append((key, rng.randrange(50), i, value, rng.choice("xy")))
    return out


def groups(data):
    out = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.fixture(params=ROWS_PER_TASK, ids=["plain", "split"])
def case(request, spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, t int, id int, v double, kind string").repartition(4)
    o = O.ordered(df, ["k"], ["t", "id"], request.param)
    assert o.chunked == (request.param == 20)
    return o, groups(data)


def by_id(o, column):
    return {r["id"]: r[column] for r in o.rows().collect()}


def expected(grouped, function):
    return {r[2]: x for g in grouped.values() for r, x in zip(g, function(g))}


def test_row_numbers(case):
    o, g = case
    assert by_id(O.row_numbers(o), "rn") == expected(g, lambda rs: range(1, len(rs) + 1))


def test_running_sum(case):
    def sums(rs):
        total, seen = 0.0, False
        for r in rs:
            total, seen = (total + r[3], True) if r[3] is not None else (total, seen)
            yield total if seen else None

    o, g = case
    assert by_id(O.running_sum(o, "v", "s"), "s") == expected(g, sums)


def test_running_avg(case):
    def averages(rs):
        known = []
        for r in rs:
            known += [] if r[3] is None else [r[3]]
            yield sum(known) / len(known) if known else None

    o, g = case
    got, want = by_id(O.running_avg(o, "v", "a"), "a"), expected(g, averages)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i]) for i in got if want[i] is not None)


@pytest.mark.parametrize("n", [1, 3, 60])
def test_moving_avg(case, n):
    def averages(rs):
        for i in range(len(rs)):
            known = [r[3] for r in rs[max(0, i - n + 1) : i + 1] if r[3] is not None]
            yield sum(known) / len(known) if known else None

    o, g = case
    got = by_id(O.moving_avg(O.Ordered(o.df.fillna(0.0, ["v"]), o.keys, o.order, o.chunked), "v", n, "a"), "a")
    zero = {k: [(*r[:3], r[3] or 0.0, r[4]) for r in rs] for k, rs in g.items()}
    want = expected(zero, averages)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i]) for i in got)


def test_moving_avg_over_many_ranges(spark, monkeypatch):
    """Windows of thousands of rows over two hundred ranges; rows of the range before are sent, no arrays and no tails."""
    monkeypatch.setattr(O, "ROWS_PER_RUN", 100)
    n, rows = 3000, 20_000
    df = spark.range(rows).select(F.lit("hot").alias("k"), "id", (F.col("id") * 7 % 1000).cast("double").alias("v"))
    o = O.ordered(df, ["k"], ["id"], rows // 200)
    assert o.chunked and o.df.select(O.CHUNK).distinct().count() > 100
    moved = O.moving_avg(o, "v", n, "a")
    got = by_id(moved, "a")
    values, total, want = [i * 7 % 1000 for i in range(rows)], 0, {}
    for i, v in enumerate(values):
        total += v - (values[i - n] if i >= n else 0)
        want[i] = total / min(i + 1, n)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i]) for i in got)
    plan = moved.df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("backward", [False, True])
def test_fill(case, backward):
    def filled(rs):
        last, out = None, []
        for r in reversed(rs) if backward else rs:
            last = r[3] if r[3] is not None else last
            out.append(last)
        return out[::-1] if backward else out

    o, g = case
    assert by_id(O.fill(o, "v", "f", backward), "f") == expected(g, filled)


def test_previous(case):
    o, g = case
    assert by_id(O.previous(o, "kind", "p"), "p") == expected(g, lambda rs: [None] + [r[4] for r in rs[:-1]])


def test_interpolate(case):
    def points(rs):
        known = [i for i, r in enumerate(rs) if r[3] is not None]
        for i, r in enumerate(rs):
            before = [j for j in known if j <= i]
            after = [j for j in known if j >= i]
            if not before:
                yield None
            elif not after or before[-1] == i:
                yield rs[before[-1]][3]
            else:
                a, b = before[-1], after[0]
                yield rs[a][3] + (rs[b][3] - rs[a][3]) / (b - a) * (i - a)

    o, g = case
    got, want = by_id(O.interpolate(o, "v", "x"), "x"), expected(g, points)
    assert {i: x is None for i, x in got.items()} == {i: x is None for i, x in want.items()}
    assert all(got[i] == pytest.approx(want[i]) for i in got if want[i] is not None)


def test_count_windows_hold_back_the_open_one(case):
    o, g = case
    got = {(r["k"], r["window_no"]): r["ids"] for r in O.count_windows(o, 7, [F.sum("id").alias("ids")]).collect()}
    want = {
        (k, w): sum(r[2] for r in rs[7 * w : 7 * w + 7]) for k, rs in g.items() for w in range(len(rs) // 7)
    }
    assert got == want


def test_run_groups(case):
    o, g = case
    got = sorted(
        (str(r["k"]), r["run_no"], r["kind"], r["n"])
        for r in O.run_groups(o, "kind", [F.count(F.lit(1)).alias("n")]).collect()
    )
    want = []
    for k, rs in g.items():
        runs = []
        for r in rs:
            if runs and runs[-1][0] == r[4]:
                runs[-1][1] += 1
            else:
                runs.append([r[4], 1])
        want += [(str(k), i + 1, kind, n) for i, (kind, n) in enumerate(runs)]
    assert got == sorted(want)


@pytest.mark.parametrize("limit", ROWS_PER_TASK)
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, limit, q):
    import numpy as np

    data = rows(9)
    df = spark.createDataFrame(data, "k string, t int, id int, v double, kind string").filter("k is not null")
    got = {r["k"]: r["m"] for r in O.exact_quantiles(df, ["k"], "v", {"m": q}, limit).collect()}
    for k, rs in groups(data).items():
        known = [r[3] for r in rs if r[3] is not None]
        if k is not None and known:
            assert got[k] == pytest.approx(float(np.quantile(known, q)))
    whole = O.exact_quantiles(df, [], "v", {"m": q}, limit).first()["m"]
    assert whole == pytest.approx(float(np.quantile([r[3] for r in data if r[3] is not None and r[0] is not None], q)))


AWKWARD = {
    "wide": [0.0, -0.0, 1e300, -1e300, 1e-300, 5e-324, -3.5, float("inf"), float("-inf"), 2.0, 2.0, 2.0],
    "close": [1e15 + k * 0.125 for k in range(500)],
    "equal": [4.25] * 50,
    "one": [7.0],
    "skewed": [1.5] * 90 + [1.5 + k * 2.0**-40 for k in range(10)],
}


@pytest.mark.parametrize("limit", [10**6, 20])
def test_quantiles_of_awkward_values(spark, limit):
    from fractions import Fraction

    df = spark.createDataFrame([(None if k == "one" else k, v) for k, vs in AWKWARD.items() for v in vs], "k string, v double")
    wanted = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.95, "q10": 1.0}
    got = {r["k"]: r for r in O.exact_quantiles(df, ["k"], "v", wanted, limit).collect()}
    assert len(got) == len(AWKWARD)
    for k, values in AWKWARD.items():
        row, values = got[None if k == "one" else k], sorted(values)
        assert row["n"] == len(values)
        for name, q in wanted.items():
            place = (len(values) - 1) * q
            low, high = values[int(place)], values[-int(-place // 1)]
            if abs(low) != float("inf") and abs(high) != float("inf"):
                assert row[name] == pytest.approx(float(Fraction(low) + (Fraction(high) - Fraction(low)) * Fraction(place % 1)), rel=1e-12)


def test_quantiles_of_longs_that_doubles_cannot_tell_apart(spark):
    df = spark.range(300).select((F.lit(2**60) + F.col("id") % 7).alias("v"))
    assert O.exact_quantiles(df, [], "v", {"m": 0.0}, 20).first()["m"] == float(2**60)
    assert O.exact_quantiles(df.limit(0), [], "v", {"m": 0.5}).collect() == []


def test_quantiles_move_parts_not_values(spark):
    """Twenty times the values, hardly more rows in the shuffle of the first pass."""
    sizes = []
    for n in (5_000, 100_000):
        v = (F.col("id") * 7919 % n / n + 1).alias("v")
        df = spark.range(n).select(v)
        sizes.append(df.groupBy(O._first_part(F.col("v")).alias("p")).count().count())
        assert O.exact_quantiles(df, [], "v", {"m": 0.5}, 1000).first()["m"] == pytest.approx(1 + (n - 1) / 2 / n)
    assert sizes[0] == sizes[1] <= 17


def test_global_index_and_slices(spark):
    ids = list(range(500))
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id int").repartition(7)
    indexed = {r["id"]: r["idx"] for r in O.global_index(df, ["id"]).collect()}
    assert indexed == {i: i for i in ids}
    descending = {r["id"]: r["pos"] for r in O.global_index(df, [F.desc("id")], "pos", start=1).collect()}
    assert descending == {i: 500 - i for i in ids}
    assert sorted(r["id"] for r in O.row_slice(df, ["id"], 3, 20, 5).collect()) == [3, 8, 13, 18]
    assert O.row_slice(df, ["id"], 600, 700).count() == 0
    assert O.row_at(df, ["id"], 499).first()["id"] == 499
    with pytest.raises(IndexError):
        O.row_at(df, ["id"], 500)


def test_missing_days(spark):
    df = spark.sql("select date'2024-03-02' as d union all select date'2024-03-04'")
    gaps = O.missing_days(df, "d", "2024-03-01", "2024-03-05")
    assert sorted(str(r["d"]) for r in gaps.collect()) == ["2024-03-01", "2024-03-03", "2024-03-05"]


def test_quantiles_of_few_keys_join_their_ranges_by_broadcast(spark, monkeypatch):
    """The planner has to know that the ranges are few, or all rows are shuffled by key."""
    seen, ask = [], O.broadcast_within
    monkeypatch.setattr(O, "broadcast_within", lambda df: seen.append(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) or ask(df))
    df = spark.range(20_000).select((F.col("id") % 8).alias("k"), F.exp((F.col("id") * 7919 % 20_000) / 100).alias("v"))
    assert O.exact_quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.75}, 100).count() == 8
    assert len(seen) > 1 and max(seen) < 1 << 20
