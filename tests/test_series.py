"""Splitting a series over slots must not change any result."""

import random

import pytest
from conftest import values
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import indicators as I
from tickloom.operators import panes as P
from tickloom.operators import series as R
from tickloom.operators.filters import min_history

BARS = "symbol string, frame string, ts long, openBid double, highBid double, lowBid double, closeBid double"


def gappy(seed=1, n=400):
    """Series of very uneven length with gaps that skip whole slots."""
    rng = random.Random(seed)
    out = []
    for symbol, count in (("HOT", n), ("B", 37), ("C", 1)):
        ts = 0
        for _ in range(count):
            ts += 60 * rng.choice([1, 1, 1, 1, 2, 30, 400])
            close = rng.uniform(90, 110)
            out.append((symbol, "m1", ts, close - 1, close + 2, close - 3, close))
    return out


@pytest.mark.parametrize("width", [60, 600, 6000, 10 ** 9])
def test_row_windows_over_slots_equal_whole_series(rows, width):
    df = rows(BARS, *gappy())
    split = R.over_series(df, 20, lambda d, w: d.withColumn(
        "n", F.count("*").over(w.rowsBetween(-20, 0))).withColumn("s", F.sum("ts").over(w.rowsBetween(-20, 0))),
        slot=F.floor(F.col("ts") / width))
    w = Window.partitionBy("symbol", "frame").orderBy("ts").rowsBetween(-20, 0)
    whole = df.withColumn("n", F.count("*").over(w)).withColumn("s", F.sum("ts").over(w))
    columns = ["symbol", "ts", "n", "s"]
    assert sorted(values(split, *columns)) == sorted(values(whole, *columns))


@pytest.mark.parametrize("width", [300, 5000])
def test_indicators_over_slots_equal_whole_series(rows, width):
    df = rows(BARS, *gappy(2))
    names = ["symbol", "ts", *[F.round(c, 9) for c in ("bbmid", "bbupper", "bbwidth", "rsi", "delta", "up", "down")]]
    split = I.indicators(df, slot=F.floor(F.col("ts") / width))
    whole = I.indicators(df, slot=F.lit(0))
    assert sorted(values(split, *names), key=str) == sorted(values(whole, *names), key=str)


def test_lookback_copies_at_most_what_is_asked_for(rows):
    df = rows(BARS, *gappy(3))
    spread = R.with_lookback(df, 5, slot=F.floor(F.col("ts") / 3000))
    copies = spread.filter("NOT _own").groupBy("symbol", "_slot").count()
    assert copies.filter("count > 5").count() == 0
    assert spread.filter("_own").count() == df.count()


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_monotonic_gate(rows, size):
    rng = random.Random(4)
    data = [(rng.choice("AAAB"), rng.randrange(-5, 500), i) for i in range(600)]
    got = R.monotonic(rows("symbol string, ts long, arrival long", *data), ["symbol"], slot_size=size)
    want, top = [], {}
    for symbol, ts, arrival in data:
        if ts > top.get(symbol, 0):
            want.append((symbol, ts, arrival))
            top[symbol] = ts
    assert sorted(values(got, "symbol", "ts", "arrival")) == sorted(want)


def test_old_prediction_is_not_passed_on(rows):
    df = rows("symbol string, frame string, ts long, arrival long",
              ("A", "m1", 100, 0), ("A", "m1", 90, 1), ("A", "m1", 110, 2))
    assert sorted(values(R.monotonic(df), "ts")) == [(100,), (110,)]


def test_latest_takes_one_whole_row(rows):
    df = rows("k string, o long, a double, b double",
              ("x", 1, 1.0, None), ("x", 2, None, 2.0), ("y", None, 3.0, 3.0))
    assert sorted(values(R.latest(df, ["k"], "o"), "k", "o", "a", "b"), key=str) == [
        ("x", 2, None, 2.0), ("y", None, 3.0, 3.0)]


def test_keep_first_with_text_payload(rows):
    df = rows("k string, o long, s string", ("x", 2, "b"), ("x", 1, "a"), ("y", 1, None))
    assert sorted(values(R.keep_first(df, ["k"], "o"), "k", "s"), key=str) == [("x", "a"), ("y", None)]


def test_dedup_is_idempotent(rows):
    df = rows("symbol string, frame string, ts long, v long", ("A", "m1", 1, 5), ("A", "m1", 1, 6), ("A", "m1", 2, 7))
    once = R.dedup(df, order="v")
    assert values(once.orderBy("ts"), "ts", "v") == values(R.dedup(once, order="v").orderBy("ts"), "ts", "v") == [
        (1, 5), (2, 7)]


def test_history_is_ordered_and_whole(rows):
    df = rows(BARS, *gappy(5)).orderBy(F.rand(1))
    packed = R.history(df, seconds=5000, fields=("closeBid",))
    assert packed.agg(F.sum(F.size("history"))).first()[0] == df.count()
    assert packed.filter(F.col("history") != F.array_sort("history")).count() == 0


@pytest.mark.parametrize("size, step", [(259_200, 60), (3600, 3600), (1000, 300), (60, 200), (7, 5)])
def test_sliding_windows_of_any_size(rows, size, step):
    df = rows("symbol string, frame string, ts long, closeBid double",
              *[(s, "m1", t, float(t)) for s in ("A", None) for t in (60, 120, 300, 3600, 3660, 90_000)])
    got = P.sliding_history(df, size, step, fields=("closeBid",)).filter("symbol = 'A'")
    want = {}
    for t in (60, 120, 300, 3600, 3660, 90_000):
        start = t // step * step
        while start > t - size:
            want.setdefault((start, start + size), []).append(t)
            start -= step
    assert {(r["start"], r["end"]): [c["ts"] for c in r["history"]] for r in got.collect()} == want
    assert P.sliding_history(df, size, step, fields=("closeBid",)).filter("symbol is null").count() == len(want)


def test_many_last_rows_rank_only_the_newest_slots(spark):
    bars = spark.range(120_000).select(F.when(F.col("id") % 3 > 0, "A").alias("symbol"), F.lit("m1").alias("frame"), (F.col("id") * 60).alias("ts"))
    got = R.last_rows(bars, 1500, skip=10)
    times = {s: sorted(r["ts"] for r in got.collect() if r["symbol"] == s) for s in ("A", None)}
    own = {"A": [60 * i for i in range(120_000) if i % 3], None: [60 * i for i in range(0, 120_000, 3)]}
    assert all(times[s] == own[s][-1510:-10] for s in own)
    assert "_slot" in got._jdf.queryExecution().executedPlan().toString()


def test_first_needs_an_order_besides_the_key(rows):
    with pytest.raises(ValueError):
        R.keep_first(rows("k string, t long", ("a", 1)), ["k", "t"], "t")


def test_packed_order_equals_the_order_of_columns(rows):
    data = [(k, i, o, v) for v, (k, i, o) in enumerate([("x", 1, -5), ("x", 2, None), ("x", 2, -(2 ** 63)), ("y", None, 9), ("y", -3, 2 ** 63 - 1), ("y", -3, 0)])]
    df = rows("k string, i int, o long, v long", *data)
    newest = R.latest(df, ["k"], ["i", "o"])
    assert sorted(values(newest, "k", "v")) == [("x", 2), ("y", 4)]
    assert sorted(values(R.keep_first(df, ["k"], ["i", "o"]), "k", "v")) == [("x", 0), ("y", 3)]
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_short_series_are_left_out_whole(rows):
    df = rows("symbol string, frame string, ts long", *[("A", "m1", i) for i in range(61)],
              *[("B", "m1", i) for i in range(60)])
    assert values(min_history(df).groupBy("symbol").count(), "symbol", "count") == [("A", 61)]
    unnamed = df.withColumn("symbol", F.when(F.col("symbol") == "B", "B"))
    assert min_history(unnamed).count() == 61


def test_history_and_live_rows(rows):
    hist = rows("symbol string, frame string, ts long, closeBid double, volume double",
                ("A", "m1", 60, 1.0, 9.0), ("A", "m1", 120, 2.0, 9.0))
    live = rows("symbol string, frame string, ts long, closeBid double", ("A", "m1", 120, 5.0), ("A", "m1", 180, 6.0))
    assert values(R.merge_history(hist, live).orderBy("ts"), "ts", "closeBid", "volume") == [
        (60, 1.0, 9.0), (120, 5.0, None), (180, 6.0, None)]


def test_continuous_open(rows):
    df = rows(BARS, *[("A", "m1", 60 * i, 10.0 + i, 0.0, 0.0, 20.0 + i) for i in range(4)])
    got = R.continuous_open(df, slot=F.floor(F.col("ts") / 60))
    assert values(got.orderBy("ts"), "openBid") == [(10.0,), (20.0,), (21.0,), (22.0,)]
