import pytest
from conftest import values

from tickloom.operators import candles as C

TICKS = "symbol string, bid double, ask double, updated long, event_id long"
SHOWN = ["symbol", "frame", "openBid", "highBid", "lowBid", "closeBid", "ts"]


def tick(second, bid, event_id=0, symbol="A"):
    return symbol, float(bid), float(bid) + 0.5, int(second * 1000), event_id


def test_boundary_tick_belongs_to_next_candle(rows):
    got = values(C.candles(rows(TICKS, tick(60, 5)), {"m1": 60}), *SHOWN)
    assert got == [("A", "m1", 5.0, 5.0, 5.0, 5.0, 120)]


def test_open_and_close_follow_time_then_tie_break(rows):
    df = rows(TICKS, tick(10, 3, 7), tick(10, 4, 6), tick(20, 1, 9), tick(20, 2, 8))
    assert values(C.candles(df, {"m1": 60}), *SHOWN) == [("A", "m1", 4.0, 4.0, 1.0, 1.0, 60)]


def test_bid_and_ask_are_folded_apart(rows):
    df = rows(TICKS, ("A", 1.0, 9.0, 1000, 1), ("A", 2.0, 3.0, 2000, 2))
    assert values(C.candles(df, {"m1": 60}), "highBid", "highAsk", "lowBid", "lowAsk") == [(2.0, 9.0, 1.0, 3.0)]


def test_quiet_time_gives_no_candle(rows):
    df = rows(TICKS, tick(0, 1), tick(400, 2))
    assert sorted(values(C.candles(df, {"m1": 60}), "ts")) == [(60,), (420,)]


def test_frames_rolled_up_from_short_candles_equal_direct_ones(rows):
    ticks = rows(TICKS, *[tick(s * 17.3, (s * 7919) % 101, s, "AB"[s % 3 == 0]) for s in range(2000)])
    frames = {"m1": 60, "m30": 1800, "H1": 3600}
    together = sorted(values(C.candles(ticks, frames), *SHOWN))
    apart = sorted(r for f, w in frames.items() for r in values(C.candles(ticks, {f: w}), *SHOWN))
    assert together == apart


def test_frames_that_do_not_divide_each_other(rows):
    ticks = rows(TICKS, *[tick(s * 11, (s * 31) % 17, s) for s in range(500)])
    frames = {"m2": 120, "m5": 300}
    together = sorted(values(C.candles(ticks, frames), *SHOWN))
    apart = sorted(r for f, w in frames.items() for r in values(C.candles(ticks, {f: w}), *SHOWN))
    assert together == apart


@pytest.mark.parametrize("width", [60, 86_400, 604_800])
def test_any_number_breaks_ties(rows, width):
    ids = [2 ** 63 - 1, -(2 ** 63), 0, 17, -1, None]
    df = rows(TICKS, *[tick(width - 1, n, i) for n, i in enumerate(ids)])
    assert values(C.candles(df, {"f": width}), "openBid", "closeBid") == [(1.0, 5.0)]
    plan = C.candles(df, {"f": width})._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    live = C.live_candles(df, {"f": width}).orderBy("closeBid")
    assert values(live, "openBid") == [(1.0,)] * 6
    with pytest.raises(ValueError):
        C.candles(df, order=("updated", "event_id", "bid"))


def test_ticks_without_a_symbol_are_a_series(rows):
    df = rows(TICKS, tick(1, 5, 1, None), tick(2, 6, 2, None), tick(70, 7, 3, None))
    assert C.candles(df, {"m1": 60}).count() == 2 and C.live_candles(df, {"m1": 60}).count() == 3
    assert values(C.drop_first_candle(C.candles(df, {"m1": 60})), "ts") == [(120,)]


@pytest.mark.parametrize("slot_seconds", [1, 7, 10, 60, 3600])
def test_live_candle_after_every_tick(rows, slot_seconds):
    data = [tick(s * 0.7, (s * 37) % 23, s) for s in range(300)]
    got = C.live_candles(rows(TICKS, *data), {"m1": 60, "m5": 300}, slot_seconds=slot_seconds)
    want = []
    for frame, width in (("m1", 60), ("m5", 300)):
        bar = {}
        for _, bid, _, ms, i in data:
            end = ms // 1000 // width * width + width
            o, h, low, _ = bar.get(end, (bid, bid, bid, bid))
            bar[end] = (o, max(h, bid), min(low, bid), bid)
            want.append((frame, i, *bar[end], end))
    assert sorted(values(got, "frame", "event_id", "openBid", "highBid", "lowBid", "closeBid", "ts")) == sorted(want)


def test_last_live_candle_is_the_candle(rows):
    from tickloom.operators.series import latest
    ticks = rows(TICKS, *[tick(s * 3.1, (s * 7) % 13, s) for s in range(200)])
    live = latest(C.live_candles(ticks, {"m1": 60}), ["symbol", "frame", "ts"], ["updated", "event_id"])
    assert sorted(values(live, *SHOWN)) == sorted(values(C.candles(ticks, {"m1": 60}), *SHOWN))


def test_first_candle_is_dropped(rows):
    df = rows("symbol string, frame string, ts long", ("A", "m1", 60), ("A", "m1", 120), ("B", "m1", 180))
    assert values(C.drop_first_candle(df), "symbol", "ts") == [("A", 120)]


def test_prices_stay_between_low_and_high(rows):
    ticks = rows(TICKS, *[tick(s * 5.3, (s * 7919) % 997, s) for s in range(1000)])
    wrong = C.candles(ticks).filter("lowBid > openBid OR lowBid > closeBid OR highBid < openBid OR highBid < closeBid")
    assert wrong.count() == 0
