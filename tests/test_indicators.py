import numpy as np
import pandas as pd
import pytest
from conftest import values
from pyspark.sql import functions as F
from test_series import BARS, gappy

from tickloom.operators import features as X
from tickloom.operators import indicators as I
from tickloom.schemas import FEATURES


def reference_frame(bars):
    """The indicator rules in pandas, for one series sorted by time."""
    d = pd.DataFrame(bars, columns=["symbol", "frame", "ts", "openBid", "highBid", "lowBid", "closeBid"])
    close, open_ = d.closeBid, d.openBid
    mean, std = close.rolling(21).mean(), close.rolling(21).std()
    d["bbmid"], d["bbupper"], d["bblower"] = mean, mean + 1.96 * std, mean - 1.96 * std
    d["body"] = close - open_
    d["cosign"] = (close > open_).astype(int)
    d["down"] = np.minimum(close, open_) - d.lowBid
    d["up"] = d.highBid - np.maximum(close, open_)
    change = close.diff()
    gain, loss = change.clip(lower=0).rolling(14).mean(), (-change.clip(upper=0)).rolling(14).mean()
    d["rsi"] = np.where(loss.isna(), np.nan, np.where(loss == 0, 100.0, 100 - 100 / (1 + gain / loss.replace(0, np.nan))))
    return d


def series(symbol="A", closes=()):
    return [(symbol, "m1", 60 * (i + 1), c - 0.5, c + 1.0, c - 1.0, c) for i, c in enumerate(map(float, closes))]


def test_all_indicators_match_pandas(rows):
    data = gappy(7)
    got = I.indicators(rows(BARS, *data)).toPandas()
    for symbol in ("HOT", "B", "C"):
        want = reference_frame([r for r in data if r[0] == symbol])
        have = got[got.symbol == symbol].sort_values("ts")
        for c in ("bbmid", "bbupper", "bblower", "body", "cosign", "down", "up", "rsi"):
            np.testing.assert_allclose(have[c].to_numpy(float), want[c].to_numpy(float), rtol=0, atol=1e-8)


def test_flat_series(rows):
    got = I.indicators(rows(BARS, *series(closes=[5.0] * 40))).orderBy("ts")
    last = got.collect()[-1]
    assert last["rsi"] == 100.0 and last["bbwidth"] == 0.0


def test_warm_up(rows):
    got = I.drop_warmup(rows(BARS, *series(closes=range(30)))).orderBy("ts")
    assert values(got, "ts") == [(60 * i,) for i in range(23, 31)]


def test_block_is_rows_51_to_60_of_61(rows):
    got = X.last_block(rows(BARS, *series(closes=range(61)))).orderBy("ts")
    assert values(got, "ts") == [(60 * i,) for i in range(51, 61)]


def expected_block(data, end):
    d = reference_frame(data)[FEATURES].iloc[end - 10:end].to_numpy(float)
    mid = (d[-1][3] + d[-1][0]) / 2
    d[:, :6] -= mid
    d[:, :9] *= 100000
    return d, mid


def test_rolling_blocks_match_pandas(rows):
    data = [r for r in gappy(8, 90) if r[0] == "HOT"]
    got = {r["ts"]: r for r in X.rolling_blocks(rows(BARS, *data)).collect()}
    assert sorted(got) == [r[2] for r in data[60:]]
    for i in range(60, 90):
        block, mid = expected_block(data, i)
        np.testing.assert_allclose(np.array(got[data[i][2]]["block"]), block, rtol=0, atol=1e-3)
        assert abs(got[data[i][2]]["mid"] - mid) < 1e-9


def test_newest_block_is_the_last_rolling_one(rows):
    df = rows(BARS, *gappy(9, 100))
    new, = X.newest_blocks(df).collect()
    last = X.rolling_blocks(df).orderBy("ts").collect()[-1]
    assert (new["symbol"], new["ts"]) == (last["symbol"], last["ts"]) and abs(new["mid"] - last["mid"]) < 1e-9
    np.testing.assert_allclose(np.array(new["block"]), np.array(last["block"]), rtol=0, atol=1e-3)


def test_sixty_candles_give_no_forecast_and_sixty_one_give_one(rows):
    model = X.linear_model([0.0] * 100, 12.5)
    df = rows(BARS, *series("S", range(60)), *series("L", range(61)))
    for every in (False, True):
        got = values(X.forecast(df, model, every=every), "symbol", "frame", "prediction", "ts")
        mid = (59 + 58.5) / 2
        assert got == [("L", "m1", round(mid + 12 / 100000, 5), 61 * 60 + 60)]


def test_scaler_there_and_back(rows):
    blocks = X.rolling_blocks(rows(BARS, *gappy(10, 120)))
    last_close = lambda x: x[:, -1, 3]     # a local function travels to the workers whole
    for kind in ("standard", "minmax"):
        scaler = X.fit_scaler(blocks, kind)
        plain = X.forecast_blocks(blocks, last_close)
        scaled = X.forecast_blocks(blocks, last_close, scaler)
        assert sorted(values(plain, "ts", "prediction")) == sorted(values(scaled, "ts", "prediction"))


def test_model_is_loaded_by_the_worker(rows):
    def load():
        return lambda x: x.sum(axis=(1, 2)) * 0 + 7
    load.load = True
    blocks = X.rolling_blocks(rows(BARS, *gappy(11, 70)))
    assert {r["out"] for r in X.score(blocks, load).collect()} == {7.0}


def test_a_model_for_each_series(rows):
    def seven():
        return lambda x: x.sum(axis=(1, 2)) * 0 + 7
    seven.load = True
    data = [(s, "m1", *row[2:]) for s in ("A", "B", "C") for row in gappy(11, 70)[:70]]
    blocks = X.rolling_blocks(rows(BARS, *data).dropDuplicates(["symbol", "ts"]))
    models = {("A", "m1"): seven, ("B", "m1"): lambda x: x[:, -1, -1]}
    got = {}
    for r in X.score(blocks, models).collect():
        got.setdefault(r["symbol"], []).append((r["out"], r["block"][-1][-1]))
    assert {o for o, _ in got["A"]} == {7.0} and all(o == last for o, last in got["B"]) and {o for o, _ in got["C"]} == {None}


def test_fitted_model_recovers_a_line(rows):
    from pyspark.sql import functions as F
    blocks = X.rolling_blocks(rows(BARS, *gappy(12, 400))).withColumn("label", F.col("block")[9][9] * 0.5 + 3)
    scored = X.score(blocks, X.fit_linear(blocks, "label"))
    worst = scored.agg(F.max(F.abs(F.col("out") - F.col("label")))).first()[0]
    spread = scored.agg(F.stddev("label")).first()[0]
    assert worst < spread * 1e-3


def test_rmse(rows):
    assert values(X.rmse(rows("prediction double, truth double", (1.0, 4.0), (2.0, 6.0))), "rmse")[0][0] == 12.5 ** 0.5


def test_half_points_round_to_even(rows):
    df = rows("mid double, diff double", (1.0, 2.5), (1.0, 3.5))
    assert values(X.denormalize(df), "prediction") == [(1.00002,), (1.00004,)]


def test_recurrent_scores_equal_a_plain_loop(rows):
    import math
    import random

    from tickloom.operators import recurrent as R
    draw, hidden = random.Random(1), 3
    weights = {s: [draw.uniform(-0.5, 0.5) for _ in range(R.weight_count(hidden))] for s in ("A", "B")}
    blocks = [(s, "m1", 60 * k, [[draw.uniform(-2, 2) for _ in range(10)] for _ in range(10)]) for s in ("A", "B", None) for k in range(25)] + [("A", "m1", 9999, None)]

    def plain(block, w):
        wide = 4 * hidden
        given, own, bias, answer = w[:10 * wide], w[10 * wide:(10 + hidden) * wide], w[(10 + hidden) * wide:(11 + hidden) * wide], w[(11 + hidden) * wide:]
        h, c = [0.0] * hidden, [0.0] * hidden
        for row in block:
            z = [sum(v * given[k * wide + j] for k, v in enumerate(row)) + sum(v * own[k * wide + j] for k, v in enumerate(h)) + bias[j] for j in range(wide)]
            gate = [1 / (1 + math.exp(-v)) for v in z]
            c = [gate[hidden + j] * c[j] + gate[j] * math.tanh(z[3 * hidden + j]) for j in range(hidden)]
            h = [gate[2 * hidden + j] * math.tanh(c[j]) for j in range(hidden)]
        return sum(a * b for a, b in zip(answer, h)) + answer[-1]

    df = rows("symbol string, frame string, ts long, block array<array<double>>", *blocks).repartition(3)
    models = rows("symbol string, frame string, weights array<double>", *[(s, "m1", w) for s, w in weights.items()])
    for slot in (None, F.floor(F.col("ts") / 300)):
        got = {(r["symbol"], r["ts"]): r["out"] for r in R.score_by_series(df, models, hidden, slot=slot).collect()}
        assert len(got) == len(blocks)
        for s, _, ts, block in blocks:
            if s is None or block is None:
                assert got[s, ts] is None
            else:
                assert abs(got[s, ts] - plain(block, weights[s])) < 1e-9
    with pytest.raises(ValueError):
        R.recurrent(np.ones((1, 10, 10)), [1.0], hidden)

