"""Model input blocks and forecasts.

A block is ten consecutive rows of the ten feature columns. For training and backfill
every candle gets its block (``rolling_blocks``); for the newest forecast only the last
rows of a series are kept first (``last_block``).
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import fixed_round, fixed_text, frame_seconds
from tickloom.operators.indicators import add_indicators
from tickloom.operators.series import last_rows, on_statistic, over_series
from tickloom.schemas import FEATURES, SERIES

POINTS = 100_000     # price units per point
CENTRED = FEATURES[:6]
SCALED = FEATURES[:9]


def feature_columns(df, keys=SERIES):
    """Feature columns in order, after the keys and the time."""
    return df.select(*keys, "ts", *FEATURES)


def last_block(df, n=10, skip=1, keys=SERIES):
    """The n rows before the newest `skip` rows of every series."""
    return last_rows(df, n, keys, skip=skip)


def _normalized(field, mid):
    """Feature columns centred on `mid` and in points; rsi stays as it is."""
    out = []
    for name in FEATURES:
        value = field(name)
        if name in CENTRED:
            value = value - mid
        out.append((value * POINTS if name in SCALED else value).alias(name))
    return out


def normalize_block(df, keys=SERIES):
    """Centre a block on the mid of its last row and scale it to points. Every series holds
    one block here, so the windows are ten rows long."""
    block = Window.partitionBy(*keys)
    mid = F.max_by((F.col("closeBid") + F.col("openBid")) / 2, F.col("ts")).over(block)
    return (df.withColumn("mid", mid)
            .select(*keys, "ts", "mid", *_normalized(F.col, F.col("mid"))))


def assemble(df, keys=SERIES):
    """One matrix per series out of its normalized block rows."""
    row = F.struct("ts", F.array(*FEATURES).alias("v"))
    return (df.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"), F.max("mid").alias("mid"))
            .select(*keys, F.element_at("_rows", -1)["ts"].alias("ts"), "mid",
                    F.transform("_rows", lambda r: r["v"]).alias("block")))


def rolling_blocks(candles, n=10, skip=1, history=61, keys=SERIES, slot=None):
    """A normalized block for every candle that has `history` candles up to it. `ts` is the
    newest candle; the block ends `skip` rows before it."""
    def add(d, w):
        rows = w.rowsBetween(-(n + skip - 1), -skip)
        seen = F.count(F.lit(1)).over(w.rowsBetween(1 - history, 0))
        d = add_indicators(d, w)
        return (d.withColumn("_block", F.collect_list(F.struct("ts", *FEATURES)).over(rows))
                .withColumn("_seen", seen))

    picked = candles.select(*keys, "ts", "openBid", "highBid", "lowBid", "closeBid")
    last = F.element_at("_block", -1)
    # The rsi is known at every block row when `history` covers its warm-up.
    return (over_series(picked, history - 1, add, keys, slot=slot)
            .filter(F.col("_seen") == history)
            .withColumn("mid", (last["closeBid"] + last["openBid"]) / 2)
            .select(*keys, "ts", "mid", F.transform("_block", lambda r: F.array(
                *_normalized(lambda name: r[name], F.col("mid")))).alias("block")))


def newest_blocks(candles, n=10, skip=1, history=61, keys=SERIES):
    """The block of the newest candle of every series with enough history. Only the last
    `history` rows of a series leave the map side, so the windows are short."""
    recent = last_rows(candles.select(*keys, "ts", "openBid", "highBid", "lowBid", "closeBid"), history, keys)
    w = Window.partitionBy(*keys).orderBy("ts")
    whole = Window.partitionBy(*keys)
    full = (add_indicators(recent, w)
            .withColumns({"_seen": F.count(F.lit(1)).over(whole), "_newest": F.max("ts").over(whole)})
            .filter(F.col("_seen") == history))
    named = [*keys, "_newest"]          # the same for all rows of a series
    blocks = assemble(normalize_block(last_block(full, n, skip, keys), named), named)
    return blocks.select(*keys, F.col("_newest").alias("ts"), "mid", "block")


def fit_scaler(blocks, kind="standard", keys=SERIES):
    """Centre and spread of every feature per series: one row per series, aggregated over
    all block rows. `kind` is ``standard`` (mean, population deviation) or ``minmax``."""
    rows = blocks.select(*keys, F.explode("block").alias("v"))
    centre, spread = [], []
    for i in range(len(FEATURES)):
        v = F.col("v")[i]
        if kind == "standard":
            centre.append(F.avg(v))
            spread.append(F.stddev_pop(v))
        elif kind == "minmax":
            centre.append(F.min(v))
            spread.append(F.max(v) - F.min(v))
        else:
            raise ValueError(f"no scaler called {kind}")
    stats = rows.groupBy(*keys).agg(F.array(*centre).alias("centre"), F.array(*spread).alias("spread"))
    # A constant column has no spread; it is only centred.
    return stats.withColumn("spread", F.transform("spread", lambda s: F.when(s == 0, 1.0).otherwise(s)))


def scale(blocks, scaler, keys=SERIES):
    """Scaled blocks; centre and spread stay on the row for the way back."""
    return (on_statistic(blocks, scaler, keys)
            .withColumn("block", F.transform("block", lambda row: F.transform(
                row, lambda x, i: (x - F.get("centre", i)) / F.get("spread", i)))))


def unscale(col, feature="closeBid"):
    """A model output back to points, by the scale of one feature."""
    i = FEATURES.index(feature)
    return F.col(col) * F.col("spread")[i] + F.col("centre")[i]


def score(df, model, block="block", out="out", keys=SERIES):
    """Add the model's answer to every block. `model` maps an array (rows, steps, columns)
    to a vector. To load weights once per worker, pass a function with the attribute
    ``load = True`` that returns the model. For a model of its own per series, pass a dict from the
    values of `keys` to such functions: a task loads each once, when it first meets the series, and a series without
    a model gets null. Only the block column, and the keys in that case, travel to Python."""
    if isinstance(model, dict):
        return df.withColumn(out, _score_by_series(model)(F.struct(*keys), F.flatten(block)))

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np
        predict = model() if getattr(model, "load", False) else model
        for flat in batches:
            if len(flat) == 0:
                yield pd.Series([], dtype="float64")
                continue
            x = np.stack(flat.to_numpy())
            yield pd.Series(np.asarray(predict(x.reshape(len(x), -1, 10)), dtype="float64").reshape(-1))

    return df.withColumn(out, run(F.flatten(block)))


def _score_by_series(models):
    """Answers of the model of each row's series."""
    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.DataFrame, pd.Series]]) -> Iterator[pd.Series]:
        import numpy as np
        loaded = {}
        for series, flat in batches:
            answer = pd.Series(np.nan, index=flat.index, dtype="float64").astype("Float64")
            for key, rows in flat.groupby([series[c] for c in series.columns], dropna=False):
                if key not in models:
                    answer[rows.index] = pd.NA
                    continue
                if key not in loaded:
                    loaded[key] = models[key]() if getattr(models[key], "load", False) else models[key]
                x = np.stack(rows.to_numpy())
                answer[rows.index] = np.asarray(loaded[key](x.reshape(len(x), -1, 10)), dtype="float64").reshape(-1)
            yield answer
    return run


def linear_model(weights, bias=0.0):
    """Model that weighs the cells of a block; the function travels whole to the workers."""
    weights = [float(w) for w in weights]

    def predict(x):
        import numpy as np
        return x.reshape(len(x), -1) @ np.array(weights) + bias
    return predict


def fit_line(blocks, label, column="body", block="block"):
    """A model out of one cell, a column of the newest block row: its least-squares line, by one aggregate."""
    at = FEATURES.index(column)
    x = F.element_at(block, -1)[at]
    slope, start = blocks.agg(F.regr_slope(label, x), F.regr_intercept(label, x)).first()
    weights = [0.0] * 100
    weights[90 + at] = slope or 0.0
    return linear_model(weights, start or 0.0)


def fit_linear(blocks, label, block="block"):
    """Fit the default model by least squares on Spark ML; returns a model for `score`."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import LinearRegression
    data = blocks.select(array_to_vector(F.flatten(block)).alias("features"), F.col(label).alias("label"))
    fitted = LinearRegression(solver="normal", regParam=1e-6, elasticNetParam=0.0).fit(data)
    return linear_model(fitted.coefficients.toArray(), float(fitted.intercept))


def denormalize(df, diff="diff", mid="mid", out="prediction"):
    """Whole points, half to even, on top of the mid; five decimals."""
    return df.withColumn(out, fixed_round(F.col(mid) + F.bround(F.col(diff)) / POINTS))


def prediction_rows(df, frames=None):
    """Forecast records: the time is one frame after the newest candle."""
    return df.select("symbol", "frame", "prediction",
                     (F.col("ts") + frame_seconds("frame", frames)).alias("ts"))


def stored_forecasts(df):
    """Forecast records as they are stored: the value as the shortest text of five decimals."""
    short = F.regexp_replace(fixed_text("prediction"), r"\.?0+$", "")
    return df.select("symbol", "frame", "ts", short.alias("closeBid"))


def forecast(candles, model, scaler=None, every=False, history=61, frames=None, slot=None):
    """Forecasts of the next close: for the newest candle of every series, or for every
    candle with enough history. Series with fewer than `history` candles give no row."""
    blocks = (rolling_blocks(candles, history=history, slot=slot) if every
              else newest_blocks(candles, history=history))
    return forecast_blocks(blocks, model, scaler, frames)


def forecast_blocks(blocks, model, scaler=None, frames=None):
    """Forecasts of blocks. `model` is one for `score`, or any function of the blocks that adds the column `out`, marked by
    ``of_blocks = True``."""
    answer = model if getattr(model, "of_blocks", False) else lambda b: score(b, model)
    if scaler is None:
        scored = answer(blocks).withColumn("diff", F.col("out"))
    else:
        scored = answer(scale(blocks, scaler)).withColumn("diff", unscale("out"))
    return prediction_rows(denormalize(scored), frames)


def rmse(df, predicted="prediction", truth="truth"):
    """Root of the mean squared difference, as one row."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(predicted) - F.col(truth), 2))).alias("rmse"))
