"""Technical indicators as row windows over a candle series.

Each indicator is an expression over a window (so several share one sort) and a DataFrame
operator that applies it with the lookback it needs.
"""

from pyspark.sql import functions as F

from tickloom.operators.series import over_series
from tickloom.schemas import SERIES


def _full(col, w, n, value):
    """`value` once the frame holds n values, null before."""
    return F.when(F.count(col).over(_last(w, n)) == n, value)


def _last(w, n):
    return w.rowsBetween(1 - n, 0)


def sma_over(col, w, n=21):
    return _full(col, w, n, F.avg(col).over(_last(w, n)))


def std_over(col, w, n=21):
    return _full(col, w, n, F.stddev_samp(col).over(_last(w, n)))


def rsi_over(delta, w, n=14):
    """RSI from simple means of gains and losses. Without a loss in the frame it is 100."""
    gain = F.avg(F.greatest(F.col(delta), F.lit(0.0))).over(_last(w, n))
    loss = F.avg(F.greatest(-F.col(delta), F.lit(0.0))).over(_last(w, n))
    return _full(delta, w, n, F.when(loss == 0, F.lit(100.0))
                 .otherwise(100.0 - 100.0 / (1.0 + gain / F.nullif(loss, F.lit(0.0)))))


def candle_shape(df, open_="openBid", high="highBid", low="lowBid", close="closeBid"):
    """Body, sign, lower and upper wick."""
    o, c = F.col(open_), F.col(close)
    return df.withColumns({
        "body": c - o,
        "cosign": (c > o).cast("int"),
        "down": F.least(o, c) - F.col(low),
        "up": F.col(high) - F.greatest(o, c),
    })


def _bands(d, w, col, n, k):
    return _edges(d.withColumns({"bbmid": sma_over(col, w, n), "_std": std_over(col, w, n)}), k)


def _edges(d, k):
    return (d.withColumns({"bbupper": F.col("bbmid") + k * F.col("_std"),
                           "bblower": F.col("bbmid") - k * F.col("_std")})
            .withColumn("bbwidth", F.col("bbupper") - F.col("bblower")).drop("_std"))


def _delta(d, w, col):
    return d.withColumn("delta", F.col(col) - F.lag(col).over(w))


def _rsi(d, w, col, n):
    return _delta(d, w, col).withColumn("rsi", rsi_over("delta", w, n))


def sma(df, n=21, col="closeBid", keys=SERIES, slot=None):
    return over_series(df, n - 1, lambda d, w: d.withColumn("sma", sma_over(col, w, n)), keys, slot=slot)


def bollinger(df, n=21, k=1.96, col="closeBid", keys=SERIES, slot=None):
    """Middle, upper and lower band and their distance."""
    return over_series(df, n - 1, lambda d, w: _bands(d, w, col, n, k), keys, slot=slot)


def delta(df, col="closeBid", keys=SERIES, slot=None):
    """Change against the row before."""
    return over_series(df, 1, lambda d, w: _delta(d, w, col), keys, slot=slot)


def rsi(df, n=14, col="closeBid", keys=SERIES, slot=None):
    return over_series(df, n, lambda d, w: _rsi(d, w, col, n), keys, slot=slot)


def drop_warmup(df, n=22, keys=SERIES, slot=None):
    """Leave out the first n rows of every series."""
    return over_series(df, n, lambda d, w: d.withColumn(
        "_seen", F.count(F.lit(1)).over(w.rowsBetween(-n, 0))), keys, slot=slot).filter(
            F.col("_seen") > n).drop("_seen")


def indicators(df, n=21, k=1.96, rsi_n=14, col="closeBid", keys=SERIES, slot=None):
    """All indicators in one pass: one lookback, one sort."""
    return over_series(df, max(n - 1, rsi_n), lambda d, w: add_indicators(d, w, n, k, rsi_n, col),
                       keys, slot=slot)


def add_indicators(d, w, n=21, k=1.96, rsi_n=14, col="closeBid"):
    """Delta first, then every other window in one step, so that Spark evaluates them
    together over one sorted pass."""
    d = _delta(d, w, col).withColumns({
        "bbmid": sma_over(col, w, n), "_std": std_over(col, w, n), "rsi": rsi_over("delta", w, rsi_n)})
    return candle_shape(_edges(d, k))
