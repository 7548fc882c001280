"""Filters. All compare plain columns with constants, so they reach the scan of a table that stores these
columns. A filter on computed candles does not pass their aggregate: bound the ticks as well."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from tickloom.operators.series import on_statistic
from tickloom.schemas import FRAMES, SERIES


def recent(df, symbol, frame, as_of, seconds=3 * 3600):
    """Candles of one series newer than `seconds` before `as_of` (epoch seconds)."""
    return df.filter((F.col("symbol") == symbol) & (F.col("frame") == frame)
                     & (F.col("ts") > as_of - seconds))


def time_range(df, col, lo, hi=None, as_of=None, margin=60):
    """Inclusive range. Without an upper bound it ends `margin` after `as_of`: 60 for
    candles and forecasts in seconds, 600000 for prices in milliseconds."""
    if hi is None:
        if as_of is None:
            raise ValueError("give an upper bound or the time it is counted from")
        hi = as_of + margin
    return df.filter(F.col(col).between(lo, hi))


def lookback(df, frame, as_of, n=4800, frames=None):
    """Candles of one frame within its last n intervals."""
    return df.filter((F.col("frame") == frame)
                     & (F.col("ts") >= as_of - n * (frames or FRAMES)[frame]))


def exclude_url(df, text, col="url"):
    return df.filter(~F.col(col).contains(text))


def mentions_any(df, col, words):
    """Rows whose text holds one of the words, case-sensitive."""
    return df.filter(reduce(or_, [F.col(col).contains(w) for w in words]))


def valid_predictions(df):
    """Rows with symbol, frame, prediction and time present, not empty and not zero."""
    return df.filter((F.col("symbol") != "") & (F.col("frame") != "")
                     & (F.col("prediction") != 0) & ~F.isnan("prediction") & (F.col("ts") != 0))


def min_history(df, n=61, keys=SERIES, salt_by="ts"):
    """Series with at least n rows, whole. Series are counted first, before any shuffle
    of the rows, and the short table of counts is joined (`on_statistic`)."""
    long_enough = df.groupBy(*keys).count().filter(F.col("count") >= n).drop("count")
    return on_statistic(df, long_enough, keys, "left_semi", salt_by)
