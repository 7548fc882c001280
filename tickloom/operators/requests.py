"""The questions a dashboard asks of the stored tables, each as one plan.

The symbol is normalized before the plan is built, so that the comparison is with a
constant and reaches partition folders and file statistics.
"""

import re

from pyspark.sql import functions as F

from tickloom.operators.filters import time_range
from tickloom.operators.projections import news_page, payload
from tickloom.operators.series import keep_first


def plain_symbol(symbol):
    return re.sub(r"[^A-Za-z0-9_]", "", symbol).upper()


def _series(df, symbol, frame, lo, hi, as_of, arrival):
    chosen = time_range(df.filter((F.col("symbol") == plain_symbol(symbol)) & (F.col("frame") == frame)), "ts", lo, hi, as_of)
    if arrival:
        chosen = keep_first(chosen, ["symbol", "frame", "ts"], arrival).drop(arrival)
    return payload(chosen).orderBy("ts")


def candle_history(candles, symbol, frame, lo, hi=None, as_of=None, arrival=None):
    """Candles of a series in an inclusive time range, oldest first. Of several with one time the first by
    the column `arrival` counts; leave it out only for a table with one row per time."""
    return _series(candles, symbol, frame, lo, hi, as_of, arrival)


def forecast_history(forecasts, symbol, frame, lo, hi=None, as_of=None, arrival=None):
    """Stored forecasts of a series in an inclusive time range, oldest first; `arrival` as for candles."""
    return _series(forecasts, symbol, frame, lo, hi, as_of, arrival)


def price_history(prices, symbol, lo, hi=None, as_of=None):
    """Prices of an instrument in an inclusive range of milliseconds, oldest first."""
    chosen = prices.filter(F.col("symbol") == plain_symbol(symbol))
    return payload(time_range(chosen, "updated", lo, hi, as_of, margin=600_000)).orderBy("updated")


def news_feed(news, symbol, offset=0, limit=20):
    """One page of an instrument's news, newest first."""
    return news_page(news.filter(F.col("symbol") == plain_symbol(symbol)), offset, limit)
