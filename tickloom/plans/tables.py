"""The given tables in the shapes the operators take, and the same shapes in SQL."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickloom.functions.scalar import epoch_millis, fixed_text
from tickloom.operators.candles import candles
from tickloom.operators.joins import with_interval
from tickloom.schemas import FRAMES, OHLC

H1 = {"H1": FRAMES["H1"]}
SPREAD = 1.0002     # ask / bid
OFFSET = 0.25       # forecast over close
TIME_BITS = {"updated": 60}     # milliseconds of eighteen million years


def load(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_ticks(events):
    """Events as ticks: the event type is the instrument, its value the bid."""
    return events.select(
        F.col("event_type").alias("symbol"), F.col("value").alias("bid"),
        (F.col("value") * SPREAD).alias("ask"), F.col("value").alias("high"),
        F.col("value").alias("low"), epoch_millis("ts").alias("updated"), "event_id")


def ticks(spark, sf_dir, lo=None, hi=None):
    """All ticks, or those from `lo` to `hi` in epoch milliseconds, both included. The bounds are on the
    stored time, so they reach the scan."""
    events = load(spark, sf_dir, "events")
    if lo is not None:
        events = events.filter(F.col("ts") >= stored_time(lo))
    if hi is not None:
        events = events.filter(F.col("ts") < stored_time(hi + 1))
    return as_ticks(events)


def stored_time(millis):
    """Epoch milliseconds as a constant of the type of the stored time."""
    return F.lit(datetime(1970, 1, 1) + timedelta(milliseconds=millis)).cast("timestamp_ntz")


def candles_between(spark, sf_dir, lo, hi=None):
    """Candles of all frames out of the ticks that candles with an end from `lo` to `hi` (epoch seconds) are
    made of. Candles that end before `lo` may be cut and are left out."""
    widest = max(FRAMES.values())
    return candles(ticks(spark, sf_dir, (lo - widest) * 1000, None if hi is None else hi * 1000 - 1)).filter(F.col("ts") >= lo)


def event_stream(spark, sf_dir):
    """The event table as a stream of files. The path is a pattern because a stream takes
    a plain path for a folder, while the table may also be a single file."""
    schema = load(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.[p]arquet")


def tick_stream(spark, sf_dir):
    return as_ticks(event_stream(spark, sf_dir))


def all_candles(spark, sf_dir):
    return candles(ticks(spark, sf_dir))


def hour_candles(spark, sf_dir):
    return candles(ticks(spark, sf_dir), H1)


def as_predictions(bars):
    """A forecast for every candle: its close plus an offset, one frame later."""
    return with_interval(bars).select("symbol", "frame", (F.col("closeBid") + OFFSET).alias("prediction"),
                                      (F.col("ts") + F.col("seconds")).alias("ts"))


def shown(df, columns, places=6):
    """Computed numbers as fixed-decimal text, so that two engines may be compared."""
    return df.select(*[fixed_text(c, places).alias(c) if c in columns else F.col(c) for c in df.columns])


SQL_TICKS = """ticks AS (
  SELECT event_type AS symbol, value AS bid, value * CAST(1.0002 AS DOUBLE) AS ask,
         value AS high, value AS low, epoch_us(ts) // 1000 AS updated, event_id
  FROM events)"""


def sql_candles(frames=FRAMES):
    rows = ", ".join(f"('{name}', {width})" for name, width in frames.items())
    return f"""{SQL_TICKS},
frames(frame, seconds) AS (VALUES {rows}),
placed AS (
  SELECT t.*, frame, updated // 1000 - (updated // 1000) % seconds + seconds AS cts
  FROM ticks t CROSS JOIN frames),
candles AS (
  SELECT symbol, frame,
         first(bid ORDER BY updated, event_id) AS "openBid",
         last(bid ORDER BY updated, event_id) AS "closeBid",
         max(bid) AS "highBid", min(bid) AS "lowBid",
         first(ask ORDER BY updated, event_id) AS "openAsk",
         last(ask ORDER BY updated, event_id) AS "closeAsk",
         max(ask) AS "highAsk", min(ask) AS "lowAsk", CAST(cts AS BIGINT) AS ts
  FROM placed GROUP BY symbol, frame, cts)"""


SQL_ALL = sql_candles()
SQL_H1 = sql_candles(H1)
SQL_PREDICTIONS = """predictions AS (
  SELECT symbol, frame, "closeBid" + 0.25 AS prediction, CAST(ts + seconds AS BIGINT) AS ts
  FROM candles JOIN frames USING (frame))"""
SQL_OHLC = ", ".join(f'"{c}"' for c in OHLC)


def six(expr, name, places=6):
    """SQL twin of ``shown`` for one column."""
    return f"printf('%.{places}f', CAST({expr} AS DOUBLE)) AS {name}"
