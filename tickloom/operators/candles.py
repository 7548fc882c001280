"""Ticks to candles."""

from decimal import Decimal
from functools import reduce
from math import gcd

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.scalar import candle_end, to_seconds
from tickloom.operators.series import join_keys, on_statistic
from tickloom.schemas import FRAMES, OHLC


def tick_rank(order, width):
    """Order of ticks within a candle as one number. The first column is epoch milliseconds,
    of which only the offset in the candle counts; the second, if there is one, is any 64-bit number that
    breaks ties, null last. A number keeps the aggregate in the hash form, which a struct does
    not. `width` is the candle length in seconds."""
    if not 1 <= len(order) <= 2:
        raise ValueError("ticks are ordered by their time and at most one column that breaks ties")
    offset = F.pmod(F.col(order[0]), F.lit(width * 1000))
    if len(order) == 1:
        return offset
    tie = F.coalesce(F.col(order[1]).cast("decimal(38,0)"), F.lit(Decimal(2 ** 63)))
    return (offset.cast("decimal(38,0)") * F.lit(Decimal(2 ** 65)) + tie).cast("decimal(38,0)")


def ohlc(rank):
    """Aggregates of a candle's eight prices out of bid and ask by tick order."""
    out = []
    for side in ("Bid", "Ask"):
        price = side.lower()
        out += [F.min_by(price, rank).alias("open" + side), F.max_by(price, rank).alias("close" + side),
                F.max(price).alias("high" + side), F.min(price).alias("low" + side)]
    return out


def merge_candles(order):
    """Aggregates that join candles of a short frame to one of a longer frame."""
    out = []
    for side in ("Bid", "Ask"):
        out += [F.min_by("open" + side, order).alias("open" + side),
                F.max_by("close" + side, order).alias("close" + side),
                F.max("high" + side).alias("high" + side), F.min("low" + side).alias("low" + side)]
    return out


def targets(frames, time):
    """For a narrow candle that begins at `time`, the frames and the ends of the candles it is part of."""
    return F.array(*[F.struct(F.lit(name).alias("frame"), candle_end(time, width).alias("end")) for name, width in frames.items()])


def candles(ticks, frames=None, order=("updated", "event_id")):
    """Bid and ask candles of every frame; `ts` is the window end in epoch seconds.

    Ticks are aggregated once, to the longest width that divides all frames; the frames
    are then rolled up from those few rows instead of from the ticks again.
    """
    frames = frames or FRAMES
    base = reduce(gcd, frames.values())
    narrow = (ticks.select("symbol", "bid", "ask", candle_end(to_seconds("updated"), base).alias("ts"),
                           tick_rank(order, base).alias("_rank"))
              .groupBy("symbol", "ts").agg(*ohlc("_rank")))
    if list(frames.values()) == [base]:
        return narrow.select("symbol", F.lit(next(iter(frames))).alias("frame"), *OHLC, "ts")
    return (narrow.withColumn("_to", F.explode(targets(frames, F.col("ts") - base)))
            .select("symbol", F.col("_to.frame").alias("frame"), F.col("_to.end").alias("_end"), "ts", *OHLC)
            .groupBy("symbol", "frame", F.col("_end")).agg(*merge_candles("ts"))
            .select("symbol", "frame", *OHLC, F.col("_end").alias("ts")))


def in_slots(ticks, slot_seconds, order):
    """Ticks with the start of their slot and their rank in it."""
    return ticks.select("symbol", "bid", "ask", *order, (candle_end(to_seconds("updated"), slot_seconds) - slot_seconds).alias("_slot"),
                        tick_rank(order, slot_seconds).alias("_rank"))


def live_candles(ticks, frames=None, order=("updated", "event_id"), slot_seconds=10):
    """The forming candle after every tick: one row per tick and frame.

    Time is cut into slots that divide every frame. Ticks are shuffled and sorted once, by
    instrument and slot; what a candle of each frame held before the slot comes from a
    table with one row per slot, so a busy candle is many tasks and a further frame costs
    no further sort of the ticks.
    """
    frames = frames or FRAMES
    slot_seconds = gcd(slot_seconds, *frames.values())
    spread = in_slots(ticks, slot_seconds, order)
    per_slot = spread.groupBy("symbol", "_slot").agg(*ohlc("_rank"))
    before = (Window.partitionBy("symbol", "_to").orderBy("_slot")
              .rowsBetween(Window.unboundedPreceding, -1))
    merges = [(kind + side, merge) for side in ("Bid", "Ask")
              for kind, merge in (("open", F.first), ("high", F.max), ("low", F.min))]
    names = [name for name, _ in merges]
    carried = (per_slot.withColumn("_to", F.explode(targets(frames, "_slot")))
               .select("symbol", "_slot", "_to.frame", F.col("_to.end").alias("ts"), *[merge(c).over(before).alias(c) for c, merge in merges])
               .groupBy("symbol", "_slot")
               .agg(F.collect_list(F.struct("frame", "ts", *names)).alias("_past")))
    return ticks_on_past(spread, carried, order)


def ticks_on_past(ticks, carried, order):
    """The forming candle after every tick of a slot. `carried` has, for each instrument and slot, as `_past` what the candle of each frame held
    before the slot; of a frame that is missing there nothing comes."""
    within = (Window.partitionBy("symbol", "_slot").orderBy("_rank")
              .rowsBetween(Window.unboundedPreceding, 0))
    run = {}
    for price in ("bid", "ask"):
        run |= {f"_open_{price}": F.first(price).over(within), f"_high_{price}": F.max(price).over(within),
                f"_low_{price}": F.min(price).over(within)}
    shown = []
    for side in ("Bid", "Ask"):
        price = side.lower()
        shown += [F.coalesce(F.col("_p.open" + side), f"_open_{price}").alias("open" + side),
                  F.col(price).alias("close" + side),
                  F.greatest("_p.high" + side, f"_high_{price}").alias("high" + side),
                  F.least("_p.low" + side, f"_low_{price}").alias("low" + side)]
    return (join_keys(ticks, carried, ["symbol", "_slot"]).withColumns(run)
            .withColumn("_p", F.explode("_past"))
            .select("symbol", "_p.frame", *shown, "_p.ts", *order))


def drop_first_candle(df, keys=("symbol", "frame")):
    """Leave out the first candle of every series, which may have begun before the data."""
    starts = df.groupBy(*keys).agg(F.min("ts").alias("_start"))
    return on_statistic(df, starts, keys).filter("ts > _start").select(*df.columns)
