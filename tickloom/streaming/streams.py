"""Structured Streaming forms of the operators.

Watermarks come first, before deduplication and windows, so that state can expire. Where a row depends on rows before it, its key's
state gets short summaries of a batch and the rows themselves meet what it carries over in a join (`rows_and_carry`).
"""

from functools import reduce
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tickloom.functions.scalar import event_time
from tickloom.operators.candles import in_slots, merge_candles, ohlc, targets, tick_rank, ticks_on_past
from tickloom.operators.features import forecast_blocks, rolling_blocks
from tickloom.operators.panes import MERGED, pane_aggregates, window_runs
from tickloom.operators.series import join_keys, latest
from tickloom.schemas import FRAMES, OHLC, SERIES

EVENT_TIME = "spark.watermarkDelayMs"       # mark of an event time column, which a computed column does not inherit


def write_batch(rows, path, batch_id):
    """Append the rows of a batch as a folder of its own; a replay replaces it."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{path}/batch={batch_id}")


def with_event_time(df, delay="0 seconds", millis=None, seconds="ts"):
    """Event time column with a watermark, from epoch milliseconds or seconds."""
    time = F.timestamp_millis(F.col(millis)) if millis else event_time(seconds)
    return df.withColumn("timestamp", time).withWatermark("timestamp", delay)


def candle_stream(ticks, frame, delay="3 seconds", order=("updated", "event_id"), frames=None):
    """Candles of one frame. In append mode a candle comes once, when the watermark has
    passed its end; in update mode it comes after every batch that changed it. Ticks
    behind the watermark are dropped."""
    width = (frames or FRAMES)[frame]
    timed = with_event_time(ticks, delay, millis="updated").withColumn("_rank", tick_rank(order, width))
    return (timed.groupBy(F.window("timestamp", f"{width} seconds").alias("window"), "symbol")
            .agg(*ohlc("_rank"))
            .select("symbol", F.lit(frame).alias("frame"), *OHLC,
                    F.unix_seconds("window.end").alias("ts")))


def candle_streams(ticks, frames=None, delay="3 seconds", order=("updated", "event_id")):
    """Closed candles of all frames as one stream, each when the watermark has passed its end.

    Two chained aggregates over one source: ticks become candles of the longest width that divides all frames, which is done once, and a closed
    narrow candle is added to the candle of every frame. The end of that candle is the event time of the second aggregate. It is a
    computed column, so it is marked as such by hand: `window` allows one length only."""
    frames = frames or FRAMES
    base = reduce(gcd, frames.values())
    timed = with_event_time(ticks, delay, millis="updated").withColumn("_rank", tick_rank(order, base))
    narrow = (timed.groupBy(F.window("timestamp", f"{base} seconds").alias("window"), "symbol").agg(*ohlc("_rank"))
              .select("symbol", *OHLC, F.unix_seconds("window.end").alias("ts"))
              .withColumn("_to", F.explode(targets(frames, F.col("ts") - base))))
    end = event_time("_to.end").alias("_end", metadata={EVENT_TIME: 0})
    return (narrow.select("symbol", F.col("_to.frame").alias("frame"), end, "ts", *OHLC)
            .groupBy("_end", "symbol", "frame").agg(*merge_candles("ts"))
            .select("symbol", "frame", *OHLC, F.unix_seconds("_end").alias("ts")))


def dedup_stream(df, keys=("timestamp", "frame", "symbol"), delay="0 seconds", seconds="ts"):
    """One record per key while the watermark has not passed it by `delay`."""
    return with_event_time(df, delay, seconds=seconds).dropDuplicatesWithinWatermark(list(keys))


def sliding_stream(df, size, step, delay="0 seconds", keys=SERIES, value="closeBid"):
    """Panes of sliding windows of `size` seconds that begin at every multiple of `step`, for update mode. The state has one row for
    each pane, whatever the size over the step, and loses it when the watermark has passed the pane by `delay`. `sliding_to_files`
    makes windows of them."""
    width = gcd(size, step)
    timed = with_event_time(df.filter(F.col("ts").isNotNull()), delay)
    return (timed.groupBy(F.window("timestamp", f"{width} seconds").alias("window"), *keys).agg(*pane_aggregates(value))
            .select(*keys, F.unix_seconds("window.start").alias("pane"), *MERGED))


def sliding_to_files(panes, path, checkpoint, size, step, keys=SERIES, **trigger):
    """Write the changed panes of every batch to `path`/panes and, to `path`/windows, the runs of windows that hold one of them. A batch
    reads the panes at most one window away from its own; a replay replaces what it wrote."""
    spark = panes.sparkSession

    def run(batch, batch_id):
        write_batch(batch, f"{path}/panes", batch_id)
        low, high = spark.read.parquet(f"{path}/panes/batch={batch_id}").agg(F.min("pane"), F.max("pane")).first()
        if low is None:
            return
        near = spark.read.parquet(f"{path}/panes").filter(F.col("batch") <= batch_id).filter(F.col("pane").between(low - size, high + size))
        newest = latest(near, [*keys, "pane"], "batch")
        runs = window_runs(newest, size, step, keys, MERGED | {"batch": lambda: F.max("batch")})
        write_batch(runs.filter(F.col("batch") == batch_id).drop("batch"), f"{path}/windows", batch_id)

    return (panes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(run)
            .trigger(**(trigger or {"availableNow": True})).start())


def latest_stream(df, keys=("symbol",), order=("updated",), bits=None):
    """Newest record per key, for update mode; `bits` as for `latest`."""
    return latest(df, keys, order, bits)


def to_files(stream, path, checkpoint, mode="append", **trigger):
    """Write every micro-batch as a folder. In update mode a key comes back in later
    batches; ``final_state`` keeps the last of them."""
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(lambda rows, batch_id: write_batch(rows, path, batch_id))
            .trigger(**(trigger or {"availableNow": True})).start())


def final_state(spark, path, keys):
    """Last emitted row per key of an update-mode stream."""
    return latest(spark.read.parquet(path), keys, "batch").drop("batch")


def rows_and_carry(rows, summaries, keys, carry, carried, state):
    """A stream whose batches hold both its rows and what earlier batches left for them.

    A batch is read twice. Once as it is (`_carried` is null); and once as short `summaries` that tasks make by themselves, of which those of a key meet in
    `carry`, a function of the key, their pandas frame and the state before that gives the columns `carried` and the new state. Only
    these go through one task per key; rows meet their carry by a join inside the batch. State is in Spark's store."""
    def step(key, parts, held):
        out, new = carry(key, pd.concat(list(parts), ignore_index=True), held.get if held.exists else None)
        if new is not None:
            held.update(new)
        yield out

    kinds = T.StructType([f for f in summaries.schema if f.name in keys])
    schema = T.StructType([*kinds, *T.StructType.fromDDL(carried)])
    past = summaries.groupBy(*keys).applyInPandasWithState(step, schema, state, "append", GroupStateTimeout.NoTimeout)
    packed = past.select(F.struct(*schema.fieldNames()).alias("_carried"))
    return rows.select(F.struct(*rows.columns).alias("_row")).unionByName(packed, allowMissingColumns=True)


def to_batches(stream, run, checkpoint, **trigger):
    """Run a function of (rows, carried, batch id) on every batch of `rows_and_carry`. The batch is kept meanwhile, so its state
    function runs once."""
    def batch_of(both, batch_id):
        both.persist()
        try:
            run(both.filter("_row is not null").select("_row.*"), both.filter("_carried is not null").select("_carried.*"), batch_id)
        finally:
            both.unpersist()

    return (stream.writeStream.foreachBatch(batch_of).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def live_stream(ticks, path, checkpoint, frames=None, order=("updated", "event_id"), slot_seconds=10, **trigger):
    """The forming candle after every tick, of all frames, a folder per batch: what `live_candles` gives, across batches.

    The state of an instrument is its forming candle of each frame. A batch sends it one summary per slot and task, and ticks are merged
    with what their candle held before their slot. A tick of a candle older than the forming one is too late and left out; among ticks
    of one candle the batch counts before the time."""
    frames = frames or FRAMES
    slot_seconds = gcd(slot_seconds, *frames.values())
    widths, names = list(frames.values()), list(frames)
    sides = ["Bid", "Ask"]
    prices = [kind + side for side in sides for kind in ("open", "high", "low")]
    spread = in_slots(ticks, slot_seconds, order)

    def summarise(parts):
        for rows in parts:
            rows = rows.sort_values("_rank", kind="stable")
            groups = rows.groupby(["symbol", "_slot"], dropna=False, sort=False)
            yield groups.agg(_rank=("_rank", "first"), openBid=("bid", "first"), highBid=("bid", "max"), lowBid=("bid", "min"),
                             openAsk=("ask", "first"), highAsk=("ask", "max"), lowAsk=("ask", "min")).reset_index()

    def carry(key, parts, held):
        parts = parts.sort_values(["_slot", "_rank"], kind="stable")
        how = {name: {"open": "first", "high": "max", "low": "min"}[name[:-3]] for name in prices}
        ends, now = (list(held[0]), [list(p) for p in np.reshape(held[1], (len(widths), len(prices)))]) if held else ([0] * len(widths), [None] * len(widths))
        out = []
        for slot, values in parts.groupby("_slot").agg(how).iterrows():
            slot = int(slot)
            for k, width in enumerate(widths):
                end = slot - slot % width + width
                if end < ends[k]:
                    continue
                past = now[k] if end == ends[k] else None
                out.append((key[0], slot, names[k], end, *(past or [None] * len(prices))))
                own = [float(values[name]) for name in prices]
                now[k] = own if past is None else [p if kind == 0 else max(p, v) if kind == 1 else min(p, v) for kind, p, v in zip([0, 1, 2] * 2, past, own)]
                ends[k] = end
        state = (ends, [float(p) for candle in now for p in candle]) if all(now) else None
        return pd.DataFrame(out, columns=["symbol", "_slot", "frame", "ts", *prices]), state

    short = spread.select("symbol", "_slot", F.col("_rank").cast("decimal(38,0)").alias("_rank"), "bid", "ask")
    summary = f"symbol string, _slot long, _rank decimal(38,0), {', '.join(f'{p} double' for p in prices)}"
    both = rows_and_carry(spread, short.mapInPandas(summarise, summary), ["symbol"], carry,
                          f"_slot long, frame string, ts long, {', '.join(f'{p} double' for p in prices)}", "ends array<long>, prices array<double>")

    def run(rows, carried, batch_id):
        past = carried.groupBy("symbol", "_slot").agg(F.collect_list(F.struct("frame", "ts", *prices)).alias("_past"))
        write_batch(ticks_on_past(rows, past, order), path, batch_id)

    return to_batches(both, run, checkpoint, **trigger)


def monotonic_stream(stream, path, checkpoint, keys=SERIES, ts="ts", arrival="arrival", slot_size=100_000, **trigger):
    """Write the rows whose time exceeds every earlier time of their key and zero, in arrival order, a folder per batch. The state of a key is
    its greatest time. A batch sends it one maximum per arrival slot and task and gets back the greatest time before each slot; the rows of
    a slot are judged on their own, so a key with very many rows is many tasks."""
    keys = list(keys)
    rows = stream.filter(F.col(ts).isNotNull()).withColumn("_slot", F.floor(F.col(arrival) / slot_size))

    def summarise(parts):
        for part in parts:
            yield part.groupby([*keys, "_slot"], dropna=False, sort=False)["_top"].max().reset_index()

    def carry(key, parts, held):
        tops = parts.groupby("_slot")["_top"].max().sort_index()
        top = held[0] if held else 0
        before = tops.cummax().shift(fill_value=top).clip(lower=top)
        out = pd.DataFrame({**{k: [v] * len(tops) for k, v in zip(keys, key)}, "_slot": tops.index, "_past": before.to_numpy()})
        return out, (int(max(top, tops.max())),)

    short = rows.select(*keys, "_slot", F.col(ts).cast("long").alias("_top"))
    both = rows_and_carry(rows, short.mapInPandas(summarise, short.schema), keys, carry, "_slot long, _past long", "top long")
    before = Window.partitionBy(*keys, "_slot").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)

    def run(batch, carried, batch_id):
        seen = join_keys(batch, carried, [*keys, "_slot"]).withColumn("_seen", F.greatest("_past", F.max(ts).over(before)))
        write_batch(seen.filter(F.col(ts) > F.col("_seen")).select(*stream.columns), path, batch_id)

    return to_batches(both, run, checkpoint, **trigger)


def forecast_stream(candles, model, path, checkpoint, scaler=None, history=61, frames=None, **trigger):
    """Write a forecast for every new candle, a folder per batch. The state of a series is its last `history` candles; a batch touches the series it has
    candles of, sends the state the newest few that each task has, and gets back the candles before its own."""
    prices = ["openBid", "highBid", "lowBid", "closeBid"]
    picked = candles.select(*SERIES, "ts", *prices)

    def newest(parts):
        for part in parts:
            yield part.sort_values("ts", kind="stable").groupby(list(SERIES), dropna=False, sort=False).tail(history)

    def carry(key, parts, held):
        ring = pd.DataFrame(dict(zip(["ts", *prices], held)) if held else {"ts": [], **{p: [] for p in prices}}).astype({"ts": "int64"})
        both = pd.concat([ring, parts[["ts", *prices]]] if len(ring) else [parts[["ts", *prices]]]).drop_duplicates("ts").sort_values("ts").tail(history)
        for name, value in zip(SERIES, key):
            ring.insert(0, name, value)
        return ring[[*SERIES, "ts", *prices]], ([int(t) for t in both["ts"]], *([float(v) for v in both[p]] for p in prices))

    columns = f"ts long, {', '.join(f'{p} double' for p in prices)}"
    both = rows_and_carry(picked, picked.mapInPandas(newest, picked.schema), list(SERIES), carry, columns,
                          f"ts array<long>, {', '.join(f'{p} array<double>' for p in prices)}")

    def run(batch, past, batch_id):
        keys = [*SERIES, "ts"]
        new = join_keys(batch.dropDuplicates(keys), past.select(*keys), keys, "left_anti")
        # Blocks that end at an older candle were forecast with its own batch.
        blocks = join_keys(rolling_blocks(past.unionByName(new), history=history), new.select(*keys), keys, "left_semi")
        write_batch(forecast_blocks(blocks, model, scaler, frames), path, batch_id)

    return to_batches(both, run, checkpoint, **trigger)
