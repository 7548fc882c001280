"""Sliding windows out of panes.

A pane is the longest span that divides the size and the step of the windows. Rows are aggregated once, to panes; a
window is never given copies of them. Time is cut into blocks as long as a window: a window then is the end of one block and the
beginning of the next, so two running aggregates over the panes of a block, one from either side, answer all windows. Neighbouring
windows that hold the same panes are one row: there are at most two such runs per pane, whatever the size over the step.
"""

from math import gcd

from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.series import join_keys, over_series
from tickloom.schemas import SERIES

#: Columns of a pane, and how those of several panes become one.
MERGED = {"n": lambda: F.sum("n"), "first_ts": lambda: F.min("first_ts"), "last_ts": lambda: F.max("last_ts"),
          "first": lambda: F.min_by("first", "first_ts"), "last": lambda: F.max_by("last", "last_ts"),
          "low": lambda: F.min("low"), "high": lambda: F.max("high")}
RUNS_IN_SLOT = 50_000


def pane_aggregates(value="closeBid", ts="ts"):
    """Count, times, first, last, least and greatest value of the rows of a pane."""
    return [F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.min_by(value, ts).alias("first"),
            F.max_by(value, ts).alias("last"), F.min(value).alias("low"), F.max(value).alias("high")]


def panes(df, size, step, value="closeBid", keys=SERIES, ts="ts"):
    """One row per series and pane that holds a row. Rows without a time are left out."""
    width = gcd(size, step)
    pane = (F.floor(F.col(ts) / width) * width).alias("pane")
    return df.filter(F.col(ts).isNotNull()).groupBy(*keys, pane).agg(*pane_aggregates(value, ts))


def first_start(time, size, step):
    """Start of the first window that ends after a time."""
    return (F.floor((F.col(time) - size) / step) + 1) * step


def changes(panes, size, step, keys=SERIES):
    """The window starts of every series at which a pane comes in or goes out: between two of them all windows hold the same."""
    entered, left = first_start("pane", size, step), (F.floor(F.col("pane") / step) + 1) * step
    return panes.select(*keys, F.explode(F.array(entered, left)).alias("start")).distinct()


def window_runs(panes, size, step, keys=SERIES, merged=MERGED):
    """One row per run of windows with the same panes: the windows of `size` seconds that begin at `start` and every `step` seconds from
    there, before `until`, with the `merged` columns of their panes. Windows without a row are left out."""
    keys = list(keys)
    points = changes(panes, size, step, keys)
    block = F.floor(F.col("_at") / size)
    asked = points.select(*keys, "start", F.explode(F.array(
        F.struct(F.col("start").alias("_at"), F.lit(True).alias("_later")),             # what the block holds from there on
        F.struct((F.col("start") + size).alias("_at"), F.lit(False).alias("_later")))).alias("_q")).select(*keys, "start", "_q.*")
    held = panes.withColumn("_at", F.col("pane")).drop("pane")
    both = held.withColumn("_pane", F.lit(1)).unionByName(asked.withColumn("_pane", F.lit(0)), allowMissingColumns=True).withColumn("_block", block)
    # A pane that begins where a window does is in it; one that begins where a window ends is not.
    running = (Window.unboundedPreceding, Window.currentRow)
    rising = Window.partitionBy(*keys, "_block").orderBy("_at", "_pane").rowsBetween(*running)
    falling = Window.partitionBy(*keys, "_block").orderBy(F.desc("_at"), F.desc("_pane")).rowsBetween(*running)
    answered = both.select(*keys, "start", "_pane", "_later",
                           *[merge().over(rising).alias(f"_b_{c}") for c, merge in merged.items()], *[merge().over(falling).alias(f"_e_{c}") for c, merge in merged.items()])
    halves = answered.filter("_pane = 0").select(*keys, "start", *[F.when(F.col("_later"), F.col(f"_e_{c}")).otherwise(F.col(f"_b_{c}")).alias(c) for c in merged])
    whole = halves.groupBy(*keys, "start").agg(*[merge().alias(c) for c, merge in merged.items()]).withColumn("_back", -F.col("start"))
    slot = F.floor(F.col("start") / (step * RUNS_IN_SLOT))
    ended = over_series(whole, 1, lambda d, w: d.withColumn("until", F.lag("start").over(w)), keys, ("_back",), slot=-slot)
    return ended.filter("n > 0").select(*keys, "start", "until", *merged)


def each_window(runs, size, step):
    """The windows of all runs, a row each, with `start` and `end`."""
    starts = F.sequence("start", F.col("until") - step, F.lit(step).cast("long"))
    rest = [c for c in runs.columns if c not in ("start", "until")]
    return (runs.withColumn("start", F.explode(starts)).withColumn("end", F.col("start") + size).select(*[c for c in rest if c not in MERGED], "start", "end", *[c for c in rest if c in MERGED]))


def sliding_windows(df, size, step, value="closeBid", keys=SERIES):
    """Every window of `size` seconds, begun at each multiple of `step`, that holds a row: count, times and values."""
    return each_window(window_runs(panes(df, size, step, value, keys), size, step, keys), size, step)


def sliding_history(df, size, step, fields=("openBid", "highBid", "lowBid", "closeBid"), keys=SERIES):
    """Ordered candle arrays per series and sliding window. Rows are gathered once, by block; a run of windows with the same content
    takes its rows from two blocks, so an array is made once per run and only the windows asked for repeat it."""
    keys = list(keys)
    timed = df.filter(F.col("ts").isNotNull())
    blocks = (timed.groupBy(*keys, F.floor(F.col("ts") / size).alias("_block"))
              .agg(F.array_sort(F.collect_list(F.struct("ts", *fields))).alias("_rows")))
    runs = window_runs(panes(timed.select(*keys, "ts", F.lit(0.0).alias("closeBid")), size, step, keys=keys), size, step, keys).select(*keys, "start", "until")
    begun = join_keys(runs.withColumn("_block", F.floor(F.col("start") / size)), blocks.withColumnRenamed("_rows", "_first"), [*keys, "_block"], "left")
    both = join_keys(begun.withColumn("_block", F.col("_block") + 1), blocks.withColumnRenamed("_rows", "_second"), [*keys, "_block"], "left")
    rows = F.concat(F.coalesce("_first", F.filter("_second", lambda r: F.lit(False))), F.coalesce("_second", F.filter("_first", lambda r: F.lit(False))))
    within = F.filter(rows, lambda r: (r["ts"] >= F.col("start")) & (r["ts"] < F.col("start") + size))
    return each_window(both.select(*keys, "start", "until", within.alias("history")), size, step).select(*keys, "start", "end", "history")
