"""Work along time series whose length may be very uneven.

A row window over ``partitionBy(symbol, frame)`` puts a whole series on one task. The
helpers here cut a series into time slots and stay exact:

* ``with_lookback`` copies the few rows a slot needs from before it (moving frames);
* ``with_carry`` brings the running aggregate of all earlier slots (unbounded frames).
"""

import re
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import frame_seconds
from tickloom.schemas import SERIES
from tickloom.session import fresh_dir

SLOT_ROWS = 50_000
SALTS = 32
RANKED_EARLY = 1000      # rows up to which Spark's rank limit works before the shuffle


def join_keys(left, right, keys, how="inner"):
    """Join on keys that may be null: a null key meets a null key. The columns of the left side
    come first, then those of the right side that are no keys."""
    short = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(short, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def time_slot(ts="ts", frame="frame", rows=SLOT_ROWS):
    """Slot of a candle: at most `rows` candles of one series share a slot."""
    width = F.coalesce(frame_seconds(frame), F.lit(60)) * rows
    return F.floor(F.col(ts) / width)


def with_lookback(df, rows, keys=SERIES, order=("ts",), slot=None):
    """Rows of `df` by slot, plus for every slot the `rows` rows that precede it in its
    series. Copies carry ``_own = false``; window over (keys, _slot) and drop them after.

    Only the last `rows` rows of a slot can precede another slot closely enough, and the
    rank filter that keeps them runs before the shuffle. Among these kept rows, a row
    belongs to the lookback of every later slot met within its next `rows` rows.
    """
    keys, order = list(keys), list(order)
    spread = df.withColumn("_slot", time_slot() if slot is None else slot)
    latest = Window.partitionBy(*keys, "_slot").orderBy(*[F.col(c).desc() for c in order])
    ends = (spread.withColumn("_rank", F.row_number().over(latest))
            .filter(F.col("_rank") <= rows).drop("_rank"))
    ahead = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, rows)
    copies = (ends.withColumn("_next", F.collect_set("_slot").over(ahead))
              .withColumn("_to", F.explode(F.filter("_next", lambda s: s > F.col("_slot"))))
              .withColumn("_slot", F.col("_to")).drop("_next", "_to"))
    return (spread.withColumn("_own", F.lit(True))
            .unionByName(copies.withColumn("_own", F.lit(False))))


def over_series(df, rows, add, keys=SERIES, order=("ts",), slot=None):
    """Apply ``add(df, window)`` where every row sees at least its `rows` predecessors."""
    window = Window.partitionBy(*keys, "_slot").orderBy(*order)
    spread = with_lookback(df, rows, keys, order, slot)
    return add(spread, window).filter("_own").drop("_slot", "_own")


def with_carry(df, keys, slot, order, aggs):
    """Add for every row the aggregate of all slots before its own.

    `aggs` maps a new column to (aggregate per slot, how to merge slots), the merge being
    a function of a column name that works over a window. The slot table is small: one
    row per key and slot, aggregated before the shuffle.
    """
    keys = list(keys)
    spread = df.withColumn("_slot", slot)
    per_slot = spread.groupBy(*keys, "_slot").agg(*[agg.alias(name) for name, (agg, _) in aggs.items()])
    before = (Window.partitionBy(*keys).orderBy("_slot")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = per_slot.select(*keys, "_slot",
                              *[merge(name).over(before).alias(name) for name, (_, merge) in aggs.items()])
    within = (Window.partitionBy(*keys, "_slot").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    return join_keys(spread, carried, [*keys, "_slot"]), within


def latest(df, keys, order, bits=None):
    """Newest record per key, combined before the shuffle. `bits` states the width of whole-number columns of the order that never use all
    of theirs, such as times, so that two 64-bit columns pack into one number; a value beyond it is an error."""
    return _pick(df, list(keys), _names(order), F.max_by, bits)


def keep_first(df, keys, order):
    """First record per key, combined before the shuffle: a key with very many copies
    sends only one row per task. An order made of keys alone says nothing about which is first."""
    if set(_names(order)) <= set(keys):
        raise ValueError("the first record needs an order besides its key, such as an arrival column")
    return _pick(df, list(keys), _names(order), F.min_by)


FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _pick(df, keys, order, by, bits=None):
    """One row per key by `order`, nulls lowest. Values of fixed width with an order that packs into one
    number keep Spark's hash aggregate; a struct would make it sort all rows. All columns come
    from the same row also in a tie, since they are compared in the same sequence."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys]
    rank = _numeric_rank(order[0], types[order[0]]) if len(order) == 1 else packed_rank([(c, types[c]) for c in order], bits)
    if rank is not None and all(isinstance(types[c], FIXED_WIDTH) for c in rest):
        picked = df.withColumn("_rank", rank).groupBy(*keys).agg(
            *[by(c, "_rank").alias(c) for c in rest])
    else:
        picked = (df.groupBy(*keys).agg(by(F.struct(*rest), F.struct(*order)).alias("_row"))
                  .select(*keys, "_row.*"))
    return picked.select(*df.columns)


def _numeric_rank(col, kind):
    """Sort column as a number that is never null, or None when its type is another."""
    if isinstance(kind, T.IntegralType):
        return F.coalesce(F.col(col).cast("long"), F.lit(-2 ** 63))
    if isinstance(kind, T.DoubleType):
        return F.coalesce(col, F.lit(float("-inf")))
    return None


WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def packed_rank(columns, bits=None):
    """Whole-number columns, each with its type, as one decimal that compares like them in turn, nulls
    lowest. None when a column is of another type or they do not fit: two of 64 bits don't, unless `bits` states a lesser
    width of one, which its values are held to."""
    widths = [WHOLE_BITS.get(type(kind)) for _, kind in columns]
    if None in widths:
        return None
    widths = [min(width, (bits or {}).get(name, width)) for (name, _), width in zip(columns, widths)]
    if sum(w + 1 for w in widths) > 126:
        return None
    rank = F.lit(Decimal(0)).cast("decimal(38,0)")
    for (name, kind), width in zip(columns, widths):
        col = F.col(name)
        if width < WHOLE_BITS[type(kind)]:
            wide = F.raise_error(F.concat(F.lit(f"{name} does not fit in {width} bits: "), col.cast("string"))).cast(kind)
            col = F.when((col >= -2 ** (width - 1)) & (col < 2 ** (width - 1)), col).when(col.isNotNull(), wide)
        number = F.coalesce(col.cast("decimal(38,0)") + F.lit(Decimal(2 ** (width - 1) + 1)), F.lit(Decimal(0)))
        rank = (rank * F.lit(Decimal(2 ** width + 1)) + number).cast("decimal(38,0)")
    return rank


def on_statistic(df, stats, keys, how="inner", salt_by="ts", salts=SALTS):
    """`df` joined with a statistic of its series. The statistic is written first and its size measured: within the broadcast limit of the
    session it goes to the rows. Beyond it rows meet it by series and a salt out of a column, each series' statistic being sent to
    every salt, so that a hot series is many tasks."""
    spark, keys = df.sparkSession, list(keys)
    path = fresh_dir(spark, "statistic")
    stats.write.parquet(path)
    kept = spark.read.schema(stats.schema).parquet(path)
    size = kept.agg(F.sum(F.length(F.to_json(F.struct("*"))) + 16)).first()[0] or 0
    if size <= broadcast_limit(spark):
        return join_keys(df, F.broadcast(kept), keys, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    spread = kept.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return join_keys(salted, spread, [*keys, "_salt"], how).drop("_salt")


def broadcast_limit(spark):
    """Bytes up to which the session broadcasts a side; none below zero."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit] if int(number) > 0 else -1


def dedup(df, keys=("ts", "frame", "symbol"), order=None):
    """One record per key: any of them, or the first by `order`."""
    return keep_first(df, keys, order) if order else df.dropDuplicates(list(keys))


def monotonic(df, keys=SERIES, ts="ts", arrival="arrival", slot_size=100_000):
    """Keep a row when its time exceeds every earlier time of its key, in arrival order,
    and is above zero. `arrival` is a number that rises with arrival, unique per key."""
    slot = F.floor(F.col(arrival) / slot_size)
    carried, within = with_carry(
        df, keys, slot, [arrival], {"_past": (F.max(ts), F.max)})
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.greatest("_past", F.max(ts).over(earlier)), F.lit(0))
    return (carried.withColumn("_seen", seen).filter(F.col(ts) > F.col("_seen"))
            .select(*df.columns))


def history(df, seconds=3 * 86400, fields=("openBid", "highBid", "lowBid", "closeBid"), keys=SERIES):
    """Ordered candle arrays per series and span of `seconds`. The span bounds an array,
    however long the series: a span holds seconds / frame candles. The newest rows of a series
    whatever the spans are those of `last_rows`."""
    entry = F.struct("ts", *fields)
    start = F.floor((F.col("ts") - 1) / seconds) * seconds
    return (df.groupBy(*keys, start.alias("start"))
            .agg(F.array_sort(F.collect_list(entry)).alias("history")))


def last_rows(df, n, keys=SERIES, order="ts", skip=0):
    """The last n rows of every series, leaving out the newest `skip`.

    Spark ranks before the shuffle only up to a limit of some hundred rows. Beyond it, rows are counted by time
    slot first, and only the newest slots that hold enough rows are ranked, so that no task gets a whole series."""
    if skip + n > RANKED_EARLY and {"ts", "frame"} <= set(df.columns) and _names(order)[0] == "ts" and set(keys) <= set(df.columns):
        spread = df.withColumn("_slot", time_slot())
        newer = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("_slot")).rowsBetween(Window.unboundedPreceding, -1)
        needed = (spread.groupBy(*keys, "_slot").count().withColumn("_newer", F.coalesce(F.sum("count").over(newer), F.lit(0)))
                  .filter(F.col("_newer") < skip + n).select(*keys, "_slot"))
        df = join_keys(spread, needed, [*keys, "_slot"], "left_semi").drop("_slot")
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in _names(order)])
    ranked = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= skip + n)
    return ranked.filter(F.col("_rank") > skip).drop("_rank")


def continuous_open(df, close="closeBid", open_="openBid", keys=SERIES, slot=None):
    """Open every candle at the close before it; the first one keeps its own open."""
    return over_series(df, 1, lambda d, w: d.withColumn(
        open_, F.coalesce(F.lag(close).over(w), F.col(open_))), keys, slot=slot)


def merge_history(hist, live, keys=("symbol", "frame", "ts"), order=()):
    """History and live rows as one series. A live row replaces the history row of its
    key; the later of two live rows wins by `order`, the first of two history rows."""
    both = (hist.withColumn("_live", F.lit(0)).unionByName(
        live.withColumn("_live", F.lit(1)), allowMissingColumns=True))
    later = [F.when(F.col("_live") == 1, F.col(c)).desc_nulls_last() for c in order]
    first = [F.col(c).asc() for c in order]
    rank = Window.partitionBy(*keys).orderBy(F.col("_live").desc(), *later, *first)
    return both.withColumn("_rank", F.row_number().over(rank)).filter("_rank = 1").drop("_rank", "_live")


def _names(order):
    return [order] if isinstance(order, str) else list(order)
