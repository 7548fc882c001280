"""Queries along series: indicators, latest rows, histories, deduplication."""

from pyspark.sql import functions as F

from tickloom.functions.scalar import epoch_millis, tail
from tickloom.operators import features as X
from tickloom.operators import indicators as I
from tickloom.operators import panes as P
from tickloom.operators import series as R
from tickloom.plans import tables as T
from tickloom.plans.registry import query

SQL_INDICATORS = """deltas AS (
  SELECT *, "closeBid" - lag("closeBid") OVER w AS delta, row_number() OVER w AS rn
  FROM candles WINDOW w AS (PARTITION BY symbol, frame ORDER BY ts)),
ranged AS (
  SELECT *, count("closeBid") OVER w21 AS n21, avg("closeBid") OVER w21 AS mean21,
         stddev_samp("closeBid") OVER w21 AS std21, count(delta) OVER w14 AS n14,
         avg(greatest(delta, 0)) OVER w14 AS gain, avg(greatest(-delta, 0)) OVER w14 AS loss
  FROM deltas
  WINDOW w21 AS (PARTITION BY symbol, frame ORDER BY ts ROWS BETWEEN 20 PRECEDING AND CURRENT ROW),
         w14 AS (PARTITION BY symbol, frame ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
indicators AS (
  SELECT *, CASE WHEN n21 = 21 THEN mean21 END AS bbmid,
         CASE WHEN n21 = 21 THEN mean21 + 1.96 * std21 END AS bbupper,
         CASE WHEN n21 = 21 THEN mean21 - 1.96 * std21 END AS bblower,
         "closeBid" - "openBid" AS body, CAST("closeBid" > "openBid" AS INTEGER) AS cosign,
         least("closeBid", "openBid") - "lowBid" AS down, "highBid" - greatest("closeBid", "openBid") AS up,
         CASE WHEN n14 = 14 THEN CASE WHEN loss = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + gain / loss) END END AS rsi
  FROM ranged)"""
SQL_IND = f"{T.SQL_ALL}, {SQL_INDICATORS}"


def bars(spark, sf):
    return T.all_candles(spark, sf).select("symbol", "frame", "openBid", "highBid", "lowBid", "closeBid", "ts")


@query("sma", f"WITH {SQL_IND} SELECT symbol, frame, ts, {T.six('bbmid', 'sma')} FROM indicators")
def sma(spark, sf):
    return T.shown(I.sma(bars(spark, sf)).select("symbol", "frame", "ts", "sma"), ["sma"])


@query("bollinger", f"""WITH {SQL_IND} SELECT symbol, frame, ts, {T.six('bbmid', 'bbmid')},
  {T.six('bbupper', 'bbupper')}, {T.six('bblower', 'bblower')}, {T.six('bbupper - bblower', 'bbwidth')}
FROM indicators""")
def bollinger(spark, sf):
    names = ["bbmid", "bbupper", "bblower", "bbwidth"]
    return T.shown(I.bollinger(bars(spark, sf)).select("symbol", "frame", "ts", *names), names)


@query("candle_shape", f"WITH {SQL_IND} SELECT symbol, frame, ts, body, cosign, down, up FROM indicators")
def candle_shape(spark, sf):
    return I.candle_shape(bars(spark, sf)).select("symbol", "frame", "ts", "body", "cosign", "down", "up")


@query("delta", f"WITH {SQL_IND} SELECT symbol, frame, ts, delta FROM indicators")
def delta(spark, sf):
    return I.delta(bars(spark, sf)).select("symbol", "frame", "ts", "delta")


@query("rsi", f"WITH {SQL_IND} SELECT symbol, frame, ts, {T.six('rsi', 'rsi')} FROM indicators")
def rsi(spark, sf):
    return T.shown(I.rsi(bars(spark, sf)).select("symbol", "frame", "ts", "rsi"), ["rsi"])


@query("drop_warmup", f"WITH {SQL_IND} SELECT symbol, frame, ts FROM indicators WHERE rn > 22")
def drop_warmup(spark, sf):
    return I.drop_warmup(bars(spark, sf)).select("symbol", "frame", "ts")


@query("indicators", f"""WITH {T.SQL_ALL}, {SQL_INDICATORS}
SELECT symbol, frame, ts, {T.six('bbupper', 'bbupper')}, {T.six('bblower', 'bblower')},
       {T.six('body', 'body')}, {T.six('up', 'up')}, {T.six('down', 'down')}, {T.six('rsi', 'rsi')} FROM indicators""")
def indicators(spark, sf):
    names = ["bbupper", "bblower", "body", "up", "down", "rsi"]
    return T.shown(I.indicators(T.all_candles(spark, sf)).select("symbol", "frame", "ts", *names), names)


@query("continuous_open", f"""WITH {T.SQL_ALL} SELECT symbol, frame, ts,
  coalesce(lag("closeBid") OVER (PARTITION BY symbol, frame ORDER BY ts), "openBid") AS "openBid", "closeBid"
FROM candles""")
def continuous_open(spark, sf):
    return R.continuous_open(T.all_candles(spark, sf).select("symbol", "frame", "ts", "openBid", "closeBid"))


SQL_UNEVEN = f"""{T.SQL_TICKS}, uneven AS (
  SELECT symbol, updated // 1000 - user_id * 600 AS ts, bid, ticks.event_id AS arrival
  FROM ticks JOIN (SELECT event_id, user_id FROM events) USING (event_id))"""


def uneven(events):
    """Records whose times jump back and forth in arrival order."""
    second = F.floor(epoch_millis("ts") / 1000)
    return events.select(F.col("event_type").alias("symbol"), (second - F.col("user_id") * 600).alias("ts"),
                         F.col("value").alias("bid"), F.col("event_id").alias("arrival"))


@query("monotonic", f"""WITH {SQL_UNEVEN}
SELECT symbol, ts, bid, arrival FROM uneven
QUALIFY ts > coalesce(max(ts) OVER (PARTITION BY symbol ORDER BY arrival
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)""")
def monotonic(spark, sf):
    return R.monotonic(uneven(T.load(spark, sf, "events")), keys=["symbol"])


@query("latest", f"""WITH {T.SQL_TICKS} SELECT symbol, bid, ask, high, low, updated, event_id FROM ticks
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated DESC, event_id DESC) = 1""")
def latest(spark, sf):
    return R.latest(T.ticks(spark, sf), ["symbol"], ["updated", "event_id"], T.TIME_BITS)


@query("last_candle", f"""WITH {T.SQL_ALL} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles
QUALIFY row_number() OVER (PARTITION BY symbol, frame ORDER BY ts DESC) = 1""")
def last_candle(spark, sf):
    return R.latest(T.all_candles(spark, sf), ["symbol", "frame"], "ts")


@query("history", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, (ts - 1) // 259200 * 259200 AS start,
       row_number() OVER (PARTITION BY symbol, frame, (ts - 1) // 259200 ORDER BY ts) - 1 AS pos, ts,
       "openBid", "highBid", "lowBid", "closeBid" FROM candles""")
def history(spark, sf):
    packed = R.history(T.all_candles(spark, sf))
    return (packed.select("symbol", "frame", "start", F.posexplode("history").alias("pos", "c"))
            .select("symbol", "frame", "start", F.col("pos").cast("long").alias("pos"), "c.*"))


@query("tail", f"""WITH {T.SQL_ALL}, spans AS (
  SELECT *, (ts - 1) // 259200 * 259200 AS start FROM candles)
SELECT symbol, frame, start, ts, "closeBid" FROM spans
QUALIFY row_number() OVER (PARTITION BY symbol, frame, start ORDER BY ts DESC) <= 61""")
def tail_rows(spark, sf):
    packed = R.history(T.all_candles(spark, sf), fields=("closeBid",))
    return (packed.select("symbol", "frame", "start", F.explode(tail("history", 61)).alias("c"))
            .select("symbol", "frame", "start", "c.*"))


@query("last_rows", f"""WITH {T.SQL_ALL} SELECT symbol, frame, ts, "closeBid" FROM candles
QUALIFY row_number() OVER (PARTITION BY symbol, frame ORDER BY ts DESC) <= 61""")
def last_rows(spark, sf):
    return R.last_rows(T.all_candles(spark, sf).select("symbol", "frame", "ts", "closeBid"), 61)


@query("sliding_history", f"""WITH {T.SQL_ALL},
steps AS (SELECT unnest(range(0, 12)) AS k),
placed_windows AS (
  SELECT symbol, frame, ts, "closeBid", ts // 21600 * 21600 - k * 21600 AS start FROM candles CROSS JOIN steps)
SELECT symbol, frame, CAST(start AS BIGINT) AS start, CAST(start + 259200 AS BIGINT) AS "end", count(*) AS n,
       min(ts) AS first_ts, max(ts) AS last_ts, last("closeBid" ORDER BY ts) AS "closeBid"
FROM placed_windows GROUP BY symbol, frame, start""")
def sliding_history(spark, sf):
    packed = P.sliding_history(T.all_candles(spark, sf), size=3 * 86400, step=6 * 3600, fields=("closeBid",))
    last = F.element_at("history", -1)
    return packed.select("symbol", "frame", "start", "end", F.size("history").cast("long").alias("n"),
                         F.element_at("history", 1)["ts"].alias("first_ts"), last["ts"].alias("last_ts"),
                         last["closeBid"].alias("closeBid"))


SQL_MINUTE_WINDOWS = f"""{T.SQL_H1},
copied AS (
  SELECT symbol, frame, ts, unnest(range((ts - 259200) // 60 * 60 + 60, ts + 1, 60)) AS start FROM candles),
windows AS (
  SELECT symbol, frame, start, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM copied GROUP BY ALL)
SELECT symbol, frame, CAST(start // 86400 AS BIGINT) AS day, count(*) AS windows, CAST(sum(n) AS BIGINT) AS n"""


@query("sliding_history_minute", f"""WITH {SQL_MINUTE_WINDOWS},
       CAST(sum(first_ts) AS BIGINT) AS first_ts, CAST(sum(last_ts) AS BIGINT) AS last_ts FROM windows GROUP BY 1, 2, 3""")
def sliding_history_minute(spark, sf):
    """Three days, moved every minute; the windows of a day are summed up."""
    windows = P.sliding_windows(T.hour_candles(spark, sf), size=3 * 86400, step=60)
    return windows.groupBy("symbol", "frame", F.expr("start div 86400").alias("day")).agg(
        F.count(F.lit(1)).alias("windows"), F.sum("n").alias("n"), F.sum("first_ts").alias("first_ts"), F.sum("last_ts").alias("last_ts"))


def doubled(df):
    """Every candle twice; the copy arrives later and has another close."""
    return (df.withColumn("arrival", F.lit(0))
            .unionByName(df.withColumns({"closeBid": F.col("closeBid") + 1, "arrival": F.lit(1)})))


@query("dedup", f"""WITH {T.SQL_ALL} SELECT symbol, frame, ts, "closeBid", 0 AS arrival FROM candles""")
def dedup(spark, sf):
    rows = doubled(T.all_candles(spark, sf).select("symbol", "frame", "ts", "closeBid"))
    return R.dedup(rows, ["ts", "frame", "symbol"], "arrival")


@query("keep_first", f"""WITH {T.SQL_TICKS} SELECT symbol, updated // 60000 AS minute, bid, event_id FROM ticks
QUALIFY row_number() OVER (PARTITION BY symbol, updated // 60000 ORDER BY event_id) = 1""")
def keep_first(spark, sf):
    rows = T.ticks(spark, sf).select("symbol", F.floor(F.col("updated") / 60000).alias("minute"), "bid", "event_id")
    return R.keep_first(rows, ["symbol", "minute"], "event_id")


@query("dedup_whole_record", f"WITH {T.SQL_TICKS} SELECT DISTINCT symbol, updated // 3600000 AS hour FROM ticks")
def dedup_whole_record(spark, sf):
    rows = T.ticks(spark, sf).select("symbol", F.floor(F.col("updated") / 3600000).alias("hour"))
    return R.dedup(rows, rows.columns)


@query("merge_history", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, ts, CASE WHEN ts % 7200 = 0 THEN "closeBid" + 1 ELSE "closeBid" END AS "closeBid",
       CASE WHEN ts % 7200 <> 0 THEN CAST(7 AS DOUBLE) END AS volume FROM candles""")
def merge_history(spark, sf):
    hist = T.all_candles(spark, sf).select("symbol", "frame", "ts", "closeBid")
    live = hist.filter("ts % 7200 = 0").withColumn("closeBid", F.col("closeBid") + 1)
    return R.merge_history(hist.withColumn("volume", F.lit(7.0)), live)


@query("sorted_candles", f"WITH {T.SQL_ALL} SELECT symbol, frame, ts FROM candles ORDER BY ts, symbol, frame")
def sorted_candles(spark, sf):
    return T.all_candles(spark, sf).select("symbol", "frame", "ts").orderBy("ts", "symbol", "frame")


@query("rmse", f"""WITH {T.SQL_ALL}, {T.SQL_PREDICTIONS}
SELECT {T.six('sqrt(avg(pow(p.prediction - c."closeBid", 2)))', 'rmse')}
FROM candles c JOIN predictions p ON c.symbol = p.symbol AND c.frame = p.frame AND c.ts = p.ts""")
def rmse(spark, sf):
    truth = T.all_candles(spark, sf)
    both = T.as_predictions(truth).join(truth.select("symbol", "frame", "ts", F.col("closeBid").alias("truth")),
                                        ["symbol", "frame", "ts"])
    return T.shown(X.rmse(both), ["rmse"])
