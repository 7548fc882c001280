"""Queries over messages, ticks and candles: decoding, projections, filters, lookups."""

from decimal import Decimal

from pyspark.sql import functions as F

from tickloom.functions import scalar as S
from tickloom.operators import candles as C
from tickloom.operators import features as X
from tickloom.operators import filters as L
from tickloom.operators import joins as J
from tickloom.operators import projections as P
from tickloom.operators import requests as Q
from tickloom.operators.series import continuous_open, keep_first
from tickloom.plans import tables as T
from tickloom.plans.registry import query
from tickloom.plans.series import doubled
from tickloom.schemas import CANDLE, NEWS, OHLC, PREDICTION, TICK
from tickloom.sources import envelope as E
from tickloom.sources import market as M
from tickloom.sources.store import union_all

AS_OF = 1705276800      # 2024-01-15 00:00:00 UTC, in the middle of the event table


# ---- messages -------------------------------------------------------------------------

@query("decode_envelope", f"WITH {T.SQL_ALL} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles")
def decode_envelope(spark, sf):
    sent = E.encode_envelope(T.all_candles(spark, sf), key="symbol", topic="market.candle.0")
    return E.decode_envelope(sent, CANDLE)


@query("decode_ticks", f"""WITH {T.SQL_TICKS}
SELECT symbol, bid, ask, updated, updated // 1000 AS second, (bid + ask) / 2 AS "avg" FROM ticks""")
def decode_ticks(spark, sf):
    sent = E.encode_envelope(T.ticks(spark, sf).drop("event_id"), key="symbol", topic="market.price.0")
    return E.decode_ticks(sent).select("symbol", "bid", "ask", "updated",
                                       F.unix_seconds("timestamp").alias("second"), "avg")


@query("normalize_rates", f"WITH {T.SQL_TICKS} SELECT symbol, bid, ask, high, low, updated FROM ticks")
def normalize_rates(spark, sf):
    packed = T.ticks(spark, sf).select(F.col("symbol").alias("Symbol"),
                                       F.array("bid", "ask", "high", "low").alias("Rates"),
                                       F.col("updated").alias("Updated"))
    return M.normalize_rates(packed)


def packed_history(bars):
    """Candles as positional arrays with an offer id: the code of the name's first letter."""
    return bars.select(
        F.array(F.col("ts").cast("double"), *OHLC, F.col("openBid") + F.col("closeBid")).alias("c"),
        F.ascii("symbol").alias("offer_id"), "frame")


def instruments(spark, sf):
    """Offer ids of all instruments but one, so that a lookup can miss."""
    return (T.load(spark, sf, "events").select(F.col("event_type").alias("pair")).distinct()
            .filter("pair <> 'view'").select(F.ascii("pair").alias("offer_id"), "pair"))


@query("normalize_history", f"""WITH {T.SQL_ALL}
SELECT ts, {T.SQL_OHLC}, "openBid" + "closeBid" AS volume, frame,
       CASE WHEN symbol <> 'view' THEN symbol END AS symbol FROM candles""")
def normalize_history(spark, sf):
    return M.normalize_history(packed_history(T.all_candles(spark, sf)), instruments(spark, sf))


@query("decode_json", f"""WITH {T.SQL_TICKS}
SELECT event_id, CASE WHEN bid < 90 THEN symbol END AS symbol, CASE WHEN bid < 90 THEN bid END AS bid,
       CASE WHEN bid < 90 THEN updated END AS updated FROM ticks""")
def decode_json(spark, sf):
    whole = F.to_json(F.struct("symbol", "bid", "updated"))
    sent = T.ticks(spark, sf).select("event_id", F.when(F.col("bid") < 90, whole).otherwise(
        F.substring(whole, 1, 25)).alias("value"))
    data = E.decode_json("value", TICK)
    return sent.select("event_id", data["symbol"].alias("symbol"), data["bid"].alias("bid"),
                       data["updated"].alias("updated"))


#: One message of each subject: candles of all frames, the forming candle after every tick, their forecasts, prices and news.
SQL_MESSAGES = f"""WITH {T.SQL_ALL}, {T.SQL_PREDICTIONS}
SELECT 'price' AS subject, symbol, updated AS at, printf('%.5f', ask) AS value FROM ticks
UNION ALL SELECT 'candle', symbol, ts, printf('%.5f', "closeAsk") FROM candles
UNION ALL SELECT 'livecandle', symbol, CAST(cts AS BIGINT), printf('%.5f', ask) FROM placed
UNION ALL SELECT 'predictioncandle', symbol, ts, printf('%.5f', prediction) FROM predictions
UNION ALL SELECT 'news', 'EURUSD', CAST(page_id * 60 AS BIGINT), url FROM pages"""
SCHEMAS = {"price": TICK, "candle": CANDLE, "livecandle": CANDLE, "predictioncandle": PREDICTION, "news": NEWS}
SHOWN = {"price": ("updated", "ask"), "candle": ("ts", "closeAsk"), "livecandle": ("ts", "closeAsk"), "predictioncandle": ("ts", "prediction"), "news": ("time", "url")}


def messages(spark, sf):
    """Messages of all subjects in one table."""
    bars, ticks = T.all_candles(spark, sf), T.ticks(spark, sf)
    page = F.col("page_id").cast("string")
    news = T.load(spark, sf, "pages").select(F.concat(F.lit("Title "), page).alias("title"), "url", (F.col("page_id") * 60).alias("time"), F.lit("").alias("summary"),
                                             F.substring("html", 1, 50).alias("content"), F.lit("EURUSD").alias("symbol"), F.lit("Wire").alias("source"))
    rows = {"price": ticks, "candle": bars, "livecandle": C.live_candles(ticks).select(*CANDLE.names), "predictioncandle": T.as_predictions(bars), "news": news}
    return union_all([E.encode_envelope(df, topic=f"market.{name}.0") for name, df in rows.items()])


def shown(subject, rows):
    """Subject, symbol, time and one value of decoded messages."""
    at, value = SHOWN[subject]
    text = S.fixed_text(value) if subject == "predictioncandle" else F.col(value)
    return rows.select(F.lit(subject).alias("subject"), "symbol", F.col(at).alias("at"), text.alias("value"))


@query("route", SQL_MESSAGES)
def route(spark, sf):
    return union_all([shown(name, rows) for name, rows in E.route(messages(spark, sf), SCHEMAS).items()])


@query("encode_envelope", f"""WITH {T.SQL_ALL}
SELECT symbol AS key, '{{"symbol":"' || symbol || '","frame":"' || frame || '","closeBid":"'
       || printf('%.5f', "closeBid") || '","ts":' || ts || '}}' AS value, 'market.candle.0' AS topic
FROM candles""")
def encode_envelope(spark, sf):
    rows = S.price_text(T.all_candles(spark, sf).select("symbol", "frame", "closeBid", "ts"))
    return E.encode_envelope(rows, key="symbol", topic="market.candle.0")


# ---- candles --------------------------------------------------------------------------

@query("candles", f"WITH {T.SQL_ALL} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles")
def candles(spark, sf):
    return T.all_candles(spark, sf)


@query("candles_one_frame", f"WITH {T.SQL_H1} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles")
def candles_one_frame(spark, sf):
    return T.hour_candles(spark, sf)


HASH = 6364136223846793005, 9223372036854775783     # a factor and a modulus that spread ids over 63 bits


@query("candles_hashed_ids", f"""WITH {T.SQL_TICKS}, hashed AS (
  SELECT symbol, bid, updated, CAST(CAST(event_id AS HUGEINT) * {HASH[0]} % {HASH[1]} AS BIGINT) AS h FROM ticks)
SELECT symbol, CAST(updated // 86400000 * 86400 + 86400 AS BIGINT) AS ts, first(bid ORDER BY updated // 600000, h) AS "openBid",
       last(bid ORDER BY updated // 600000, h) AS "closeBid" FROM hashed GROUP BY 1, 2""")
def candles_hashed_ids(spark, sf):
    """Day candles of ticks whose times are cut to ten minutes, so that hashed ids break many ties."""
    number = F.col("event_id").cast("decimal(19,0)") * F.lit(Decimal(HASH[0])) % F.lit(Decimal(HASH[1]))
    cut = (F.col("updated") - F.pmod("updated", F.lit(600_000))).alias("updated")
    hashed = T.ticks(spark, sf).select("symbol", "bid", "ask", cut, number.cast("long").alias("h"))
    return C.candles(hashed, {"D1": 86400}, order=("updated", "h")).select("symbol", "ts", "openBid", "closeBid")


LIVE_SQL = f"""WITH {T.SQL_ALL}
SELECT symbol, frame, first_value(bid) OVER w AS "openBid", bid AS "closeBid", max(bid) OVER w AS "highBid",
       min(bid) OVER w AS "lowBid", first_value(ask) OVER w AS "openAsk", ask AS "closeAsk",
       max(ask) OVER w AS "highAsk", min(ask) OVER w AS "lowAsk", CAST(cts AS BIGINT) AS ts, updated, event_id
FROM placed WINDOW w AS (PARTITION BY symbol, frame, cts ORDER BY updated, event_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query("live_candles", LIVE_SQL)
def live_candles(spark, sf):
    return C.live_candles(T.ticks(spark, sf))


@query("drop_first_candle", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles
QUALIFY row_number() OVER (PARTITION BY symbol, frame ORDER BY ts) > 1""")
def drop_first_candle(spark, sf):
    return C.drop_first_candle(T.all_candles(spark, sf))


# ---- projections ----------------------------------------------------------------------

@query("sanitize_symbol", r"""SELECT event_id,
  upper(regexp_replace(substr(event_type, 1, 3) || '/' || event_type || ' #' || user_id, '\W', '', 'g')) AS symbol,
  regexp_replace(substr(event_type, 1, 3) || '/' || event_type || ' #' || user_id, '\W', '', 'g') AS room
FROM events""")
def sanitize_symbol(spark, sf):
    raw = F.concat(F.substring("event_type", 1, 3), F.lit("/"), "event_type", F.lit(" #"), "user_id")
    return T.load(spark, sf, "events").select("event_id", S.sanitize_symbol(raw).alias("symbol"),
                                              S.sanitize_symbol(raw, upper=False).alias("room"))


@query("price_text", f"""WITH {T.SQL_TICKS}
SELECT symbol, printf('%.5f', bid) AS bid, printf('%.5f', ask) AS ask, printf('%.5f', high) AS high,
       printf('%.5f', low) AS low, updated, event_id FROM ticks""")
def price_text(spark, sf):
    return S.price_text(T.ticks(spark, sf))


@query("price_text_tolerant", f"""WITH {T.SQL_TICKS}
SELECT CASE WHEN bid < 90 THEN event_id END AS event_id,
       CASE WHEN bid < 90 THEN printf('%.5f', bid) END AS bid FROM ticks""")
def price_text_tolerant(spark, sf):
    text = F.when(F.col("bid") < 90, F.col("bid").cast("string")).otherwise("n/a")
    return S.price_text(T.ticks(spark, sf).select("event_id", text.alias("bid")))


@query("mid_price", f"WITH {T.SQL_TICKS} SELECT event_id, (bid + ask) / 2 AS mid FROM ticks")
def mid_price(spark, sf):
    return T.ticks(spark, sf).select("event_id", S.mid("bid", "ask").alias("mid"))


@query("tick_times", f"""WITH {T.SQL_TICKS}
SELECT event_id, updated // 1000 AS second,
       (updated // 1000) - (updated // 1000) % 60 + 60 AS m1_end,
       (updated // 1000) - (updated // 1000) % 1800 + 1800 AS m30_end,
       (updated // 1000) - (updated // 1000) % 3600 + 3600 AS h1_end,
       printf('%02d:%02d', (updated // 3600000) % 24, (updated // 60000) % 60) AS label,
       epoch_us(ts) // 1000000 AS event_second
FROM ticks JOIN (SELECT event_id, ts FROM events) USING (event_id)""")
def tick_times(spark, sf):
    second = T.ticks(spark, sf).select("event_id", S.to_seconds("updated").alias("second"))
    return second.select("event_id", "second", S.candle_end("second", 60).alias("m1_end"),
                         S.candle_end("second", 1800).alias("m30_end"), S.candle_end("second", 3600).alias("h1_end"),
                         S.time_label("second").alias("label"),
                         F.unix_seconds(S.event_time("second")).alias("event_second"))


@query("chart_rows", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, ts AS time, "openBid" AS open, "highBid" AS high, "lowBid" AS low, "closeBid" AS close
FROM candles""")
def chart_rows(spark, sf):
    return P.chart_rows(T.all_candles(spark, sf))


@query("line_rows", f"""WITH {T.SQL_ALL} SELECT symbol, frame, ts AS time, "closeBid" AS value FROM candles""")
def line_rows(spark, sf):
    return P.line_rows(P.chart_rows(T.all_candles(spark, sf)))


@query("payload", f"WITH {T.SQL_H1} SELECT {T.SQL_OHLC}, ts FROM candles")
def payload(spark, sf):
    return P.payload(T.hour_candles(spark, sf))


# ---- filters --------------------------------------------------------------------------

@query("recent", f"""WITH {T.SQL_ALL} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles
WHERE symbol = 'view' AND frame = 'm30' AND ts > {AS_OF} - 10800""")
def recent(spark, sf):
    return L.recent(T.candles_between(spark, sf, AS_OF - 10800), "view", "m30", AS_OF)


@query("time_range", f"""WITH {T.SQL_ALL} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles
WHERE ts BETWEEN {AS_OF - 86400} AND {AS_OF} ORDER BY ts""")
def time_range(spark, sf):
    return L.time_range(T.candles_between(spark, sf, AS_OF - 86400, AS_OF), "ts", AS_OF - 86400, AS_OF).orderBy("ts")


@query("time_range_open_end", f"""WITH {T.SQL_TICKS} SELECT symbol, bid, ask, high, low, updated, event_id
FROM ticks WHERE updated BETWEEN {(AS_OF - 3600) * 1000} AND {AS_OF * 1000 + 600000} ORDER BY updated""")
def time_range_open_end(spark, sf):
    lo, hi = (AS_OF - 3600) * 1000, AS_OF * 1000
    return L.time_range(T.ticks(spark, sf, lo, hi + 600_000), "updated", lo, as_of=hi, margin=600_000).orderBy("updated")


@query("lookback", f"""WITH {T.SQL_ALL} SELECT symbol, frame, {T.SQL_OHLC}, ts FROM candles
WHERE frame = 'm1' AND ts >= {AS_OF} - 4800 * 60""")
def lookback(spark, sf):
    return L.lookback(T.candles_between(spark, sf, AS_OF - 4800 * 60), "m1", AS_OF)


@query("exclude_url", "SELECT page_id, url FROM pages WHERE NOT contains(url, '/en/')")
def exclude_url(spark, sf):
    return L.exclude_url(T.load(spark, sf, "pages").select("page_id", "url"), "/en/")


@query("mentions_any", "SELECT doc_id, lang FROM documents WHERE contains(text, 'the') OR contains(text, 'Der')")
def mentions_any(spark, sf):
    return L.mentions_any(T.load(spark, sf, "documents"), "text", ["the", "Der"]).select("doc_id", "lang")


@query("valid_predictions", f"""WITH {T.SQL_ALL}, {T.SQL_PREDICTIONS}
SELECT symbol, frame, prediction, ts FROM predictions
WHERE symbol <> 'error' AND frame <> 'm30' AND prediction <> 0.75 AND prediction < 99""")
def valid_predictions(spark, sf):
    sent = T.as_predictions(T.all_candles(spark, sf)).select(
        F.when(F.col("symbol") != "error", F.col("symbol")).alias("symbol"),
        F.when(F.col("frame") == "m30", "").otherwise(F.col("frame")).alias("frame"),
        F.when(F.col("prediction") == 0.75, 0.0).otherwise(F.col("prediction")).alias("prediction"),
        F.when(F.col("prediction") < 99, F.col("ts")).otherwise(0).alias("ts"))
    return L.valid_predictions(sent)


@query("min_history", f"""WITH {T.SQL_ALL}, daily AS (
  SELECT symbol || '@' || (ts // 86400) AS symbol, frame, "closeBid", ts FROM candles)
SELECT * FROM daily QUALIFY count(*) OVER (PARTITION BY symbol, frame) >= 61""")
def min_history(spark, sf):
    day = F.concat_ws("@", "symbol", F.floor(F.col("ts") / 86400))
    daily = T.all_candles(spark, sf).select(day.alias("symbol"), "frame", "closeBid", "ts")
    return L.min_history(daily)


# ---- lookups --------------------------------------------------------------------------

@query("with_symbol", f"""WITH {T.SQL_TICKS}
SELECT event_id, CAST(ascii(symbol) AS INTEGER) AS offer_id, CASE WHEN symbol <> 'view' THEN symbol END AS symbol
FROM ticks""")
def with_symbol(spark, sf):
    rows = T.ticks(spark, sf).select("event_id", F.ascii("symbol").alias("offer_id"))
    return J.with_symbol(rows, instruments(spark, sf))


@query("with_interval", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, ts, CAST(seconds AS BIGINT) AS seconds FROM candles JOIN frames USING (frame)""")
def with_interval(spark, sf):
    return J.with_interval(T.all_candles(spark, sf)).select("symbol", "frame", "ts", "seconds")


@query("overlay", f"""WITH {T.SQL_ALL}, {T.SQL_PREDICTIONS}
SELECT coalesce(c.symbol, p.symbol) AS symbol, coalesce(c.frame, p.frame) AS frame,
       coalesce(c.ts, p.ts) AS ts, c."closeBid" AS close, p.prediction AS forecast
FROM candles c FULL JOIN predictions p ON c.symbol = p.symbol AND c.frame = p.frame AND c.ts = p.ts""")
def overlay(spark, sf):
    bars = T.all_candles(spark, sf)
    return J.overlay(bars, keep_first(T.as_predictions(bars), ["symbol", "frame", "ts"], "prediction"), "prediction")


# ---- requests -------------------------------------------------------------------------

DAY = AS_OF - 86400


@query("candle_history", f"""-- the first of two candles of one time
WITH {T.SQL_ALL} SELECT {T.SQL_OHLC}, ts FROM candles
WHERE symbol = 'view' AND frame = 'm30' AND ts BETWEEN {DAY} AND {AS_OF + 60} ORDER BY ts""")
def candle_history(spark, sf):
    bars = doubled(T.candles_between(spark, sf, DAY, AS_OF + 60)).withColumn("symbol", S.sanitize_symbol("symbol"))
    return Q.candle_history(bars, "Vi/ew", "m30", DAY, as_of=AS_OF, arrival="arrival")


@query("forecast_history", f"""WITH {T.SQL_ALL}, {T.SQL_PREDICTIONS}
SELECT ts, regexp_replace(printf('%.5f', prediction), '\\.?0+$', '') AS "closeBid" FROM predictions
WHERE symbol = 'click' AND frame = 'H1' AND ts BETWEEN {DAY} AND {AS_OF} ORDER BY ts""")
def forecast_history(spark, sf):
    stored = X.stored_forecasts(T.as_predictions(T.candles_between(spark, sf, DAY - 3600, AS_OF)))
    return Q.forecast_history(stored.withColumn("symbol", S.sanitize_symbol("symbol")), "click", "H1", DAY, AS_OF)


@query("price_history", f"""WITH {T.SQL_TICKS} SELECT bid, ask, high, low, updated, event_id FROM ticks
WHERE symbol = 'signup' AND updated BETWEEN {DAY * 1000} AND {AS_OF * 1000 + 600000} ORDER BY updated""")
def price_history(spark, sf):
    prices = T.ticks(spark, sf, DAY * 1000, AS_OF * 1000 + 600_000).withColumn("symbol", S.sanitize_symbol("symbol"))
    return Q.price_history(prices, "signup", DAY * 1000, as_of=AS_OF * 1000)


@query("chart_history", f"""WITH {T.SQL_ALL}, bars AS (
  SELECT symbol, frame, ts AS time, coalesce(lag("closeBid") OVER (ORDER BY ts), "openBid") AS open,
         "highBid" AS high, "lowBid" AS low, "closeBid" AS close FROM candles
  WHERE symbol = 'view' AND frame = 'm30' AND ts >= {AS_OF} - 4800 * 1800 AND ts <= {AS_OF})
SELECT * FROM bars ORDER BY time""")
def chart_history(spark, sf):
    """What a chart loads: its lookback, one candle per time, opens at the close before."""
    bars = L.time_range(L.lookback(T.candles_between(spark, sf, AS_OF - 4800 * 1800, AS_OF), "m30", AS_OF), "ts", 0, AS_OF)
    one = keep_first(doubled(bars.filter("symbol = 'view'")), ["symbol", "frame", "ts"], "arrival")
    return P.chart_rows(continuous_open(one)).orderBy("time")


@query("stored_forecasts", f"""WITH {T.SQL_ALL}, {T.SQL_PREDICTIONS}
SELECT symbol, frame, ts, regexp_replace(printf('%.5f', prediction), '\\.?0+$', '') AS "closeBid" FROM predictions""")
def stored_forecasts(spark, sf):
    return X.stored_forecasts(L.valid_predictions(T.as_predictions(T.all_candles(spark, sf))))
