"""Queries that write keyed tables and files, and read them back."""

from pyspark.sql import functions as F

from tickloom.plans import tables as T
from tickloom.plans.registry import query
from tickloom.plans.series import doubled
from tickloom.schemas import CANDLE, SERIES
from tickloom.session import fresh_dir
from tickloom.sources import store as W

KEYS = ["symbol", "frame", "ts"]
SQL_CHANGED = f"""WITH {T.SQL_ALL}
SELECT symbol, frame, ts, CASE WHEN ts % 7200 = 0 THEN "closeBid" + 1 ELSE "closeBid" END AS "closeBid",
       "openBid" FROM candles"""


def slim(spark, sf):
    return T.all_candles(spark, sf).select("symbol", "frame", "ts", "closeBid", "openBid")


def changed(table):
    """A batch that writes part of the table again, with other closes; the last one counts."""
    again = table.filter("ts % 7200 = 0")
    return (again.withColumn("closeBid", F.col("closeBid") + 9).withColumn("arrival", F.lit(0))
            .unionByName(again.withColumn("closeBid", F.col("closeBid") + 1).withColumn("arrival", F.lit(1))))


@query("upsert", SQL_CHANGED)
def upsert(spark, sf):
    table = slim(spark, sf)
    return W.upsert(table, changed(table), KEYS, ["arrival"]).drop("arrival")


@query("upsert_price", f"""WITH {T.SQL_TICKS} SELECT symbol, updated, bid + 1 AS bid FROM ticks
QUALIFY row_number() OVER (PARTITION BY symbol, updated ORDER BY event_id DESC) = 1""")
def upsert_price(spark, sf):
    prices = T.ticks(spark, sf).select("symbol", "updated", "bid", "event_id")
    batch = prices.withColumn("bid", F.col("bid") + 1)
    return W.upsert(prices, batch, ["symbol", "updated"], ["event_id"]).drop("event_id")


@query("set_fields", SQL_CHANGED)
def set_fields(spark, sf):
    table = slim(spark, sf)
    partial = changed(table).withColumn("openBid", F.lit(None).cast("double"))
    return W.set_fields(table, partial, KEYS, ["arrival"]).drop("arrival")


@query("insert_ignore", f"""WITH {T.SQL_ALL} SELECT symbol, frame, ts,
  CASE WHEN ts % 7200 = 0 THEN "closeBid" ELSE "closeBid" + 5 END AS "closeBid" FROM candles""")
def insert_ignore(spark, sf):
    bars = T.all_candles(spark, sf).select("symbol", "frame", "ts", "closeBid")
    table = bars.filter("ts % 7200 = 0")
    batch = doubled(bars.withColumn("closeBid", F.col("closeBid") + 5))
    return W.insert_ignore(table, batch, KEYS, ["arrival"]).drop("arrival")


@query("keyed_table", f"""WITH {T.SQL_H1}
SELECT symbol, frame, {T.SQL_OHLC.replace('"closeBid"', 'CASE WHEN ts % 7200 = 0 THEN "closeBid" + 1 ELSE "closeBid" END AS "closeBid"')},
       ts FROM candles""")
def keyed_table(spark, sf):
    """Bulk load, live upserts and a second load that finds every key taken."""
    table = W.KeyedTable(spark, fresh_dir(spark, "candles"), CANDLE, KEYS, SERIES)
    bars = T.hour_candles(spark, sf)
    table.insert_ignore(bars, 0)
    table.upsert(table.read().filter("ts % 7200 = 0").withColumn("closeBid", F.col("closeBid") + 1), 1)
    table.insert_ignore(table.read().withColumn("closeBid", F.lit(0.0)), 2)
    return table.read().select(*CANDLE.names)


@query("write_partitioned", f"""WITH {T.SQL_ALL}
SELECT symbol, frame, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, max("closeBid") AS top
FROM candles GROUP BY symbol, frame""")
def write_partitioned(spark, sf):
    path = fresh_dir(spark, "series")
    W.write_partitioned(T.all_candles(spark, sf), path)
    return (spark.read.schema(CANDLE).parquet(path).groupBy(*SERIES)
            .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                 F.max("closeBid").alias("top")))
