"""The physical plans keep the properties the design relies on."""

import re

import pytest
from conftest import values
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tickloom.operators import candles as C
from tickloom.operators import features as X
from tickloom.operators import indicators as I
from tickloom.operators import requests as Q
from tickloom.operators import series as R
from tickloom.plans import stored, streamed
from tickloom.plans import tables as T
from tickloom.session import fresh_dir
from tickloom.sources.store import write_partitioned

SF = "/root/testdata/sf0.001"
WRITES = {q.__name__ for m in (stored, streamed) for q in vars(m).values() if callable(q)} | {"write_tsv"}
#: Queries of the optional part run jobs of their own and may use Python.
LAZY = sorted(n for n, q in entry_points.queries().items()
              if q.__name__ not in WRITES and n != "forecast_fitted" and not re.match(r"op\d+_|pipeline$", n))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ticks_go_through_hash_aggregates_only(spark):
    text = plan(T.all_candles(spark, SF))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_tick_scan_reads_the_needed_columns(spark):
    text = plan(T.hour_candles(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_rank_limit_runs_before_the_shuffle(spark):
    text = plan(R.last_rows(T.hour_candles(spark, SF), 61))
    assert text.count("WindowGroupLimit") == 2


def test_ticks_are_scanned_once_for_rows_and_lookback(spark):
    df = I.indicators(T.hour_candles(spark, SF))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_numeric_latest_uses_the_hash_aggregate(spark):
    assert "SortAggregate" not in plan(R.latest(T.hour_candles(spark, SF), ["symbol", "frame"], "ts"))


def test_instrument_filter_passes_the_aggregates(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    assert "EqualTo(event_type,view)" in plan(T.all_candles(spark, SF).filter("symbol = 'view' AND frame = 'm30'"))


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_join_and_no_python_outside_scoring(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if not name.startswith(("forecast", "score")) or name == "forecast_history":
        assert "EvalPython" not in text


def test_requests_read_one_folder(spark, rows):
    path = fresh_dir(spark, "bars")
    df = rows("symbol string, frame string, ts long, closeBid double",
              ("EURUSD", "m1", 120, 2.0), ("EURUSD", "m1", 60, 1.0), ("EURUSD", "m1", 60, 5.0), ("USDJPY", "m1", 60, 9.0))
    df.withColumn("arrival", F.col("closeBid")).write.partitionBy("symbol", "frame").parquet(path)
    got = Q.candle_history(spark.read.parquet(path), "eur/usd", "m1", 0, as_of=100, arrival="arrival")
    assert [tuple(r) for r in got.select("ts", "closeBid").collect()] == [(60, 1.0), (120, 2.0)]
    assert "symbol" not in got.columns
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    assert "(symbol" in plan(got).split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("name", ["recent", "time_range", "time_range_open_end", "lookback", "candle_history", "price_history"])
def test_time_bounds_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    pushed = plan(entry_points.queries()[name](spark, SF)).split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts," in pushed
    assert name in ("recent", "lookback") or "LessThan(ts," in pushed


def test_stored_series_are_pruned_and_sorted(spark):
    path = fresh_dir(spark, "bars")
    write_partitioned(T.all_candles(spark, SF), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(Q.candle_history(spark.read.parquet(path), "view", "m1", T.load(spark, SF, "events").count(), 1705276800))
    assert "(symbol" in text.split("PartitionFilters: [")[1].split("]")[0]
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts," in pushed and "LessThanOrEqual(ts," in pushed
    for row in spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.collect_list("ts").alias("t")).collect():
        assert row["t"] == sorted(row["t"])


@pytest.mark.parametrize("name", ["upsert", "set_fields"])
def test_upserts_use_the_hash_aggregate(spark, name):
    assert "SortAggregate" not in plan(entry_points.queries()[name](spark, SF))


def test_forecast_text(rows):
    df = rows("symbol string, frame string, prediction double, ts long",
              *[("A", "m1", p, i) for i, p in enumerate((12.0, 1.5, 100.0, 0.00001, 1.23456))])
    assert values(X.stored_forecasts(df).orderBy("ts"), "closeBid") == [
        ("12",), ("1.5",), ("100",), ("0.00001",), ("1.23456",)]


def test_series_longer_than_a_slot_is_many_groups(spark):
    bars = spark.range(5000).select(F.lit("HOT").alias("symbol"), F.lit("m1").alias("frame"),
                                    (F.col("id") * 60 + 60).alias("ts"), (F.col("id") % 7).cast("double").alias("closeBid"))
    spread = R.with_lookback(bars, 20, slot=R.time_slot(rows=100))
    largest = spread.groupBy("symbol", "frame", "_slot").count().agg(F.max("count")).first()[0]
    assert largest == 120


def test_live_candles_sort_ticks_by_slot(spark):
    text = plan(C.live_candles(T.ticks(spark, SF)))
    assert "SortAggregate" not in text and "hashpartitioning(symbol" in text and "_slot" in text
