"""Operators that measure before they move rows: the same rows as the plain way, and the plans they promise."""

import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from tickloom.operators import candles as C
from tickloom.operators import features as X
from tickloom.operators import filters as L
from tickloom.operators import projections as P
from tickloom.operators import series as R
from tickloom.session import fresh_dir
from tickloom.sources import store as W


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return plan(df)


@pytest.mark.parametrize("limit_rows", [1, 30, 100_000])
def test_deep_pages_equal_the_sorted_table(rows, limit_rows):
    data = [(f"u{k:03d}", None if k % 17 == 0 else (k * 7919 % 100) ** 3 if k % 3 else 500) for k in range(300)]
    df = rows("url string, time long", *data).repartition(4)
    order = [u for u, t in sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))]
    for offset, limit in ((0, 5), (3, 20), (100, 40), (150, 1), (275, 25), (281, 10), (290, 20), (299, 5), (300, 5), (900, 3)):
        assert [r["url"] for r in P.deep_news_page(df, offset, limit, limit_rows).collect()] == order[offset:offset + limit]


def test_deep_pages_of_odd_tables(rows):
    assert P.deep_news_page(rows("url string, time long"), 0, 5).count() == 0
    assert values(P.deep_news_page(rows("url string, time long", ("b", None), ("a", None)), 1, 5), "url") == [("b",)]


def test_a_deep_page_sorts_one_range(spark):
    df = spark.range(20_000).select(F.format_string("u%d", "id").alias("url"), F.col("id").alias("time")).repartition(4)
    page = P.deep_news_page(df, 10_000, 20, rows=100)
    assert [r["time"] for r in page.collect()] == list(range(9_999, 9_979, -1))
    bounds = [int(n) for n in re.findall(r"[<>]= (\d+)", plan(page))]
    assert len(bounds) >= 2 and max(bounds) - min(bounds) < 100 and "TakeOrderedAndProject" in plan(page)


def test_insert_ignore_reads_what_may_clash(spark, rows):
    path = fresh_dir(spark, "bars")
    table = spark.range(30_000).select(F.format_string("S%d", F.col("id") % 3).alias("symbol"), F.lit("m1").alias("frame"), (F.col("id") * 60).alias("ts"), F.lit(1.0).alias("v"))
    W.write_partitioned(table, path)
    stored = spark.read.parquet(path)
    batch = rows("symbol string, frame string, ts long, v double", ("S1", "m1", 60, 9.0), ("S1", "m1", 61, 9.0), ("S1", "m1", 61, 8.0), ("S1", "m1", 240, 9.0))
    near = W.maybe_in(stored, batch, ["symbol", "frame", "ts"])
    text = plan(near)
    assert "PartitionFilters: [symbol" in text.replace("isnotnull(symbol#", "symbol#") or "PartitionFilters: [isnotnull(symbol" in text
    assert "symbol" in text.split("PartitionFilters")[1].split("]")[0] and "LessThanOrEqual(ts,240)" in text
    assert near.count() == 2                                           # 30,000 rows are stored
    added = W.new_rows(stored, batch, ["symbol", "frame", "ts"], ["v"])
    assert values(added, "ts", "v") == [(61, 8.0)]
    assert W.insert_ignore(stored, batch, ["symbol", "frame", "ts"], ["v"]).count() == 30_001


def test_insert_ignore_of_odd_batches(rows):
    schema = "k string, t long, v double"
    table = rows(schema, ("a", 1, 1.0), ("b", 2, 1.0))
    assert sorted(values(W.insert_ignore(table, rows(schema), ["k", "t"]), "k")) == [("a",), ("b",)]
    assert sorted(values(W.insert_ignore(rows(schema), table, ["k", "t"]), "k")) == [("a",), ("b",)]
    many = rows(schema, *[(f"k{i}", i, 0.0) for i in range(1500)], ("a", 1, 0.0))
    assert W.insert_ignore(table, many, ["k", "t"]).count() == 1502


def test_two_wide_orders_pack_when_one_is_stated(rows):
    df = rows("k string, t long, n long, v double", ("x", 5, 2 ** 63 - 1, 1.0), ("x", 5, -(2 ** 63), 2.0), ("x", None, 7, 3.0), ("y", -9, None, 4.0), ("y", -9, 0, 5.0))
    newest = R.latest(df, ["k"], ["t", "n"], {"t": 60})
    assert sorted(values(newest, "k", "v")) == [("x", 1.0), ("y", 5.0)]
    assert "SortAggregate" not in plan(newest) and "SortAggregate" in plan(R.latest(df, ["k"], ["t", "n"]))
    with pytest.raises(Exception, match="does not fit in 60 bits"):
        R.latest(df.withColumn("t", F.lit(2 ** 60)), ["k"], ["t", "n"], {"t": 60}).collect()


@pytest.mark.parametrize("limit", ["-1", "0", "10MB"])
def test_statistics_meet_their_series_either_way(spark, limit):
    bars = spark.range(4000).select(F.when(F.col("id") % 4 > 0, F.format_string("S%d", F.col("id") % 7)).alias("symbol"), F.lit("m1").alias("frame"),
                                    (F.col("id") * 60).alias("ts"), (F.col("id") % 5).cast("double").alias("closeBid"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        long_enough, later = L.min_history(bars, 500), C.drop_first_candle(bars)
        assert long_enough.count() == 1000 and later.count() == 4000 - 8
        for df in (long_enough, later):
            text = executed(df)
            assert ("BroadcastHashJoin" in text) == (limit == "10MB") and ("_salt" in text) == (limit != "10MB")
        blocks = bars.select("symbol", "frame", "ts", F.array(F.array(*[F.col("closeBid") + k for k in range(10)])).alias("block"))
        scaled = X.scale(blocks, X.fit_scaler(blocks, "minmax"))
        assert scaled.filter("block[0][3] < 0 or block[0][3] > 1").count() == 0 and scaled.count() == 4000
        assert ("_salt" in executed(scaled)) == (limit != "10MB")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_line_through_one_cell(rows):
    blocks = [(float(k), [[0.0] * 10] * 9 + [[0.0] * 6 + [float(k % 13)] + [0.0] * 3]) for k in range(60)]
    df = rows("k double, block array<array<double>>", *blocks).withColumn("label", 3 + 2 * F.element_at("block", -1)[6])
    model = X.fit_line(df, "label")
    got = X.score(df, model).select("out", "label").collect()
    assert all(abs(r["out"] - r["label"]) < 1e-9 for r in got)
