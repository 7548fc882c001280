"""Streams over several files give what the batch operators give."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from tickloom.operators import candles as C
from tickloom.operators import features as X
from tickloom.operators import panes as P
from tickloom.operators.series import latest, monotonic
from tickloom.plans.tables import as_ticks
from tickloom.schemas import CANDLE
from tickloom.session import fresh_dir
from tickloom.streaming import streams as S

SHOWN = ["symbol", "frame", "openBid", "closeBid", "highBid", "lowBid", "openAsk", "closeAsk", "highAsk", "lowAsk", "ts"]


@pytest.fixture(scope="module")
def ticks(spark):
    return as_ticks(spark.read.parquet("/root/testdata/sf0.001/events.parquet")).persist()


def in_files(spark, df, order, parts=5):
    """The rows as a stream, one file per batch, in the order of a column."""
    path = fresh_dir(spark, "source")
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    for i in range(parts):
        a, b = lo + (hi + 1 - lo) * i // parts, lo + (hi + 1 - lo) * (i + 1) // parts
        df.filter(F.col(order).between(a, b - 1)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(spark, stream, mode="append"):
    root = fresh_dir(spark, "run")
    S.to_files(stream, f"{root}/out", f"{root}/checkpoint", mode).awaitTermination()
    return f"{root}/out"


def test_closed_candles_equal_the_batch(spark, ticks):
    out = spark.read.parquet(run(spark, S.candle_stream(in_files(spark, ticks, "updated"), "H1")))
    end = ticks.agg(F.max("updated")).first()[0] - 3000
    closed = C.candles(ticks, {"H1": 3600}).filter(F.col("ts") * 1000 <= end)
    assert out.groupBy("symbol", "ts").count().filter("count > 1").count() == 0
    assert sorted(values(out, *SHOWN)) == sorted(values(closed, *SHOWN))


def test_live_candles_end_as_the_batch(spark, ticks):
    out = run(spark, S.candle_stream(in_files(spark, ticks, "updated"), "H1"), "update")
    final = S.final_state(spark, out, ["symbol", "frame", "ts"])
    assert sorted(values(final, *SHOWN)) == sorted(values(C.candles(ticks, {"H1": 3600}), *SHOWN))


def test_late_ticks_are_dropped_once_the_watermark_has_passed(spark, rows):
    schema = "symbol string, bid double, ask double, updated long, event_id long"
    path = fresh_dir(spark, "late")
    for bid, second in ((1.0, 10), (2.0, 1000), (3.0, 2000), (99.0, 20), (4.0, 3000)):
        rows(schema, ("A", bid, bid, second * 1000, second)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = spark.read.parquet(run(spark, S.candle_stream(stream, "m1")))
    assert values(out.filter("ts = 60"), "highBid") == [(1.0,)]


def test_deduplication_across_batches(spark, rows):
    schema = "symbol string, frame string, ts long, n long"
    df = rows(schema, *[("A", "m1", 60 * (i // 2 + 1), i) for i in range(40)])
    out = spark.read.parquet(run(spark, S.dedup_stream(in_files(spark, df, "n"), delay="1 hour")))
    assert sorted(values(out, "ts")) == [(60 * i,) for i in range(1, 21)]


def test_gate_across_batches(spark, ticks):
    df = ticks.select("symbol", (F.floor(F.col("updated") / 1000) - F.hash("event_id") % 50000).alias("ts"),
                      F.col("event_id").alias("arrival"))
    df = df.withColumn("symbol", F.when(F.col("symbol") != "view", F.col("symbol")))       # a null key is a key
    root = fresh_dir(spark, "run")
    S.monotonic_stream(in_files(spark, df, "arrival"), f"{root}/out", f"{root}/checkpoint", ["symbol"], slot_size=70).awaitTermination()
    got = values(spark.read.parquet(f"{root}/out"), "symbol", "ts", "arrival")
    assert sorted(got, key=str) == sorted(values(monotonic(df, ["symbol"]), "symbol", "ts", "arrival"), key=str)


def test_gate_sends_the_state_one_row_per_slot(spark, ticks):
    df = ticks.select("symbol", (F.floor(F.col("updated") / 1000)).alias("ts"), F.col("event_id").alias("arrival"))
    root = fresh_dir(spark, "run")
    run = S.monotonic_stream(in_files(spark, df, "arrival"), f"{root}/out", f"{root}/checkpoint", ["symbol"], slot_size=100)
    run.awaitTermination()
    seen = [p["stateOperators"][0] for p in run.recentProgress if p["stateOperators"]]
    assert max(p["numRowsTotal"] for p in seen) == df.select("symbol").distinct().count()


def test_live_candles_across_batches(spark, ticks):
    root = fresh_dir(spark, "live")
    S.live_stream(in_files(spark, ticks, "updated"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    columns = [*SHOWN, "updated", "event_id"]
    assert sorted(values(spark.read.parquet(f"{root}/out"), *columns)) == sorted(values(C.live_candles(ticks), *columns))


def test_ticks_of_closed_candles_change_no_live_candle(spark, rows):
    schema, path, root = "symbol string, bid double, ask double, updated long, event_id long", fresh_dir(spark, "late"), fresh_dir(spark, "live")
    for bid, second in ((1.0, 10), (2.0, 70), (9.0, 20), (3.0, 65)):       # the third is late for m1 only, the fourth is within the forming candle
        rows(schema, ("A", bid, bid, second * 1000, second)).coalesce(1).write.mode("append").parquet(path)
    S.live_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    got = {(r["frame"], r["event_id"]): (r["openBid"], r["highBid"], r["lowBid"], r["closeBid"], r["ts"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got["m1", 10] == (1, 1, 1, 1, 60) and got["m1", 70] == (2, 2, 2, 2, 120) and ("m1", 20) not in got
    assert got["m1", 65] == (2, 3, 2, 3, 120) and got["H1", 20] == (1, 9, 1, 9, 3600) and got["H1", 65] == (1, 9, 1, 3, 3600)


def test_latest_across_batches(spark, ticks):
    out = run(spark, S.latest_stream(in_files(spark, ticks, "updated"), order=["updated", "event_id"]), "update")
    want = latest(ticks, ["symbol"], ["updated", "event_id"])
    assert sorted(values(S.final_state(spark, out, ["symbol"]), *ticks.columns)) == sorted(values(want, *ticks.columns))


def windowed(bars, size, step):
    return (bars.groupBy(F.window(F.timestamp_seconds("ts"), f"{size} seconds", f"{step} seconds").alias("w"), "symbol")
            .agg(F.count("*").alias("n"), F.max_by("closeBid", "ts").alias("last")).select("symbol", F.unix_seconds("w.start").alias("start"), "n", "last"))


def test_sliding_windows_across_batches(spark, ticks):
    bars, root = C.candles(ticks, {"H1": 3600}), fresh_dir(spark, "sliding")
    S.sliding_to_files(S.sliding_stream(in_files(spark, bars, "ts"), 86400, 21600), root, f"{root}/checkpoint", 86400, 21600).awaitTermination()
    runs = spark.read.parquet(f"{root}/windows")
    got = latest(P.each_window(runs.withColumn("batch_", F.col("batch")), 86400, 21600), ["symbol", "frame", "start"], "batch_")
    assert sorted(values(got, "symbol", "start", "n", "last")) == sorted(values(windowed(bars, 86400, 21600), "symbol", "start", "n", "last"))


@pytest.mark.parametrize("step", [3600, 300])
def test_state_of_sliding_windows_has_a_row_per_pane(spark, ticks, step):
    bars, root = C.candles(ticks, {"H1": 3600}), fresh_dir(spark, "sliding")
    stream = S.sliding_stream(in_files(spark, bars, "ts", 1), 86400, step, delay="90 days")
    run = S.to_files(stream, f"{root}/out", f"{root}/checkpoint", "update")
    run.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]) == bars.count()


def test_forecasts_across_batches_equal_the_backfill(spark, ticks):
    bars = C.candles(ticks, {"H1": 3600})
    model = X.linear_model([0.0] * 90 + [0.3, 0.0, 0.0, 0.7] + [0.0] * 6)
    root = fresh_dir(spark, "forecast")
    S.forecast_stream(in_files(spark, bars.select(*CANDLE.names), "ts"), model, f"{root}/out",
                      f"{root}/checkpoint").awaitTermination()
    columns = ["symbol", "frame", "prediction", "ts"]
    assert sorted(values(spark.read.parquet(f"{root}/out"), *columns)) == sorted(
        values(X.forecast(bars, model, every=True), *columns))


def test_restart_continues_where_it_stopped(spark, ticks):
    path, root = fresh_dir(spark, "source"), fresh_dir(spark, "run")
    half = ticks.agg(F.expr("percentile(updated, 0.5)")).first()[0]
    for part in (F.col("updated") <= half, F.col("updated") > half):
        ticks.filter(part).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ticks.schema).parquet(path)
        S.to_files(S.candle_stream(stream, "H1"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    end = ticks.agg(F.max("updated")).first()[0] - 3000
    closed = C.candles(ticks, {"H1": 3600}).filter(F.col("ts") * 1000 <= end)
    assert sorted(values(spark.read.parquet(f"{root}/out"), *SHOWN)) == sorted(values(closed, *SHOWN))


def test_forecast_state_is_a_row_per_series(spark, ticks):
    bars, root = C.candles(ticks, {"m30": 1800, "H1": 3600}).select(*CANDLE.names), fresh_dir(spark, "forecast")
    run = S.forecast_stream(in_files(spark, bars, "ts"), X.linear_model([0.0] * 100, 1.0), f"{root}/out", f"{root}/checkpoint")
    run.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]) == 10


def test_chained_frames_scan_the_source_once(spark, ticks):
    run = S.to_files(S.candle_streams(in_files(spark, ticks, "updated")), (root := fresh_dir(spark, "run")) + "/out", f"{root}/checkpoint")
    run.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    end = ticks.agg(F.max("updated")).first()[0] - 3000
    assert sorted(values(out, *SHOWN)) == sorted(values(C.candles(ticks).filter(F.col("ts") * 1000 <= end), *SHOWN))
    batches = [p for p in run.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in batches) == ticks.count()                 # read once, not once per frame
    assert all(len(p["stateOperators"]) == 2 for p in batches)
    left = run.recentProgress[-1]["stateOperators"]
    assert max(p["numRowsTotal"] for p in left) < 40                                  # closed candles have left the state
