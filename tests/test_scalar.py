from conftest import values
from pyspark.sql import functions as F

from tickloom.functions import scalar as S


def test_symbol(rows):
    df = rows("s string", ("eur/usd",), ("EUR USD",), ("a_b-1",))
    assert values(df.select(S.sanitize_symbol("s").alias("a"), S.sanitize_symbol("s", upper=False).alias("b")),
                  "a", "b") == [("EURUSD", "eurusd"), ("EURUSD", "EURUSD"), ("A_B1", "a_b1")]


def test_price_text_formats_only_prices(rows):
    df = rows("closeBid double, volume double, ts long", (1.0, 2.0, 3), (1234567.123456, 2.0, 3))
    assert values(S.price_text(df), "closeBid", "volume", "ts") == [
        ("1.00000", 2.0, 3), ("1234567.12346", 2.0, 3)]


def test_price_that_is_no_number_empties_the_row(rows):
    df = rows("bid string, ask double, ts long", ("1.5", 2.0, 1), ("oops", 2.0, 2), (None, 2.0, 3))
    assert values(S.price_text(df), "bid", "ask", "ts") == [
        ("1.50000", "2.00000", 1), (None, None, None), (None, "2.00000", 3)]


def test_seconds_round_down(rows):
    df = rows("ms long", (1999,), (2000,), (-1,))
    assert values(df.select(S.to_seconds("ms").alias("s")), "s") == [(1,), (2,), (-1,)]


def test_tick_on_boundary_opens_next_candle(rows):
    df = rows("s long", (59,), (60,), (61,))
    assert values(df.select(S.candle_end("s", 60).alias("e")), "e") == [(60,), (120,), (120,)]


def test_label_is_utc_in_any_session_zone(spark, rows):
    df = rows("s long", (0,), (3 * 3600 + 7 * 60 + 59,), (86400 + 60,))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert values(df.select(S.time_label("s").alias("l")), "l") == [("00:00",), ("03:07",), ("00:01",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_millis_of_zoneless_time_do_not_move_with_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'1970-01-02 00:00:00.5' AS t").select(S.epoch_millis("t").alias("ms"))
        assert values(df, "ms") == [(86400500,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tail(rows):
    df = rows("a array<int>", ([1, 2, 3],), ([1],), ([],))
    assert values(df.select(S.tail("a", 2).alias("t")), "t") == [([2, 3],), ([1],), ([],)]


def test_unknown_frame_has_no_length(rows):
    df = rows("frame string", ("m1",), ("H1",), ("D9",))
    assert values(df.select(S.frame_seconds().alias("s")), "s") == [(60,), (3600,), (None,)]


def test_rounding_works_on_the_binary_value(rows):
    df = rows("x double", (1.000005,), (2.5,), (-0.000001,))
    got = values(df.select(S.fixed_text("x").alias("t"), S.fixed_round(F.col("x")).alias("r")), "t", "r")
    assert got == [("%.5f" % x, float("%.5f" % x)) for x in (1.000005, 2.5, -0.000001)]
