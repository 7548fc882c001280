"""Lookups and the forecast overlay. No join carries a broadcast hint: Catalyst and AQE
broadcast a side when its measured size is below the threshold and shuffle it otherwise."""

from pyspark.sql import functions as F

from tickloom.functions.scalar import frame_seconds


def with_symbol(df, dim, key="offer_id", name="pair"):
    """Instrument name by offer id; an id that is not listed gives a null symbol."""
    return df.join(dim.select(key, F.col(name).alias("symbol")), key, "left")


def with_interval(df, frames=None):
    """Length of the frame in seconds. The frame table is fixed, so this is an expression."""
    return df.withColumn("seconds", frame_seconds("frame", frames))


def overlay(candles, predictions, value="closeBid"):
    """Candle close and forecast on one time axis; either may be missing at a time."""
    keys = ["symbol", "frame", "ts"]
    return (candles.select(*keys, F.col("closeBid").alias("close"))
            .join(predictions.select(*keys, F.col(value).alias("forecast")), keys, "full"))
