"""Broker messages to named columns."""

from pyspark.sql import functions as F

from tickloom.operators.joins import with_symbol
from tickloom.schemas import HISTORY_FIELDS


def normalize_rates(df):
    """Price update with positional rates to a tick. Positions that are missing are null."""
    rate = [F.get("Rates", F.lit(i)) for i in range(4)]
    return df.select(F.col("Symbol").alias("symbol"), rate[0].alias("bid"), rate[1].alias("ask"),
                     rate[2].alias("high"), rate[3].alias("low"), F.col("Updated").alias("updated"))


def normalize_history(df, dim, frame=None, array="c"):
    """Positional history candle to a named candle with frame and instrument."""
    named = [F.get(array, F.lit(i)).alias(name) for i, name in enumerate(HISTORY_FIELDS)]
    if frame is not None:
        df = df.withColumn("frame", F.lit(frame))
    rows = df.select("offer_id", "frame", *named).withColumn("ts", F.col("ts").cast("long"))
    return with_symbol(rows, dim).drop("offer_id")
