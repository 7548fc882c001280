"""Row schemas and the few fixed tables every module shares."""

from pyspark.sql import types as T

# Frame ids and their length in seconds.
FRAMES = {
    "m1": 60,
    "m30": 1800,
    "H1": 3600,
}

# Columns that hold a price and become five-decimal text at a sink.
PRICE_COLUMNS = [
    "bid", "lowBid", "highBid", "openBid", "closeBid",
    "ask", "lowAsk", "highAsk", "openAsk", "closeAsk",
    "high", "low",
]

# Positions of a history array.
HISTORY_FIELDS = [
    "ts",
    "openBid", "closeBid", "highBid", "lowBid",
    "openAsk", "closeAsk", "highAsk", "lowAsk",
    "volume",
]

# Model input columns, in order.
FEATURES = [
    "openBid", "highBid", "lowBid", "closeBid",
    "bbupper", "bblower",
    "body", "up", "down",
    "rsi",
]

# A series is one instrument at one frame.
SERIES = ("symbol", "frame")

TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("updated", T.LongType()),
])

OHLC = ["openBid", "closeBid", "highBid", "lowBid", "openAsk", "closeAsk", "highAsk", "lowAsk"]

CANDLE = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("frame", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in OHLC]
    + [T.StructField("ts", T.LongType())]
)

PREDICTION = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("frame", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

NEWS = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("summary", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("source", T.StringType()),
])

RATES = T.StructType([
    T.StructField("Symbol", T.StringType()),
    T.StructField("Rates", T.ArrayType(T.DoubleType())),
    T.StructField("Updated", T.LongType()),
])

NEWS = T.StructType([T.StructField(c, T.LongType() if c == "time" else T.StringType())
                     for c in ("title", "url", "time", "summary", "content", "symbol", "source")])
