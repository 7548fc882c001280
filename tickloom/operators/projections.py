"""Shapes in which rows leave the engine."""

from pyspark.sql import functions as F


def chart_rows(df):
    """Bid candle as a chart bar, with the series keys kept."""
    return df.select("symbol", "frame", F.col("ts").alias("time"), F.col("openBid").alias("open"),
                     F.col("highBid").alias("high"), F.col("lowBid").alias("low"),
                     F.col("closeBid").alias("close"))


def line_rows(df):
    """Chart bar as a line point."""
    return df.select("symbol", "frame", "time", F.col("close").alias("value"))


def feed_items(df):
    """News row as a feed item: short text, time in milliseconds."""
    return df.select("title", F.substring("summary", 1, 200).alias("content"), F.col("url").alias("link"),
                     "source", (F.col("time") * 1000).alias("created_at"))


def payload(df, keys=("symbol", "frame", "_id")):
    """Record without its routing keys and storage id."""
    return df.drop(*keys)


def news_page(df, offset=0, limit=20):
    """One page of news, newest first; the url breaks ties. All rows up to the page meet in one task: `deep_news_page` is for pages far
    down."""
    return df.orderBy(F.col("time").desc(), F.col("url")).offset(offset).limit(limit)


RANGES, RANGE_ROWS = 1024, 100_000


def deep_news_page(df, offset, limit=20, rows=RANGE_ROWS):
    """The same page, of any depth. Articles are counted by ranges of their time, finer and finer, until the ranges that the page
    lies in hold at most `rows` articles or are one second long; only these are sorted. A range is at most 1,024 counts in the driver.
    Articles without a time come last, as one range."""
    low, high, named = df.agg(F.min("time"), F.max("time"), F.count("time")).first()
    if offset >= named:
        return df.filter(F.col("time").isNull()).orderBy("url").offset(offset - named).limit(limit)
    skip, last = offset, min(offset + limit, named) - 1
    while True:
        width = (high - low) // RANGES + 1
        place = F.floor((F.col("time") - low) / width).alias("place")
        counts = df.filter(F.col("time").between(low, high)).groupBy(place).count().orderBy(F.desc("place")).collect()
        above, inside, ranges = 0, 0, []
        for place_, count in counts:
            if above + inside <= last and above + inside + count > skip:
                ranges.append(place_)
                inside += count
            elif not ranges:
                above += count
        low, high, was = low + ranges[-1] * width, min(high, low + (ranges[0] + 1) * width - 1), (low, high)
        skip, last = skip - above, last - above
        if inside <= rows or width == 1 or (low, high) == was:
            break
    here = F.col("time").between(low, high)
    if offset + limit > named:
        here = here | F.col("time").isNull()
    return df.filter(here).orderBy(F.col("time").desc(), F.col("url")).offset(skip).limit(limit)
