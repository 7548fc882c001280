"""Message envelopes: rows of ``key, value, topic`` with JSON values.

The broker connector is a package of its own; ``kafka_source`` and ``kafka_sink`` only set
its options. Everything else works on any DataFrame with the envelope columns.
"""

from pyspark.sql import functions as F

from tickloom.functions.scalar import event_time, mid, price_text, to_seconds
from tickloom.schemas import TICK

# Topics are named {project}.{subject}.{version}; routing looks at the subject.
SUBJECTS = ("price", "candle", "livecandle", "predictioncandle", "news")
PRICED = ("price", "candle", "livecandle", "predictioncandle")


def decode_json(col, schema):
    """JSON text to a struct. Text that does not parse, or no text, gives a struct of nulls."""
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    data = F.from_json(F.col(col).cast("string") if isinstance(col, str) else col, schema)
    return F.coalesce(data, empty)


def decode_envelope(df, schema, value="value"):
    """Envelope rows to typed rows."""
    return df.select(decode_json(value, schema).alias("data")).select("data.*")


def decode_ticks(df):
    """Tick envelope rows to ticks with event time and mid price."""
    return (decode_envelope(df, TICK)
            .withColumn("timestamp", event_time(to_seconds("updated")))
            .withColumn("avg", mid("bid", "ask")))


def encode_envelope(df, key=None, topic=None):
    """Rows to an envelope: the whole row as JSON, with a key column's value and a topic."""
    columns = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    return df.select(*columns)


def subject(topic="topic"):
    return F.try_element_at(F.split(topic, r"\."), F.lit(2))


def route(df, schemas):
    """One mixed batch into a decoded DataFrame per subject. Prices become text, as every
    consumer of a topic gets them."""
    out = {}
    for name, schema in schemas.items():
        rows = decode_envelope(df.filter(subject() == name), schema)
        out[name] = price_text(rows) if name in PRICED else rows
    return out


def route_stream(stream, schemas, handlers, checkpoint, **trigger):
    """Run ``handler(rows, batch_id)`` per subject on every micro-batch, which is read once."""
    def run(batch, batch_id):
        batch.persist()
        try:
            for name, rows in route(batch, schemas).items():
                handlers[name](rows, batch_id)
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def kafka_source(spark, servers, topics, max_offsets=None):
    """Stream of an envelope from the earliest offset. The input cap belongs to the source."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic")


def kafka_sink(df, servers, checkpoint, topic=None):
    """Write an envelope stream; the topic is an option or a column."""
    writer = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("checkpointLocation", checkpoint))
    return (writer.option("topic", topic) if topic else writer).start()
