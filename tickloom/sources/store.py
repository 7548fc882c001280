"""Keyed tables: upserts, first-write-wins loads and partitioned files."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import keep_first, latest, packed_rank, time_slot
from tickloom.schemas import SERIES


def upsert(table, batch, keys, order=()):
    """Last write wins, whole rows: a batch row replaces the table row of its key, and of
    several batch rows the last by `order` counts."""
    both = (table.withColumn("_new", F.lit(0).cast("byte"))
            .unionByName(batch.withColumn("_new", F.lit(1).cast("byte")), allowMissingColumns=True))
    return latest(both, keys, ["_new", *order]).drop("_new")


def set_fields(table, batch, keys, order=()):
    """Last write wins, field by field: a field that is absent (null) in the new record
    keeps its old value. One aggregation, combined before the shuffle."""
    both = (table.withColumn("_new", F.lit(0).cast("byte"))
            .unionByName(batch.withColumn("_new", F.lit(1).cast("byte")), allowMissingColumns=True))
    when = packed_rank([(c, both.schema[c].dataType) for c in ("_new", *order)])
    when = F.struct("_new", *order) if when is None else when
    fields = [c for c in both.columns if c not in (*keys, "_new")]
    return both.groupBy(*keys).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in fields])


FILTER_BITS, LISTED = 1 << 20, 1000


def maybe_in(table, batch, keys, bits=FILTER_BITS):
    """The rows of `table` whose key may occur in `batch`: all that do, and few others. Bounds of the batch's numbers and times, and its texts
    where they are few, are constants, which prune partitions and row groups; of the rest a bit filter keeps the keys whose hash the
    batch has too. It works before any shuffle of the table, and holds `bits` bits."""
    rows = batch.select(*keys).persist()
    try:
        kept = table
        for key in keys:
            if isinstance(rows.schema[key].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
                low, high = rows.agg(F.min(key), F.max(key)).first()
                kept = kept.filter(F.lit(False) if low is None else F.col(key).between(low, high))
            else:
                found = [r[0] for r in rows.select(key).distinct().limit(LISTED + 1).collect()]
                if len(found) <= LISTED:
                    kept = kept.filter(F.col(key).isin([v for v in found if v is not None]))
        hashed = F.pmod(F.xxhash64(*keys), F.lit(bits))
        words = {r["word"]: r["held"] for r in rows.select(hashed.alias("h")).groupBy(F.floor(F.col("h") / 64).alias("word"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(h % 64 as int)))").alias("held")).collect()}
    finally:
        rows.unpersist()
    held = F.lit(",".join(str(words.get(k, 0)) for k in range(bits // 64)))
    number = F.element_at(F.split(held, ",").cast("array<bigint>"), (F.floor(hashed / 64) + 1).cast("int"))
    return kept.filter(F.getbit(number, F.pmod(hashed, F.lit(64)).cast("int")) == 1)


def insert_ignore(table, batch, keys, order=()):
    """First write wins: only batch rows with a new key are added, the first of each. Of the table only rows that may have such a
    key are read for the comparison."""
    return table.unionByName(new_rows(table, batch, keys, order), allowMissingColumns=True)


def new_rows(table, batch, keys, order=()):
    """What `insert_ignore` adds."""
    new = keep_first(batch, keys, order) if order else batch.dropDuplicates(list(keys))
    return new.join(maybe_in(table, batch, keys).select(*keys), list(keys), "left_anti")


def write_partitioned(df, path, by=SERIES, slot=None, mode="overwrite"):
    """One folder per series. Rows are shuffled by series and time slot first: a folder gets
    few files, and a large series is still written by many tasks. Files are sorted by time, so
    that a range of times skips row groups."""
    slot = time_slot() if slot is None else slot
    (df.withColumn("_slot", slot).repartition(*by, "_slot").drop("_slot").sortWithinPartitions(*by, "ts")
     .write.mode(mode).partitionBy(*by).parquet(path))


NEWS_COLUMNS = ["title", "url", "time", "summary", "content"]


def write_tsv(df, path, columns=NEWS_COLUMNS):
    """Tab-separated news with a header line in every file."""
    (df.select(*columns).write.option("sep", "\t").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path, header=True))


def read_tsv(spark, path, schema):
    """Read the export back. The format has no nulls: an empty field is empty text."""
    rows = (spark.read.schema(schema).option("sep", "\t").option("escape", '"')
            .option("multiLine", True).csv(path, header=True))
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return rows.fillna("", subset=texts)


class KeyedTable:
    """A keyed table on files that takes micro-batches.

    A write adds the folder ``batch=<id>`` and never touches older ones, so it costs as
    much as the batch, and a batch that is replayed after a failure replaces its own
    folder only. A read keeps the newest row per key. ``compact`` writes the result as a
    new table with a single folder.
    """

    def __init__(self, spark, path, schema, keys, partition_by=()):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.keys = list(keys)
        self.partition_by = list(partition_by)

    def versions(self):
        """All rows ever written, with their batch id."""
        fields = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        try:
            return self.spark.read.schema(fields).option("basePath", self.path).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], fields)

    def read(self, where=None):
        """Current rows. `where` must look at key or partition columns only, so that it
        may be applied before the newest row is picked."""
        rows = self.versions()
        if where is not None:
            rows = rows.filter(where)
        return latest(rows, self.keys, "batch").drop("batch")

    def before(self, batch_id):
        """Current rows as they were before a batch."""
        return latest(self.versions().filter(F.col("batch") < batch_id), self.keys, "batch").drop("batch")

    def upsert(self, batch, batch_id, order=()):
        """Write the batch; of several rows with one key the last by `order` counts."""
        self._write(latest(batch, self.keys, order) if order else batch, batch_id)

    def insert_ignore(self, batch, batch_id, order=()):
        """Write only rows whose key no earlier batch holds."""
        self._write(new_rows(self.versions().filter(F.col("batch") < batch_id), batch, self.keys, order), batch_id)

    def compact(self, path):
        """A copy with the current rows only."""
        copy = KeyedTable(self.spark, path, self.schema, self.keys, self.partition_by)
        copy._write(self.read(), 0)
        return copy

    def _write(self, rows, batch_id):
        writer = rows.select(*self.schema.names).write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/batch={batch_id}")


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
