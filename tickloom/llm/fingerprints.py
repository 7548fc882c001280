"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases level by level. Runs of one symbol become one; deterministic coin tossing then gives
every symbol a label from 0 to 5 that differs from its neighbour's and depends on a few symbols before it only; a
phrase begins at every local maximum of the labels, and its name, a hash of its symbols, is a symbol of the next
level. What a phrase is called depends on the text near it and not on its place, so equal passages have
equal names but at their ends. The fingerprint samples the names of the last level by least hashes, and
the share of equal samples is the likeness of two texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import frugal, mix, ship

LEVELS = 2               # names stand for about ten bytes
SAMPLES = 128
GROUP = 1 << 19          # bytes of text parsed together
BUCKETS_PER_PARTITION = 4
BUCKET_ROWS = 20_000
MOST_BUCKETS = 1 << 16   # whose first rows pass the driver

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _first_of_row(row: np.ndarray) -> np.ndarray:
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    return first


def _runs_joined(symbol: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol in a row as one symbol that has the length in its name."""
    start = _first_of_row(row)
    start[1:] |= symbol[1:] != symbol[:-1]
    at = np.flatnonzero(start)
    if len(at) == len(symbol):
        return symbol, row
    length = np.diff(at, append=len(symbol)).astype(np.uint64)
    name = symbol[at]
    long = length > 1
    name[long] = mix(name[long] + length[long] * _STEP)
    return name, row[at]


def _labels(symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels from 0 to 5 by four rounds of coin tossing: the place of the lowest bit in which a symbol
    differs from the one before it, and that bit. Neighbours that differ keep different labels."""
    label = symbol
    for _ in range(4):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ label.dtype.type(1)
        differ = label ^ before
        differ[differ == 0] = 1          # a hash that happens to equal its neighbour
        low = differ & (~differ + label.dtype.type(1))
        label = (np.bitwise_count(low - label.dtype.type(1)) * np.uint8(2) + ((label & low) != 0)).astype(np.uint8)
    return label


def phrases(symbol: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the phrases of one level and the row of each."""
    with np.errstate(over="ignore"):
        symbol, row = _runs_joined(symbol, row)
        first = _first_of_row(row)
        label = _labels(symbol, first)
        start = first.copy()
        start[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
        at = np.flatnonzero(start)
        length = np.diff(at, append=len(symbol))
        place = (np.arange(len(symbol)) - np.repeat(at, length)).astype(np.uint64)
        name = np.add.reduceat(mix(symbol + (place + np.uint64(1)) * _STEP), at)
        return mix(name + length.astype(np.uint64)), row[at]


def _counted(symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Names with the number of times they stood in the row before, so that repetition counts."""
    order = np.lexsort((symbol, row))
    new = np.ones(len(order), bool)
    new[1:] = (symbol[order][1:] != symbol[order][:-1]) | (row[order][1:] != row[order][:-1])
    start = np.flatnonzero(new)
    times = np.empty(len(order), np.uint64)
    times[order] = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
    with np.errstate(over="ignore"):
        return np.where(times > 0, mix(symbol + times * _STEP), symbol)


def sketches(texts: list[bytes]) -> np.ndarray:
    """SAMPLES bytes for each text; the empty text has zeros only, and others have none."""
    out = np.zeros((len(texts), SAMPLES), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return out
    symbol = mix(np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1))
    row = np.repeat(np.arange(len(texts)), sizes)
    for _ in range(LEVELS):
        symbol, row = phrases(symbol, row)
    symbol = _counted(symbol, row)
    rows, at = np.unique(row, return_index=True)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(_MULTIPLIERS):
            hashed = symbol * factor
            hashed ^= hashed >> np.uint64(31)
            least = np.minimum.reduceat(hashed * _STEP, at)
            out[rows, k] = mix(least) % np.uint64(255) + np.uint64(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal samples, less what falls together by chance; 1 for equal sketches."""
    equal = (a == b).mean(axis=1)
    chance = 1 / 255
    return ((equal - chance) / (1 - chance)).clip(0, 1).round(6)


def edited_text(text: str, following: str) -> str:
    """`text` with its last half replaced by as many code points from the start of `following`."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_id_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (bucket, after, doc_id, text) dealt by ranges of ids and sorted within them, ids that are null first
    and equal ids by a hash of the text. The first row of a bucket is there a second time at the end of the bucket
    before it, marked `after`, and the first of all at the end of the last one. Only the first row of every bucket, of
    MOST_BUCKETS at most, passes the driver, without its text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    count = rows.count()
    buckets = min(max(BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), count // BUCKET_ROWS), MOST_BUCKETS)
    ranged = rows.select("doc_id", "h").repartitionByRange(buckets, "doc_id").select(F.spark_partition_id().alias("b"), F.struct("doc_id", "h").alias("first"))
    heads = [r["first"] for r in ranged.groupBy("b").agg(F.min("first").alias("first")).orderBy("b").collect()]
    shared = spark.sparkContext.broadcast(([h["doc_id"] for h in heads], [h["h"] for h in heads]))

    def place(ids: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        first, first_hash = shared.value
        null = ids.isna().to_numpy()
        known = ids.where(~null, first[1] if len(first) > 1 else None)
        bucket = np.zeros(len(ids), np.int64)
        if len(first) > 1:
            bucket = np.searchsorted(np.array(first[1:]), known.to_numpy(dtype=np.array(first[1:]).dtype), "right")
            bucket[null] = 0
        same_id = np.array([(first[b] is None) if n else first[b] == i for b, i, n in zip(bucket, ids, null)], bool)
        head = same_id & (np.array(first_hash, np.int64)[bucket] == hashes.to_numpy()) if len(first) else same_id
        return pd.DataFrame({"bucket": bucket, "before": np.where(head, (bucket - 1) % max(len(first), 1), -1)})

    placed = rows.withColumn("at", F.pandas_udf(place, "bucket long, before long")("doc_id", "h"))
    own = F.struct(F.col("at.bucket").alias("bucket"), F.lit(0).alias("after"))
    again = F.struct(F.col("at.before").alias("bucket"), F.lit(1).alias("after"))
    placed = placed.select("doc_id", "text", "h", F.explode(F.when(F.col("at.before") >= 0, F.array(own, again)).otherwise(F.array(own))).alias("at"))
    return placed.select("at.*", "doc_id", "h", "text").repartition(max(1, buckets // BUCKETS_PER_PARTITION), "bucket").sortWithinPartitions("bucket", "after", "doc_id", "h")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The fingerprint of every text, and of the text edited with the next document's.

    Returns `doc_id`, `n_chars` (code points), `edited_sha256`, `fingerprint` and `edited_fingerprint` (hex, two digits a
    sample), `near_edited` and `near_next`, the likeness to the edited text and to the next document by ascending id; the
    first follows the last. Null is the empty text, which is like empty texts only. Null ids come first; rows with one id are
    in the order of a hash of their texts; repeated rows are like themselves. Other columns are not read. A task holds a group of
    texts of half a megabyte or one longer text at a time."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = pa.int64()

        def pairs():
            """(id, text, text that follows, whether that is the next row's)"""
            nonlocal id_type
            last = None
            for batch in batches:
                id_type = batch.column(2).type
                for bucket, after, i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4)):
                    body = body.as_py()
                    if last is not None and last[0] == bucket:
                        yield last[1], last[2], body
                    last = None if after else (bucket, i, body)

        def done(group: list[tuple]) -> pa.RecordBatch:
            ids, own, following = zip(*group)
            edited = [edited_text(t, n).encode() for t, n in zip(own, following)]
            own_bytes = [t.encode() for t in own]
            alone = [k for k in range(len(own)) if k + 1 == len(own) or following[k] is not own[k + 1]]
            made = sketches(own_bytes + [following[k].encode() for k in alone])
            of_next = np.arange(1, len(own) + 1)
            of_next[alone] = np.arange(len(own), len(own) + len(alone))
            of_edited = sketches(edited)
            return pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array([len(t) for t in own], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
                pa.array([s.tobytes().hex() for s in made[:len(own)]]), pa.array([s.tobytes().hex() for s in of_edited]),
                pa.array(likeness(made[:len(own)], of_edited)), pa.array(likeness(made[:len(own)], made[of_next]))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        group, held = [], 0
        for pair in pairs():
            group.append(pair)
            held += len(pair[1])
            if held >= GROUP:
                yield done(group)
                group, held = [], 0
        if group:
            yield done(group)

    return in_id_order(docs, doc_id, text).mapInArrow(frugal(task), schema)
