"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms describe the writing rather than the topic: which kinds of characters stand together in a word, word lengths, how
much of the text repeats itself, and hashed words with a small weight. A bounded sample of labelled documents gives the
term weights and, by a singular value decomposition, the space; its vectors are broadcast. Every
document is projected, compared exactly with all of them by blocked cosine products, and takes the
labels of its nearest neighbours, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.words import SPACE, Words, columns_for, frugal, mix, ship, texts, word_groups

SAMPLE = 6000            # labelled documents the space and the votes come from
DIMENSIONS = 64
NEIGHBOURS = 5
BLOCK = 512              # documents compared at a time
THRESHOLD = 0.7
JUDGED = "judged_by_a_vote"

KINDS, LENGTHS, WORDS = 1024, 16, 512
REPEATED = np.array([0.01, 0.05, 0.2, 0.35, 0.5, 0.65, 0.8])     # shares of three words in a row that stood before
ECHOED = np.array([0.02, 0.1, 0.3])                             # shares of words that stand twice in a row
SIZES = [KINDS, LENGTHS, len(REPEATED) + 1, len(ECHOED) + 1, WORDS]
AT = np.concatenate([[0], np.cumsum(SIZES)])
TERMS = int(AT[-1])
WEIGHTS = np.repeat(np.array([1.0, 0.3, 0.7, 0.7, 0.05], np.float32), SIZES)


def _kind_bits() -> np.ndarray:
    """A bit for each kind of byte: small, capital, digit, other letter, and each sign, some sharing one."""
    bits = np.zeros(256, np.uint64)
    sign = 0
    for byte in range(33, 256):
        if 97 <= byte <= 122:
            bits[byte] = 1
        elif 65 <= byte <= 90:
            bits[byte] = 2
        elif 48 <= byte <= 57:
            bits[byte] = 4
        elif byte >= 128:
            bits[byte] = 1           # part of a letter in most texts
        else:
            bits[byte] = 1 << (3 + sign)
            sign += 1
    return bits


_KIND = _kind_bits()


def term_vectors(found: Words, original: np.ndarray) -> np.ndarray:
    """Square roots of the shares of every term in each row; a row of zeros for a text without words."""
    rows = len(found.first) - 1
    out = np.zeros((rows, TERMS), np.float32)
    if not len(found.number):
        return out
    counts = np.diff(found.first)
    row = np.repeat(np.arange(rows), counts)
    kinds = np.bitwise_or.reduceat(_KIND[original], found.start)
    kind = (mix(kinds) % np.uint64(KINDS)).astype(np.int64)
    length = AT[1] + np.minimum(found.end - found.start, LENGTHS) - 1
    word = AT[4] + (found.number % np.uint64(WORDS)).astype(np.int64)
    shares = np.bincount(np.concatenate([row * TERMS + t for t in (kind, length, word)]), minlength=rows * TERMS).reshape(rows, TERMS)
    out[:] = np.sqrt(shares / np.maximum(counts, 1)[:, None])
    with np.errstate(over="ignore"):
        three = found.number.copy()
        three[:-1] += found.number[1:] * np.uint64(0xA24BAED4963EE407)
        three[:-2] += found.number[2:] * np.uint64(0x9FB21C651E98DF25)
    for r in np.flatnonzero(counts):
        here = np.sort(three[found.first[r]:max(found.first[r] + 1, found.first[r + 1] - 2)])
        again = np.count_nonzero(here[1:] == here[:-1]) / len(here)
        out[r, AT[2] + np.searchsorted(REPEATED, again, "right")] = 1
        own = found.number[found.first[r]:found.first[r + 1]]
        out[r, AT[3] + np.searchsorted(ECHOED, np.count_nonzero(own[1:] == own[:-1]) / len(own), "right")] = 1
    return out


def text_vectors(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """`term_vectors` of a column, one group of rows after the other."""
    for at, to, found in word_groups(column, SPACE):
        yield at, to, term_vectors(found, texts(column.slice(at, to - at))[0])


class Space(NamedTuple):
    weight: np.ndarray       # per term
    axes: np.ndarray         # terms x dimensions
    known: np.ndarray        # unit vectors of the labelled documents
    label: np.ndarray        # 0 to 1 each
    prior: float             # the mean label, for texts with nothing to compare


def unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(size > 0, size, 1)


def fit(vectors: np.ndarray, label: np.ndarray, dimensions: int = DIMENSIONS) -> Space:
    """The space of a sample: rare terms weigh more, and the leading right singular vectors are its axes."""
    if not len(vectors):
        return Space(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), label, 0.5)
    weight = WEIGHTS * np.log((1 + len(vectors)) / (1 + np.count_nonzero(vectors, axis=0)) + 0.05).clip(0).astype(np.float32)
    terms = unit(vectors * weight)
    _, axes = np.linalg.eigh((terms.T @ terms).astype(np.float64))
    axes = np.ascontiguousarray(axes[:, ::-1][:, :min(dimensions, TERMS)], np.float32)
    return Space(weight, axes, unit(terms @ axes).astype(np.float32), label.astype(np.float32), float(label.mean()))


def vote(space: Space, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The mean label of the nearest labelled documents, weighted by similarity. All that are as near as the last
    neighbour vote too, so the order of equal ones doesn't matter."""
    return votes(space, vectors, neighbours)[0]


def votes(space: Space, vectors: np.ndarray, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
    """The scores of `vote`, and which of them neighbours gave; the others are the prior."""
    score, judged = np.full(len(vectors), space.prior), np.zeros(len(vectors), bool)
    if not len(space.known):
        return score, judged
    for at in range(0, len(vectors), BLOCK):
        here = unit(unit(vectors[at:at + BLOCK] * space.weight) @ space.axes).astype(np.float32)
        near = here @ space.known.T
        k = min(neighbours, near.shape[1])
        last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k, None]
        near = np.where((near >= last) & (near > 0), near, 0)
        total = near.sum(axis=1, dtype=np.float64)
        voted = near.astype(np.float64) @ space.label
        judged[at:at + BLOCK] = total > 0
        score[at:at + BLOCK] = np.where(total > 0, voted / np.where(total > 0, total, 1), space.prior)
    return score.clip(0, 1).round(6), judged


def held_out(doc_id: str) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_space(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int) -> Space:
    """The space of the `sample` labelled documents with the least hashed ids among those not held out. A
    document labelled twice has the mean label; of several texts with one id one counts."""
    marked = (labels.where(~held_out(doc_id)).where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(doc_id).alias("doc_id")).agg(F.avg(label).cast("double").alias("label")))
    ids = docs.select(F.col(doc_id).alias("doc_id")).where(F.col("doc_id").isNotNull())
    known = marked.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)   # ids and labels

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, vectors in text_vectors(batch.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), pa.array([v.tobytes() for v in vectors.astype(np.float16)], pa.binary())],
                    names=["doc_id", "label", "terms"])

    kind = docs.schema[doc_id].dataType.simpleString()
    texts = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
             .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    found = texts.mapInArrow(frugal(task), f"doc_id {kind}, label double, terms binary").orderBy("doc_id").collect()
    vectors = np.array([np.frombuffer(r["terms"], np.float16) for r in found], np.float32).reshape(len(found), TERMS)
    return fit(vectors, np.array([r["label"] for r in found], np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
                   sample: int = SAMPLE, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with `held_out`, `score` (0 to 1, higher: label 1 likelier) and `predicted` (1 from `threshold` on).

    The score comes from the text alone. Texts that are null, empty or without words get the mean label
    of the sample; without any label all scores are 0.5. Repeated rows are scored one by one. Columns
    named like an added one are replaced; `keep` names those that are carried along, all by default."""
    scored = _scored(docs, labels, text, doc_id, label, sample, neighbours, threshold, keep)
    return scored.drop(JUDGED)


def _scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
            sample: int = SAMPLE, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """`quality_scores` with the column `JUDGED`: whether a vote gave the score."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(sample_space(docs, labels, text, doc_id, label, sample))
    carried = [c for c in (docs.columns if keep is None else keep) if c not in ("held_out", "score", "predicted")]
    names, place, places = columns_for(text, carried)
    schema = T.StructType([docs.schema[c] for c in carried] + [T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField(JUDGED, T.BooleanType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, vectors in text_vectors(batch.column(place)):
                part = batch.slice(at, to - at)
                score, judged = votes(shared.value, vectors, neighbours)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), part.column(len(names)), pa.array(score), pa.array(judged)], schema.fieldNames())

    scored = docs.select(*names, held_out(doc_id).alias("held_out")).mapInArrow(frugal(task), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`docs` without those that a vote rejects; options as in `quality_scores`. Texts that nothing is compared with stay: those
    without words, and all of them if no label was learned from."""
    return _scored(docs, labels, **options).where(f"predicted = 1 or not {JUDGED}").select(*docs.columns)
