"""Embeddings whitened along their leading principal directions.

Entries become whole numbers, so equal vectors are found and summed exactly. Every task reduces the centred distinct vectors it holds to a
triangle by blockwise QR, triangles are merged in rounds, and the last one, of dimensions x dimensions, gives all singular values and the
leading directions on the driver (see `bidiagonal`).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bidiagonal import EPS, right_singular
from tickloom.llm.components import written
from tickloom.llm.words import frugal, ship

SCALE = 256
COMPONENTS = 4
MERGED = 32             # triangles merged by one task, and by the driver at the end


class Whitening(NamedTuple):
    n: int                  # distinct vectors
    total: list[int]        # sum of each dimension over them
    mean: np.ndarray
    variance: np.ndarray    # of the leading components, falling
    axes: np.ndarray        # dimensions x components, unit columns
    explained: np.ndarray   # shares of the whole variance


def whole_vectors(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The columns `keep` and `x`, floor(256 * entry) of each entry as a long, held at the ends of its range. Rows go whose
    vector is null or empty or has an entry that is null or not finite."""
    known = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return df.where(known).select(*keep, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def sums(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension. A task sums the halves of each number apart."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dimensions, np.int64), np.zeros(dimensions, np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dimensions)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(np.full(dimensions, n)), pa.array(high), pa.array(low)], ["d", "n", "high", "low"])

    found = (fit.mapInArrow(frugal(task), "d int, n long, high long, low long").groupBy("d")
             .agg(F.sum("n"), *[F.sum(F.col(c).cast("decimal(38,0)")) for c in ("high", "low")]).orderBy("d").collect())
    return (int(found[0][1]) if found else 0), [(int(r[2]) << 32) + int(r[3]) for r in found]


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square also for few rows."""
    d = rows.shape[1]
    return np.linalg.qr(rows if len(rows) >= d else np.vstack([rows, np.zeros((d - len(rows), d))]), mode="r")


def triangle(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of all centred vectors. Each task keeps one triangle; MERGED of them become one until so few are left."""
    d = len(mean)

    def reduced(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        held = None
        for rows in blocks:
            held = _triangle(rows if held is None else np.vstack([held, rows]))
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["r"])

    def start(batches):
        return reduced(matrix(batch.column(0), d) - mean for batch in batches if len(batch))

    def merge(batches):
        return reduced(np.frombuffer(r, float).reshape(d, d) for batch in batches for r in batch.column(0).to_pylist())

    parts = written(fit.mapInArrow(frugal(start), "r binary"), "triangles")
    while (count := parts.count()) > MERGED:
        parts = written(parts.repartition(-(-count // MERGED)).mapInArrow(frugal(merge), "r binary"), "triangles")
    held = [np.frombuffer(r["r"], float).reshape(d, d) for r in parts.collect()]
    return _triangle(np.vstack(held))


def fit_whitening(fit: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors `x`; None without any. Directions in which they do not differ are left out."""
    n, total = sums(fit, dimensions)
    if not n:
        return None
    mean = np.array([s / n for s in total])
    values, axes = right_singular(triangle(fit, mean), min(components, dimensions))
    used = int(np.count_nonzero(values[:components] > (8 * max(dimensions, 10) * EPS) ** 2 * values[0]))
    return Whitening(n, total, mean, values[:used] / n, axes[:, :used], values[:used] / max(values.sum(), np.finfo(float).tiny))


def projected(x: np.ndarray, fit: Whitening) -> np.ndarray:
    return (x - fit.mean) @ (fit.axes / np.sqrt(fit.variance))


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened vectors minus the identity."""
    d, k = len(fit.mean), len(fit.variance)
    if not k:
        return 0.0
    shared = rows.sparkSession.sparkContext.broadcast(fit)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((k, k))
        for batch in batches:
            w = projected(matrix(batch.column(0), d), shared.value)
            held += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(held.ravel())], ["cell", "v"])

    cells = rows.mapInArrow(frugal(task), "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).orderBy("cell").collect()
    return float(np.abs(np.array([r["v"] for r in cells]).reshape(k, k) / fit.n - np.eye(k)).max())


def deviations(x: np.ndarray, fit: Whitening) -> list[int | None]:
    """The exact sum over dimensions of (n x - S)^2; null where it does not fit in 64 bits."""
    total = np.array(fit.total, float)
    most = np.abs(x.astype(float)) * fit.n + np.abs(total)
    if most.max(initial=0) < 2.0 ** 62:
        off = x * np.int64(fit.n) - np.array(fit.total, np.int64)
        if (off.astype(float) ** 2).sum(axis=1).max(initial=0) < 2.0 ** 62:
            return (off * off).sum(axis=1).tolist()
    exact = [sum((fit.n * v - s) ** 2 for v, s in zip(row, fit.total)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row for every usable row of `df` and each of the leading components, with `component` from 1, `n`, `deviation`,
    `whitened`, `explained` and `identity_error`; other columns go.

    Covariances are over the distinct vectors, so repeated rows and ids count once, but each row is returned. Vectors are usable
    as `whole_vectors` says; of vectors of several lengths those of the most frequent one (the longest in a tie) are used and the others go.
    Components along which nothing varies are left out: one distinct vector, like an empty table, gives no row. Where variances
    tie, any orthogonal axes of theirs are taken."""
    spark = df.sparkSession
    ship(spark)
    usable = whole_vectors(df, vector, (vec_id,))
    length = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = f"{vec_id} {df.schema[vec_id].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if length is None:
        return spark.createDataFrame([], schema)
    d = length["d"]
    usable = usable.where(F.size("x") == d)
    distinct = written(usable.select("x").distinct(), "vectors")
    fit = fit_whitening(distinct, d, components)
    k, error = len(fit.variance), identity_error(distinct, fit)
    shared = spark.sparkContext.broadcast(fit)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        for batch in batches:
            x = matrix(batch.column(1), d)
            rows = len(x)
            repeated = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(repeated), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, fit.n)),
                pa.array(deviations(x, fit), pa.int64()).take(repeated), pa.array(projected(x, fit).ravel()),
                pa.array(np.tile(fit.explained, rows)), pa.array(np.full(rows * k, error))],
                [vec_id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(frugal(task), schema)
