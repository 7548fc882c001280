"""Recurrent models, one per series, that answer blocks.

Weights are a table with a row per series. Blocks are dealt by series and time slot and sorted behind the model row of their slot, so a task
reads rows as they come, holds one model at a time, and a series with very many blocks is many tasks.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import join_keys, time_slot
from tickloom.schemas import FEATURES, SERIES


def weight_count(hidden, columns=len(FEATURES)):
    """Numbers of a model: input, recurrent and bias weights of four gates, then those of the answer and its bias."""
    return 4 * hidden * (columns + hidden + 1) + hidden + 1


def recurrent(x, weights, hidden):
    """Answers of a long short-term memory to blocks (rows, steps, columns), all rows of a step together. The gates stand in the order
    input, forget, output, candidate."""
    n, steps, columns = x.shape
    if len(weights) != weight_count(hidden, columns):
        raise ValueError(f"{len(weights)} weights instead of {weight_count(hidden, columns)}")
    cut = np.cumsum([4 * hidden * columns, 4 * hidden * hidden, 4 * hidden, hidden])
    given, own, bias, answer, last = np.split(np.asarray(weights, float), cut)
    given, own = given.reshape(columns, 4 * hidden), own.reshape(hidden, 4 * hidden)
    h, c = np.zeros((n, hidden)), np.zeros((n, hidden))
    for t in range(steps):
        z = x[:, t] @ given + h @ own + bias
        i, f, o = (1 / (1 + np.exp(-z[:, k * hidden:(k + 1) * hidden].clip(-500, 500))) for k in range(3))
        c = f * c + i * np.tanh(z[:, 3 * hidden:])
        h = o * np.tanh(c)
    return h @ answer + last[0]


def score_by_series(blocks, models, hidden, block="block", out="out", keys=SERIES, slot=None):
    """Add the answer of its series' model to every block. `models` has one row per series with `weights`, an array in the order that
    `recurrent` reads; a series without a model, and a block that is null, get null."""
    keys, columns = list(keys), [c for c in blocks.columns if c != out]
    rows = blocks.select(*columns).withColumn("_slot", time_slot() if slot is None else slot).withColumn("_flat", F.flatten(block))
    first = join_keys(rows.select(*keys, "_slot").distinct(), models.select(*keys, F.col("weights").cast("array<double>").alias("_weights")), keys, "left")
    both = rows.withColumn("_own", F.lit(1)).unionByName(first.withColumn("_own", F.lit(0)), allowMissingColumns=True)
    placed = both.repartition(*keys, "_slot").sortWithinPartitions(*keys, "_slot", "_own").select(*columns, "_flat", "_weights", "_own")
    schema = T.StructType([blocks.schema[c] for c in columns] + [T.StructField(out, T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = None
        for batch in batches:
            own, flat = batch.column(len(columns) + 2).to_numpy(), batch.column(len(columns))
            starts = np.flatnonzero(own == 0)
            answers, given = np.full(len(own), np.nan), np.asarray(flat.is_valid())
            for low, high in zip([0, *starts], [*starts, len(own)]):
                if low < high and own[low] == 0:
                    weights = batch.column(len(columns) + 1)[int(low)].as_py()
                here = low + np.flatnonzero((own[low:high] == 1) & given[low:high])
                if weights is not None and len(here):
                    x = flat.take(pa.array(here)).flatten().to_numpy(zero_copy_only=False)
                    answers[here] = recurrent(x.reshape(len(here), -1, len(FEATURES)), weights, hidden)
                elif len(here):
                    given[here] = False
            kept = pa.array(np.flatnonzero(own == 1))
            answer = pa.array(answers, mask=~given).take(kept)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(kept) for k in range(len(columns))), answer], schema.fieldNames())

    return placed.mapInArrow(task, schema)


def series_models(models, hidden, keys=SERIES):
    """A table of models as a model for `forecast`."""
    def answer(blocks):
        return score_by_series(blocks, models, hidden, keys=keys)
    answer.of_blocks = True
    return answer
