"""Words of whole texts as numpy arrays, shared by the operators that run inside Arrow tasks.

A word is a run of bytes that are not separators. Its number is a polynomial in its bytes, taken
from prefix sums, so equal words have equal 64-bit numbers wherever they stand. Memory is bounded:
a column is read in groups of rows and a group in blocks of bytes that end at a separator.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK = 1 << 18          # bytes hashed at a time; a worker keeps two tables of so many powers
GROUP = 2 << 20          # bytes of text handed out at a time, or one longer row

BATCH_BYTES = 8 << 20    # of an Arrow batch

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32      # A-Z only: other letters have bytes from 0x80
_NUMBER = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes inside the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: White space as the shingle contract lists it, and all that is no letter, digit or non-ASCII byte.
SPACE = separators((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


class Words(NamedTuple):
    """Words of a group of rows: `first[i]:first[i + 1]` are the words of row i."""
    number: np.ndarray   # uint64 per word
    start: np.ndarray    # byte offset of each word in `data`
    end: np.ndarray
    first: np.ndarray    # rows + 1
    data: np.ndarray     # lower-cased bytes of the group


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, BLOCK) - 1, base, np.uint64)]))
        if len(have) <= 2 * BLOCK:
            _powers[base] = have
    return have[:n]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of every row; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The 64-bit number of every run of bytes; runs are in order and don't overlap."""
    number = np.empty(len(start), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(start):
            base = start[at]
            to = max(at + 1, int(np.searchsorted(end, base + BLOCK, "right")))
            block = data[base:end[to - 1]]
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(_NUMBER[block] * _power(_BASE, len(block)), out=sums[1:])
            s, e = start[at:to] - base, end[at:to] - base
            number[at:to] = mix((sums[e] - sums[s]) * _power(_INVERSE, int(s[-1]) + 1)[s])
            at = to
    return number


def words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> Words:
    """Words of the rows of `texts`, without separators, A-Z lower-cased."""
    data = _LOWER[data]
    inside = ~apart[data]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[rows] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[rows[rows > 0] - 1] = False
    if len(after):
        after[-1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(numbers(data, start, end), start, end, np.searchsorted(start, offsets), data)


def groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most GROUP bytes, or one row."""
    data, offsets = texts(column)
    at, rows = 0, len(column)
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + GROUP, "right")) - 1)
        yield at, min(to, rows)
        at = to


def word_groups(column: pa.Array, apart: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """`words` of a whole column, one group of rows after the other."""
    for at, to in groups(column):
        data, offsets = texts(column.slice(at, to - at))
        yield at, to, words(data, offsets, apart)


def shingles(number: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct numbers of all runs of `size` words; fewer words are one run, none give none."""
    if not len(number):
        return number
    width = min(size, len(number))
    with np.errstate(over="ignore"):
        run = number[:len(number) - width + 1] + np.uint64(width)
        for k in range(1, width):
            run = run * np.uint64(0xA24BAED4963EE407) + number[k:len(number) - width + 1 + k]
        run = mix(run)
    run.sort()
    return run[np.concatenate([[True], run[1:] != run[:-1]])]


def frugal(task):
    """A task that at its end gives free memory back to the machine, since its Python worker lives on. What
    Arrow holds is returned everywhere, what the C library holds where it can trim."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)
    return run


def columns_for(text: str, carried: list[str]) -> tuple[list[str], int, list[int]]:
    """The columns a task reads, each once: their names, the place of the text and those of the carried ones."""
    names = carried if text in carried else [text, *carried]
    return names, names.index(text), [names.index(c) for c in carried]


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver does; a cluster job
    sends it along with --py-files. And let no Arrow batch of long texts grow beyond BATCH_BYTES: the session's own limit
    stays if it is lower."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(limit).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(limit, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
