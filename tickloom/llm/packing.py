"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into classes by reciprocal: class k holds lengths in (capacity / (k + 1), capacity / k], and a
bin of class k is full after k pieces, so every task fills its own bins without a shuffle. Since documents
may be cut, a length that would leave a gap in its class is cut at the top of the next class, whose bins it
fills without a gap, and the rest is classed in turn; the rests shrink fast, so a document is in few pieces.
Short rests go to one bin that is filled to the brim, the last class of the method. What is left in the open
bins at the end of a task is laid end to end, and its last sequence is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.words import _LOWER, frugal, groups, numbers, ship, texts

CAPACITY = 4096
CLASSES = 16             # lengths under capacity / CLASSES share one bin
SLACK = 64               # a gap under 1 / SLACK of the slot is not worth a cut
END = 2                  # the id that ends a document
CACHED_WORDS = 600_000
ENCODED = 2048           # words encoded at a time

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SPACE = np.zeros(256, bool)
_SPACE[[10, 32]] = True


def pieces_of_text(data: np.ndarray, offsets: np.ndarray, whole: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where texts can be cut without changing their tokens: at spaces and line ends, and behind a run of
    letters that an ASCII character other than a letter follows, but never inside one of the strings `whole`, in small letters, in
    any case. Returns start, end and first piece of each row."""
    space = _SPACE[data]
    ascii_other = (data < 128) & ~_LETTER[data] & ~space
    letter = _LETTER[data]
    lead = np.zeros(len(data), bool)          # U+00C0 to U+00FF in UTF-8, all letters but two
    lead[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter |= lead
    begin = np.zeros(len(data), bool)
    begin[1:] = (space[:-1] & ~space[1:]) | (letter[:-1] & ascii_other[1:])
    small = _LOWER[data].tobytes() if whole else b""
    for string in whole:
        at = small.find(string)
        while at >= 0:
            begin[at + 1:at + len(string)] = False
            at = small.find(string, at + 1)
    rows = offsets[:-1][offsets[:-1] < len(data)]
    begin[rows] = ~space[rows]
    start = np.flatnonzero(begin)
    stop = np.zeros(len(data) + 1, bool)      # a piece ends where the next one, a space or a row begins
    stop[1:-1] = ~space[:-1] & (begin[1:] | space[1:])
    if len(data):
        stop[-1] = ~space[-1]
    inner = rows[rows > 0]
    stop[inner] = ~space[inner - 1]
    return start, np.flatnonzero(stop), np.searchsorted(start, offsets)


class Encoder:
    """Token ids of whole texts by a tokenizer file, each distinct piece encoded once per cache.
    The cache is bounded: when full it starts anew. A special token's string in a text gives that token, unless `special_as_text`."""

    def __init__(self, path: str, cached: int = CACHED_WORDS, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = () if special_as_text else self.tokenizer.get_added_tokens_decoder().values()
        self.whole = tuple(_LOWER[np.frombuffer(token.content.encode(), np.uint8)].tobytes() for token in added)
        self.cached = cached
        self.clear()

    def clear(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.pool, self.used, self.filled = np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0, 0

    def _add(self, keys: np.ndarray, found: list[list[int]]):
        ids = np.fromiter((i for f in found for i in f), np.uint32)
        ends = self.filled + np.cumsum([len(f) for f in found])
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.used + len(keys) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.pool[self.filled:self.filled + len(ids)] = ids
        self.at[self.used + 1:self.used + 1 + len(keys)] = ends
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every, kind="stable")
        self.slots = np.concatenate([self.slots, np.arange(self.used, self.used + len(keys))])[order]
        self.keys, self.used, self.filled = every[order], self.used + len(keys), self.filled + len(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All token ids of a group of rows and the offset of every row among them."""
        start, end, first = pieces_of_text(data, offsets, self.whole)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        distinct, where, which = np.unique(numbers(data, start, end), return_index=True, return_inverse=True)
        if self.used + len(distinct) > self.cached:
            self.clear()
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            words = [data[start[w]:end[w]].tobytes().decode() for w in where[new]]
            ids = [e.ids for i in range(0, len(words), ENCODED) for e in self.tokenizer.encode_batch_fast(words[i:i + ENCODED], add_special_tokens=False)]
            self._add(distinct[new], ids)
            place = np.searchsorted(self.keys, distinct)
        slot = self.slots[place][which]
        count = self.at[slot + 1] - self.at[slot]
        until = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(self.at[slot] - until[:-1], count) + np.arange(until[-1])]
        return ids, until[first]


_encoders: dict[tuple[str, int, bool], Encoder] = {}


def encoder(path: str, cached: int = CACHED_WORDS, special_as_text: bool = False) -> Encoder:
    """One encoder per Python worker, so that its cache outlives a task."""
    key = path, cached, special_as_text
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


class Bins:
    """The open bins of one task. A piece is (document, start, ids, ids of the document); a closed
    sequence becomes rows of `out`."""

    def __init__(self, task: int, capacity: int, classes: int, slack: int):
        self.capacity, self.classes, self.slack = capacity, classes, slack
        self.next = task << 32
        self.open: dict[int, list[tuple]] = {}
        self.brim: deque[tuple] = deque()
        self.brim_used = 0
        self.out: list[tuple] = []

    def close(self, pieces: list[tuple]):
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids), total, self.next, offset, ids))
            offset += len(ids)
        self.next += 1

    def lay(self, pieces: deque, size: int):
        """Close a sequence of `size` ids from the front of `pieces`, cutting the last one."""
        inside = []
        while size:
            doc, start, ids, total = pieces.popleft()
            inside.append((doc, start, ids[:size], total))
            if len(ids) > size:
                pieces.appendleft((doc, start + size, ids[size:], total))
            size -= len(inside[-1][2])
        self.close(inside)

    def add(self, doc, ids: np.ndarray):
        """All ids of a document."""
        total, start = len(ids), 0
        while total - start >= self.capacity:
            self.close([(doc, start, ids[start:start + self.capacity], total)])
            start += self.capacity
        while start < total:
            left = total - start
            k = self.capacity // left
            slot = self.capacity // k
            if slot - left > slot // self.slack:
                k += 1
                left = self.capacity // k
            if k > self.classes:
                left = total - start
                self.brim.append((doc, start, ids[start:].copy(), total))
                self.brim_used += left
                if self.brim_used >= self.capacity:
                    self.lay(self.brim, self.capacity)
                    self.brim_used -= self.capacity
            else:
                inside = self.open.setdefault(k, [])
                inside.append((doc, start, ids[start:start + left].copy(), total))
                if len(inside) == k:
                    self.close(self.open.pop(k))
            start += left

    def finish(self):
        """Lay what is left end to end."""
        for k in sorted(self.open):
            self.brim.extend(self.open.pop(k))
        used = sum(len(p[2]) for p in self.brim)
        for _ in range(used // self.capacity):
            self.lay(self.brim, self.capacity)
        rest = used % self.capacity
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                self.lay(self.brim, 1 << bit)
        self.brim_used = 0


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY,
         classes: int = CLASSES, slack: int = SLACK, with_ids: bool = False, special_as_text: bool = False) -> DataFrame:
    """The pieces of all documents and the sequences they lie in.

    A document is its token ids by the tokenizer file at the path `tokenizer` (the same on every
    machine), with no special tokens added, and the id 2; the string of a special token in a text gives that token unless `special_as_text`; null is the empty text, which is that id alone. Each id lies
    in exactly one piece. Returns doc_id, `start` (ids of the document before the piece), `length`, `ids_crc32`
    (of the ids as little-endian 32-bit numbers), `doc_tokens`, `sequence_id`, `offset` (gapless in the sequence)
    and, if asked for, `ids`. Sequences hold `capacity` ids at most; one that is no power of two long is
    padded to it. Rows are packed one by one, so repeated rows and null ids stay as they are; other columns are not
    read. `capacity` must be a power of two for the last sequences of a task to need no padding."""
    if capacity < 1 or classes < 1 or slack < 1:
        raise ValueError("capacity, classes and slack are at least 1")
    ship(docs.sparkSession)
    fields = [docs.select(F.col(doc_id).alias("doc_id")).schema["doc_id"]]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    types = [pa.int64()] * 6
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
        types.append(pa.list_(pa.int64()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, kind = Bins(TaskContext.get().partitionId(), capacity, classes, slack), None

        def rows():
            columns = list(zip(*bins.out)) or [()] * 8
            bins.out = []
            arrays = [pa.array(columns[0], kind)] + [pa.array(c, t) for c, t in zip(columns[1:], types)]
            return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

        tokens = encoder(tokenizer, special_as_text=special_as_text)
        for batch in batches:
            kind = batch.column(0).type
            column = batch.column(1)
            for at, to in groups(column):
                ids, until = tokens.encode(*texts(column.slice(at, to - at)))
                for row, doc in enumerate(batch.column(0).slice(at, to - at).to_pylist()):
                    bins.add(doc, np.append(ids[until[row]:until[row + 1]], np.uint32(END)))
                yield rows()
        if kind is not None:
            bins.finish()
            yield rows()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text)).mapInArrow(frugal(task), T.StructType(fields))


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """The token ids of every sequence, from pieces that carry their ids: `sequence_id`, `tokens` (padded to
    `capacity` unless their number is a power of two) and `used`. A group is one sequence, so it is bounded."""
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.col("parts.ids"))
    whole_power = F.expr("bit_count(used) = 1")
    return whole.select("sequence_id", F.when(whole_power, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad).cast("long"), (F.lit(capacity) - F.col("used")).cast("int")))).alias("tokens"), "used")
