"""Shards of nearly equal bytes by histogram sort.

Documents are ordered by a hash of the text, so equal texts lie together. The borders between shards are found
by counting: a pass over a narrow table of keys and sizes gives the exact bytes below each candidate border
inside the ranges where a border must lie, and the next pass probes inside the range that the target
falls in, until a border is near enough. A border falls inside a group of equal texts only where the group is too large for
either end of it to be near; then the ids decide. With the borders known, rows are exchanged once.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.components import written

SHARDS = 16
TOLERANCE = 0.005        # of a shard's bytes, by which a border may miss its target
KEY_BITS = 63            # of the hash of the text, and of the one of id and text
PROBE_BITS = 8           # candidate borders of a range, as a power of two
STRETCH_ROWS = 50_000    # rows numbered together within a shard

ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


class Border(NamedTuple):
    """Rows from (key, tie) on lie behind it."""
    key: int
    tie: int


class Range(NamedTuple):
    """Where a border lies: the keys with this prefix, or the ties with it under one key."""
    bits: int            # of the prefix
    prefix: int
    key: int | None      # None while the key itself is split
    below: int           # bytes before the range

    def cell(self) -> Column:
        value = F.col("key") if self.key is None else F.col("tie")
        inside = F.shiftright(value, KEY_BITS - self.bits) == self.prefix if self.bits else F.lit(True)
        return inside if self.key is None else (F.col("key") == self.key) & inside

    def step(self) -> int:
        return min(PROBE_BITS, KEY_BITS - self.bits)

    def probe(self) -> Column:
        value = F.col("key") if self.key is None else F.col("tie")
        return F.shiftright(value, KEY_BITS - self.bits - self.step()).bitwiseAND(F.lit((1 << self.step()) - 1).cast("long"))

    def border(self, probe: int) -> Border:
        """The border before a probe."""
        start = ((self.prefix << self.step()) + probe) << (KEY_BITS - self.bits - self.step())
        return Border(start, 0) if self.key is None else Border(self.key, start)

    def inner(self, probe: int, below: int, low: int, high: int) -> Range:
        """The range of one probe; a single key is split by its ties at once."""
        if self.key is None and low == high:
            return Range(0, 0, low, below)
        return Range(self.bits + self.step(), (self.prefix << self.step()) + probe, self.key, below)


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """`docs` with `size` (UTF-8 bytes and one), `key` and `tie`."""
    def positive(*columns):
        return F.shiftrightunsigned(F.xxhash64(*columns), 1)
    return docs.select("*", (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1).alias("size"),
                       positive(F.col(text)).alias("key"), positive(F.col(doc_id), F.col(text)).alias("tie"))


def borders(narrow: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Border]:
    """The `shards` - 1 borders that cut a table of key, tie and size into nearly equal bytes. Each pass
    returns at most 256 counts for every border to the driver, whatever the size of the table."""
    total = narrow.agg(F.sum("size")).first()[0] or 0
    targets = [total * i // shards for i in range(1, shards)]
    near = tolerance * total / shards
    found: dict[int, Border] = {}
    ranges = {i: Range(0, 0, None, 0) for i in range(len(targets))} if total else {}
    while ranges:
        cells = list(dict.fromkeys(ranges.values()))
        cell, probe = F.lit(None).cast("int"), F.lit(None).cast("long")
        for k, r in reversed(list(enumerate(cells))):
            cell, probe = F.when(r.cell(), k).otherwise(cell), F.when(r.cell(), r.probe()).otherwise(probe)
        value = F.when(F.col("cell").isin([k for k, r in enumerate(cells) if r.key is None]), F.col("key")).otherwise(F.col("tie"))
        counts: dict[int, list] = {k: [] for k in range(len(cells))}
        rows = (narrow.select("key", "tie", "size", cell.alias("cell"), probe.alias("probe")).where("cell is not null")
                .groupBy("cell", "probe").agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.min(value).alias("low"), F.max(value).alias("high")).collect())
        for r in sorted(rows, key=lambda r: (r["cell"], r["probe"])):
            counts[r["cell"]].append(r)
        left = {}
        for i, range_ in ranges.items():
            below, best = range_.below, None
            for r in counts[cells.index(range_)]:
                choices = ((abs(below - targets[i]), range_.border(r["probe"])),
                           (abs(below + r["size"] - targets[i]), range_.border(r["probe"] + 1)))
                best = min([b for b in (best, *choices) if b is not None], key=lambda b: b[0])
                if below <= targets[i] < below + r["size"]:
                    inner = range_.inner(r["probe"], below, r["low"], r["high"])
                    alone = r["rows"] == 1 or inner.bits >= KEY_BITS or (range_.key is not None and r["low"] == r["high"])
                below += r["size"]
            if best[0] <= near or alone:
                found[i] = best[1]
            else:
                left[i] = inner
        ranges = left
    return [found[i] for i in sorted(found)]


def shard_of(cuts: list[Border]) -> Column:
    """The number of borders at or before a row."""
    out = F.lit(0)
    for b in cuts:
        out = out + ((F.col("key") > b.key) | ((F.col("key") == b.key) & (F.col("tie") >= b.tie))).cast("int")
    return out


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id", tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of `docs` with the shard they belong to: `size`, `text_crc32` (unsigned, of the UTF-8 bytes), `law` ('bytes'),
    `shard` (from 0), `slot` (gapless from 0 in the shard, in hashed order) and `grown_shard` (null under this law).

    A null text has no bytes and lies with other nulls; null and repeated ids and repeated rows are rows like others, and
    rows that are equal in id and text share a border's side. An empty table stays empty. Columns of `docs` named like
    an added one are replaced, and so are `key`, `tie`, `stretch`, `before`. Select what is needed of the result before
    writing it: what is not read is not exchanged."""
    if shards < 1 or tolerance <= 0:
        raise ValueError("shards and tolerance are positive")
    own = [c for c in docs.columns if c not in (*ADDED, "key", "tie", "stretch", "before") or c in (text, doc_id)]
    rows = keyed(docs.select(*own), text, doc_id)
    narrow = written(rows.select("key", "tie", "size"), "keys")
    cuts = borders(narrow, shards, tolerance)
    count = narrow.count()
    bits = max(6, math.ceil(math.log2(max(1, count / (shards * STRETCH_ROWS)))))
    stretch = F.shiftright("tie", KEY_BITS - bits)
    placed = rows.select(*own, "size", F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
                         shard_of(cuts).alias("shard"), stretch.alias("stretch"), "tie")
    held = narrow.groupBy(shard_of(cuts).alias("shard"), stretch.alias("stretch")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1))
    held = held.select("shard", "stretch", F.coalesce(before, F.lit(0)).alias("before"))
    order = F.row_number().over(W.partitionBy("shard", "stretch").orderBy("tie"))
    numbered = placed.withColumn("slot", order.cast("long") - 1).join(held, ["shard", "stretch"])
    return numbered.select(*own, "size", "text_crc32", "law", "shard", (F.col("slot") + F.col("before")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
