"""Benchmark decontamination: suffix arrays of the training texts, searched for every benchmark suffix.

Each Arrow task holds a shard of whole documents. It sorts the suffixes of its words that begin with
two words some benchmark item has in a row (no other can begin a window) and binary-searches every
benchmark suffix that begins with two words of the shard among them, all together and word by word. The equal range gives all places
where the first words of the suffix occur. Places and suffixes are never paired: each place takes the deepest window that covers it, each range the
documents and the items it stands for. The longest verbatim matches come from the order of all suffixes of the documents and items that
were hit, where the longest match of a suffix is that with its nearest benchmark neighbour. Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.components import written
from tickloom.llm.words import NOT_ALNUM, Words, columns_for, frugal, mix, ship, word_groups, words

WINDOW = 10
MAX_BENCHMARK_BYTES = 64 << 20


class Suffixes:
    """All suffixes of the benchmark items and what the search needs of them.

    `number` holds the words of all items in a row; a suffix is a position in it. `depth[i]` is how
    many words from there make a window: 10, or the whole item when it is shorter, and 0 where no
    window starts."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.ids = [None if i is None else str(i) for i, _ in items]
        text = [(t or "").encode() for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in text])]).astype(np.int64)
        found = words(np.frombuffer(b"".join(text), np.uint8), offsets, NOT_ALNUM)
        self.number = found.number
        counts = np.diff(found.first)
        self.item = np.repeat(np.arange(len(items)), counts)
        self.end = np.repeat(found.first[1:], counts)
        left = self.end - np.arange(len(self.number))
        whole = np.repeat(counts, counts)
        self.depth = np.where(left >= window, window, np.where((whole < window) & (left == whole), whole, 0))
        starts = np.flatnonzero(self.depth)
        self.first = found.first
        self.pair = np.zeros(len(self.number), np.uint64)
        if len(self.number) > 1:
            self.pair[:-1] = _pair(self.number[:-1], self.number[1:])
        self.single = np.unique(self.number[starts[self.depth[starts] == 1]])
        two = starts[self.depth[starts] > 1]
        self.pairs = np.unique(self.pair[two])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0xA24BAED4963EE407) + b)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def suffix_array(number: np.ndarray, end: np.ndarray, places: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """`places` in the order of the words that follow them, up to `depth` words and not beyond the
    document; and those words, one row per place. A word that is missing sorts first."""
    at = places[:, None] + np.arange(depth)
    ahead = np.where(at < end[places][:, None], number[np.minimum(at, len(number) - 1)], np.uint64(0))
    order = np.lexsort(ahead.T[::-1])
    return places[order], ahead[order]


def bisect(column: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> np.ndarray:
    """For many ranges of a column that is sorted inside each, where a word of each range belongs."""
    low, high = low.copy(), high.copy()
    while True:
        active = np.flatnonzero(low < high)
        if not len(active):
            return low
        middle = (low[active] + high[active]) // 2
        below = column[middle] <= word[active] if right else column[middle] < word[active]
        low[active[below]], high[active[~below]] = middle[below] + 1, middle[~below]


def ranges(ahead: np.ndarray, bench: Suffixes, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix the rows that begin with the words of its window."""
    low, high = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), len(ahead), np.int64)
    for k in range(ahead.shape[1]):
        on = np.flatnonzero((bench.depth[suffixes] > k) & (low < high))
        if not len(on):
            break
        column, word = np.ascontiguousarray(ahead[:, k]), bench.number[suffixes[on] + k]
        low[on], high[on] = bisect(column, word, low[on], high[on], False), bisect(column, word, low[on], high[on], True)
    return low, high


class Matches(NamedTuple):
    """What a shard shares with the benchmark."""
    place: np.ndarray               # words where windows begin, rising
    deepest: np.ndarray             # words of the longest window there
    items: dict[int, set[int]]      # per document
    longest: dict[int, tuple[int, int, int, int]]       # per document: words, word of the shard, benchmark suffix, item


def shard_matches(number: np.ndarray, first: np.ndarray, bench: Suffixes, window: int) -> Matches:
    """All windows that occur in a shard. `first[i]:first[i + 1]` are the words of document i."""
    counts = np.diff(first)
    end, doc = np.repeat(first[1:], counts), np.repeat(np.arange(len(counts)), counts)
    inner = np.zeros(len(number), bool)
    pairs = np.zeros(0, np.uint64)
    if len(number) > 1:
        own = _pair(number[:-1], number[1:])
        inner[:-1] = (np.arange(1, len(number)) < end[:-1]) & _among(own, bench.pairs)
        pairs = np.unique(own[inner[:-1]])
    alone = _among(number, bench.single)
    places = np.flatnonzero(inner | alone)
    none = np.zeros(0, np.int64)
    if not len(places):
        return Matches(none, none, {}, {})
    places, ahead = suffix_array(number, end, places, window)
    starts = np.flatnonzero(bench.depth)
    met = _among(bench.pair[starts], pairs) & (bench.depth[starts] > 1) | _among(bench.number[starts], np.unique(number[alone])) & (bench.depth[starts] == 1)
    suffixes = starts[met]
    low, high = ranges(ahead, bench, suffixes)
    suffixes, low, high = suffixes[low < high], low[low < high], high[low < high]
    depth, item = bench.depth[suffixes], bench.item[suffixes]
    deepest, items = np.zeros(len(places), np.int64), {}
    for size in np.unique(depth):
        of = depth == size
        edges = np.bincount(low[of], minlength=len(places) + 1) - np.bincount(high[of], minlength=len(places) + 1)
        deepest[np.cumsum(edges[:-1]) > 0] = size
        # Ranges of one depth are equal or apart: each distinct one gives its documents once and its items once.
        spans = np.unique(np.stack([low[of], high[of], item[of]], axis=1), axis=0)
        cut = np.flatnonzero(np.concatenate([[True], spans[1:, 0] != spans[:-1, 0]]))
        for at, to in zip(cut, [*cut[1:], len(spans)]):
            found = set(spans[at:to, 2].tolist())
            for d in np.unique(doc[places[spans[at, 0]:spans[at, 1]]]).tolist():
                items.setdefault(d, set()).update(found)
    hit = deepest > 0
    order = np.argsort(places[hit])
    place, deepest = places[hit][order], deepest[hit][order]
    return Matches(place, deepest, items, longest_matches(number, first, doc, place, deepest, items, bench, window))


def longest_matches(number: np.ndarray, first: np.ndarray, doc: np.ndarray, place: np.ndarray, deepest: np.ndarray, items: dict[int, set[int]],
                    bench: Suffixes, window: int) -> dict[int, tuple[int, int, int, int]]:
    """The longest match of every document that was hit; the first in the document among equals, then the first in its item."""
    docs, hit_items = sorted(items), sorted(set().union(*items.values())) if items else []
    if not docs:
        return {}
    parts = [np.arange(first[d], first[d + 1]) for d in docs] + [np.arange(bench.first[i], bench.first[i + 1]) for i in hit_items]
    source = np.concatenate(parts)
    sizes = np.array([len(p) for p in parts])
    split = sum(len(p) for p in parts[:len(docs)])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(source))          # words to the end of the text
    word = np.concatenate([number[source[:split]], bench.number[source[split:]]])
    levels = [np.unique(word, return_inverse=True)[1].astype(np.int64)]
    while (1 << len(levels)) <= left.max():
        step = 1 << (len(levels) - 1)
        after = np.where(left > step, levels[-1][np.minimum(np.arange(len(word)) + step, len(word) - 1)] + 1, 0)
        levels.append(np.unique(levels[-1] * (len(word) + 2) + after, return_inverse=True)[1].astype(np.int64))
    order = np.lexsort((np.arange(len(word)), levels[-1]))
    bench_at = np.where(order >= split, np.arange(len(order)), -1)
    before, after = np.maximum.accumulate(bench_at), np.full(len(order), len(order))
    after[:] = np.minimum.accumulate(np.where(order >= split, np.arange(len(order)), len(order))[::-1])[::-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))

    def common(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at i and j begin with alike."""
        most, got = np.minimum(left[i], left[j]), np.zeros(len(i), np.int64)
        for k in reversed(range(len(levels))):
            a, b = np.minimum(i + got, len(word) - 1), np.minimum(j + got, len(word) - 1)
            got += np.where((got + (1 << k) <= most) & (levels[k][a] == levels[k][b]), 1 << k, 0)
        return got

    # Places of the documents where a window begins, as positions in `source`.
    moved = np.concatenate([[0], np.cumsum(sizes[:len(docs)])])
    of = np.searchsorted(docs, doc[place])
    at = place - first[np.array(docs)[of]] + moved[of]
    lo, hi = before[rank[at]], after[rank[at]]
    longest = np.zeros(len(at), np.int64)
    for neighbour, there in ((lo, lo >= 0), (hi, hi < len(order))):
        longest[there] = np.maximum(longest[there], common(at[there], order[neighbour[there]]))
    longest = np.where(longest >= window, longest, deepest)      # a shorter match counts only as a whole item
    best = np.lexsort((place, -longest, of))
    best = best[np.concatenate([[True], of[best][1:] != of[best][:-1]])]
    out = {}
    for b in best:
        size, i = int(longest[b]), int(at[b])
        k = size.bit_length() - 1
        low, high = (int(np.searchsorted(levels[k][order], levels[k][i], side)) for side in ("left", "right")) if k < len(levels) else (0, 0)
        here = order[low:high]
        here = here[(here >= split) & (left[here] >= size)]
        tail = size - (1 << k)
        here = here[levels[k][here + tail] == levels[k][i + tail]]
        suffix = source[here]
        if size < window:
            suffix = suffix[bench.depth[suffix] == size]
        item = bench.item[suffix]
        first_one = np.lexsort((item, suffix - bench.first[item]))[0]
        out[docs[int(of[b])]] = size, int(place[b]), int(suffix[first_one]), int(item[first_one])
    return out


def bench_parts(benchmark: DataFrame, item: str, text: str, limit: int) -> int:
    """How many parts a benchmark is searched in, so that one, which goes to the driver and to all tasks, is about `limit` bytes at most,
    or one longer item."""
    size = benchmark.select(F.coalesce(F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 32), F.lit(0)).alias("n")).first()["n"]
    return 1 if size <= limit else -(-2 * size // limit)


def bench_rows(benchmark: DataFrame, item: str, text: str, part: int, parts: int) -> list[tuple[object, str | None]]:
    """A part of the benchmark on the driver."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect()]


def merged_spans(spans: np.ndarray) -> np.ndarray:
    """Rows of start and end, overlapping and touching ones joined."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    begins = np.concatenate([[True], spans[1:, 0] > reach[:-1]]) if len(spans) else np.zeros(0, bool)
    return np.stack([spans[begins, 0], np.maximum.reduceat(spans[:, 1], np.flatnonzero(begins))], axis=1) if len(spans) else spans


class Shared(NamedTuple):
    """What one document shares with the parts of the benchmark searched so far."""
    spans: np.ndarray                       # of words that were hit
    items: set[str]
    longest: tuple[int, int, int, str | None] | None        # words, word of the document, word of the item, item

    def with_(self, other: "Shared") -> "Shared":
        both = [m for m in (self.longest, other.longest) if m]
        return Shared(merged_spans(np.concatenate([self.spans, other.spans])), self.items | other.items, min(both, key=lambda m: (-m[0], m[1], m[2])) if both else None)


def shared_with(found: Words, bench: Suffixes, window: int) -> list[Shared]:
    """`Shared` of the documents of a group."""
    matches = shard_matches(found.number, found.first, bench, window)
    docs = np.searchsorted(found.first, matches.place, "right") - 1
    out = []
    for d, first in enumerate(found.first[:-1]):
        here = slice(*np.searchsorted(docs, [d, d + 1]))
        start = matches.place[here] - first
        longest = matches.longest.get(d)
        out.append(Shared(merged_spans(np.stack([start, start + matches.deepest[here]], axis=1)), {bench.ids[i] for i in matches.items.get(d, ()) if bench.ids[i] is not None},
                          longest and (longest[0], longest[1] - int(first), longest[2] - int(bench.first[longest[3]]), bench.ids[longest[3]])))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with what they share with the benchmark.

    Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z are lower-cased. A window is
    `window` words in a row of an item, or all words of a shorter item. Adds `n_words`, `n_hit` (words
    inside an occurrence of a window), `n_items`, `items_sha256` (of the sorted item ids joined by
    commas), `contaminated`, and `longest`: (item_id, word in the document, word in the item, words)
    of the longest verbatim match, the first in the document among equals.

    Null and empty texts have no words; null and empty items have no window; an item without an id
    still hits words but is not listed; rows of `docs` are judged one by one, so repeated rows repeat.
    Columns of `docs` named like an added one are replaced. `keep` names the columns that are
    carried along, all by default.

    A benchmark over `max_benchmark_bytes` is searched in parts, a pass over the documents each: what a pass found goes along with them and is
    merged, so the result is that of the whole."""
    ship(docs.sparkSession)
    parts = bench_parts(benchmark, item, item_text, max_benchmark_bytes)
    longest_type = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.LongType()),
                                 T.StructField("item_word", T.LongType()), T.StructField("words", T.LongType())])
    added = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()), T.StructField("longest", longest_type)])
    between = T.StructType([T.StructField("_spans", T.BinaryType()), T.StructField("_items", T.ArrayType(T.StringType())), T.StructField("_longest", longest_type)])
    arrow_longest = pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())])
    names = added.fieldNames()
    carried = [c for c in (docs.columns if keep is None else keep) if c not in names]
    columns, place_of_text, places_of_carried = columns_for(text, carried)
    rows = docs.select(*columns)
    for number in range(parts):
        shared = docs.sparkSession.sparkContext.broadcast(bench_rows(benchmark, item, item_text, number, parts))
        earlier, last = number > 0, number == parts - 1

        def task(batches: Iterator[pa.RecordBatch], shared=shared, earlier=earlier, last=last) -> Iterator[pa.RecordBatch]:
            bench = Suffixes(shared.value, window)
            for batch in batches:
                for at, to, found in word_groups(batch.column(place_of_text), NOT_ALNUM):
                    part, docs_ = batch.slice(at, to - at), shared_with(found, bench, window)
                    if earlier:
                        held = (part.column(len(columns) + k).to_pylist() for k in range(3))
                        docs_ = [d.with_(Shared(np.frombuffer(s, np.int64).reshape(-1, 2), set(i), m and (m["words"], m["doc_word"], m["item_word"], m["item_id"])))
                                 for d, s, i, m in zip(docs_, *held)]
                    longest = pa.array([d.longest and dict(zip(("words", "doc_word", "item_word", "item_id"), d.longest)) for d in docs_], arrow_longest)
                    listed = [sorted(d.items) for d in docs_]
                    if not last:
                        yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(columns))), pa.array([d.spans.astype(np.int64).tobytes() for d in docs_], pa.binary()),
                                                          pa.array(listed, pa.list_(pa.string())), longest], [*columns, *between.fieldNames()])
                        continue
                    n_hit = np.array([int((d.spans[:, 1] - d.spans[:, 0]).sum()) for d in docs_], np.int64)
                    arrays = [pa.array(np.diff(found.first), pa.int64()), pa.array(n_hit), pa.array([len(x) for x in listed], pa.int64()),
                              pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed], pa.string()), pa.array(n_hit > 0), longest]
                    yield pa.RecordBatch.from_arrays([part.column(k) for k in places_of_carried] + arrays, names=carried + names)

        out = T.StructType([docs.schema[c] for c in carried] + added.fields) if last else T.StructType([docs.schema[c] for c in columns] + between.fields)
        rows = rows.mapInArrow(frugal(task), out)
        if not last:
            rows = written(rows, "searched")
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without the documents that hold a benchmark window; options as in `contamination`."""
    return contamination(docs, benchmark, **options).where(~F.col("contaminated")).select(*docs.columns)
