"""License scans: the parts of a text compared with licence templates by the Dice coefficient of word bigrams.

Parts are the whole text, its paragraphs (between empty lines) and its lines, as a licence is a text of its own, a header, or a line,
and all runs of words that are not longer than the sizes allow, as it also stands in several paragraphs or inside a sentence. A
run starts with a bigram of the template that enough others follow, and starts with the most of them come first.
Normalising keeps lower-cased words only. The coefficient of two sets cannot reach the threshold unless their
sizes are in a range, which prunes templates by size, and unless the part has so many bigrams of any template, which prunes parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.llm.license_texts import TEMPLATES
from tickloom.llm.words import NOT_ALNUM, columns_for, frugal, mix, ship, word_groups, words

PERCENT = 80             # least Dice coefficient, times 100
CELLS = 1 << 18          # bigrams of runs compared at a time


def _bigrams(number: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(number[:-1] * np.uint64(0xA24BAED4963EE407) + number[1:])


class Templates:
    """Bigram sets of the templates, by size."""

    def __init__(self, templates: list[tuple[str, str]], percent: int):
        texts = [t.encode() for _, t in templates]
        found = words(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), NOT_ALNUM)
        sets = [np.unique(_bigrams(found.number[found.first[k]:found.first[k + 1]])) for k in range(len(texts))]
        order = sorted((len(s), name, k) for k, ((name, _), s) in enumerate(zip(templates, sets)) if len(s))
        self.all = [(size, name, sets[k]) for size, name, k in order]
        self.known = np.unique(np.concatenate([s for _, _, s in self.all])) if self.all else np.zeros(0, np.uint64)
        self.member = np.array([np.isin(self.known, s) for _, _, s in self.all]).reshape(len(self.all), len(self.known))
        #: Bigrams a run may have, repeated ones too.
        self.longest = [int(found.first[k + 1] - found.first[k] - 1) * (200 - percent) // percent for _, _, k in order]
        self.percent = percent
        least = self.all[0][0] if self.all else 1
        self.least = max(1, math.ceil(least * percent / (200 - percent)))          # bigrams a part must have at least
        self.overlap = max(1, math.ceil(percent * (self.least + least) / 200))       # and in common with a template

    def match(self, part: np.ndarray, among: list[int]) -> Iterator[tuple[float, str]]:
        """(coefficient, licence) of the templates that a set of bigrams is like, `among` those by size."""
        n = len(part)
        for size, name, template in (self.all[t] for t in among):
            if size * (200 - self.percent) < self.percent * n:
                continue
            if size * self.percent > (200 - self.percent) * n:
                break
            common = n + size - len(np.union1d(part, template))
            if 200 * common >= self.percent * (n + size):
                yield 2 * common / (n + size), name


    def need(self, t: int) -> int:
        """Bigrams of a template that whatever is like it has at least."""
        return math.ceil(self.all[t][0] * self.percent / (200 - self.percent))

    def candidates(self, slot: np.ndarray, row: np.ndarray) -> dict[int, list[int]]:
        """The templates by size of which each row has enough bigrams."""
        out: dict[int, list[int]] = {}
        for t in range(len(self.all)):
            if len(slot) >= self.need(t):
                for r in np.flatnonzero(np.bincount(row[self.member[t, slot]]) >= self.need(t)):
                    out.setdefault(int(r), []).append(t)
        return out

    def starts(self, at: np.ndarray, slot: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(template, places where a run like it can start, how many of its bigrams follow there), given the place, the number
        among the known ones and the row of every known bigram of some texts."""
        for t, (size, _, _) in enumerate(self.all):
            own = self.member[t, slot]
            place, of = at[own], row[own]
            need = self.need(t)
            if len(place) < need:
                continue
            last = len(place) - need + 1
            fit = np.flatnonzero((place[need - 1:] - place[:last] < self.longest[t]) & (of[need - 1:] == of[:last]))
            if len(fit):
                end = np.minimum(np.searchsorted(place, place[fit] + self.longest[t]), np.searchsorted(of, of[fit], "right"))
                yield t, place[fit], np.minimum(end - fit, size)

    def best_run(self, t: int, before: np.ndarray, member: np.ndarray, starts: np.ndarray, most: np.ndarray, best: float) -> float:
        """The highest coefficient of template t and a run of a text, or `best` if none is above. `before` is the place of
        the same bigram before each, `member` whether the template has it."""
        size = self.all[t][0]
        width = min(self.longest[t], len(before))
        order = np.argsort(-most, kind="stable")
        starts, bound = starts[order], 2 * most[order] / (most[order] + size)
        at, step = 0, max(1, CELLS // width)
        while at < len(starts) and bound[at] > best:
            start = starts[at:at + step, None]
            here = start + np.arange(width)
            inside = here < len(before)
            here = np.minimum(here, len(before) - 1)
            new = inside & (before[here] < start)
            n, common = np.cumsum(new, axis=1), np.cumsum(new & member[here], axis=1)
            best = max(best, float(np.where(200 * common >= self.percent * (n + size), 2 * common / (n + size), 0).max()))
            at += step
        return best


def earlier(pairs: np.ndarray) -> np.ndarray:
    """The place of the same number before each, -1 if there is none."""
    order = np.argsort(pairs, kind="stable")
    out = np.full(len(pairs), -1, np.int64)
    same = pairs[order[1:]] == pairs[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def parts_of(data: np.ndarray, offset: int, end: int) -> list[tuple[int, int]]:
    """Byte ranges of the whole text, its paragraphs and its lines, each once."""
    out = {(offset, end)}
    breaks = offset + np.flatnonzero(data[offset:end] == 10)
    edges = np.concatenate([[offset - 1], breaks, [end]])
    out.update(zip((edges[:-1] + 1).tolist(), edges[1:].tolist()))
    empty = np.flatnonzero(np.diff(edges) == 1)          # lines without text
    if len(empty) and len(edges) > 2:
        cuts = [offset - 1, *(int(edges[e + 1]) for e in empty), end]
        out.update((a + 1, b) for a, b in zip(cuts, cuts[1:]))
    return sorted(out)


def scan_licenses(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] | None = None, percent: int = PERCENT, keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with `license`, the licence of the likest template, `dice`, its coefficient (0 to 1), both null if none
    reaches `percent` / 100, and `licenses`, all that some part or run of words is like, sorted and joined by commas (empty if none).
    A run has at most 200 / `percent` - 1 times as many bigrams as the template has, repeated ones counted; parts may be longer.

    Of equal coefficients the first licence by name counts. Null and empty texts and texts of one word have no bigrams and so
    no licence; repeated rows repeat. Columns named like an added one are replaced; `keep` names the columns
    that are carried along, all by default. Templates are a short list of the caller's and go to every task."""
    if not 0 < percent <= 100:
        raise ValueError("percent lies between 1 and 100")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(list(TEMPLATES if templates is None else templates))
    added = [T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("licenses", T.StringType())]
    names = [f.name for f in added]
    carried = [c for c in (docs.columns if keep is None else keep) if c not in names]
    read, place, places = columns_for(text, carried)
    schema = T.StructType([docs.schema[c] for c in carried] + added)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(shared.value, percent)
        for batch in batches:
            for at, to, found in word_groups(batch.column(place), NOT_ALNUM):
                pairs = _bigrams(found.number) if len(found.number) > 1 else np.zeros(0, np.uint64)
                likely = np.zeros(len(pairs) + 1, np.int64)
                among: dict[int, list[int]] = {}
                runs: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
                if len(known.known) and len(pairs):
                    near = np.minimum(np.searchsorted(known.known, pairs), len(known.known) - 1)
                    seen = known.known[near] == pairs
                    likely[1:] = np.cumsum(seen)
                    seen[found.first[1:][(found.first[1:] > 0) & (found.first[1:] <= len(pairs))] - 1] = False          # from one row to the next
                    at_known = np.flatnonzero(seen)
                    row_of = np.searchsorted(found.first, at_known, "right") - 1
                    among = known.candidates(near[at_known], row_of)
                    for t, starts, most in known.starts(at_known, near[at_known], row_of):
                        of = np.searchsorted(found.first, starts, "right") - 1
                        cuts = np.flatnonzero(np.diff(of)) + 1
                        for begin, stop in zip([0, *cuts], [*cuts, len(of)]):
                            runs.setdefault(int(of[begin]), []).append((t, starts[begin:stop], most[begin:stop]))
                out = []
                for row in range(to - at):
                    a, b = int(found.first[row]), int(found.first[row + 1])
                    hits: set[tuple[float, str]] = set()
                    if row in among:
                        for start, end in parts_of(found.data, int(found.start[a]), int(found.end[b - 1])):
                            first, last = np.searchsorted(found.start, [start, end])
                            if last - first > known.least and likely[last - 1] - likely[first] >= known.overlap:
                                hits.update(known.match(np.unique(pairs[first:last - 1]), among[row]))
                    if row in runs:
                        own, before = pairs[a:b - 1], earlier(pairs[a:b - 1])
                        for t, starts, most in runs[row]:
                            name, member = known.all[t][1], (known.known[near[a:b - 1]] == own) & known.member[t, near[a:b - 1]]
                            reached = known.best_run(t, before, member, starts - a, most, max((d for d, of in hits if of == name), default=0.0))
                            if reached > 0:
                                hits.add((reached, name))
                    best = min(hits, key=lambda h: (-h[0], h[1]), default=(None, None))
                    out.append((best[1], best[0], ",".join(sorted({name for _, name in hits}))))
                part = batch.slice(at, to - at)
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.string())],
                                                 names=schema.fieldNames())

    return docs.select(*read).mapInArrow(frugal(task), schema)
