"""Toxicity by weak supervision.

Many voters look at a text: lexicons of insults, lexicons of words and word beginnings mined from a bounded sample of labelled
texts, and patterns such as threats or disguised spellings. No voter is trusted as it is. A generative model (`label_model`) learns
from how often each pattern of votes occurs among all documents how accurate voters are and which go together, and gives
every text a probability. A linear classifier over votes, hits and hashed words is trained on these probabilities and scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.label_model import LabelModel, fit_labels
from tickloom.llm.words import NOT_ALNUM, Words, columns_for, frugal, mix, numbers, ship, texts, word_groups

SAMPLE = 2000           # labelled texts of each class that lexicons are mined from
TRAINED = 4000          # documents, besides these, that the classifier is trained on
THRESHOLD = 0.7
TERMS = 1 << 13         # buckets of hashed words
DENSE = 125             # one hit in so many words is dense
BEGINNINGS = (4, 6, 8)  # bytes of the word beginnings mined
SUPPORT, RATIO, SURPRISE = 3, 5.0, 14.0     # of a mined word: toxic texts with it, ratio of the rates, log likelihood ratio
STEPS = 150
MINED = np.uint64(3)    # low bits that mined numbers leave to the kind of term

#: Plain word lists, in small letters.
ENGLISH = ("idiot idiots moron morons stupid dumb dumbass loser losers trash scum scumbag pathetic worthless disgusting clown clowns fool fools jerk jerks "
           "creep creeps imbecile retard retarded bastard bastards bitch bitches asshole assholes shit bullshit fuck fucking fucked damn crap ugly filthy vile vermin "
           "pig pigs freak freaks liar liars coward cowards garbage hate hateful").split()
OTHERS = ("idiot idioten dumm dummkopf trottel vollidiot arschloch arsch scheiße scheisse abschaum versager widerlich ekelhaft erbärmlich wertlos dreckig hurensohn schlampe "
          "imbécile crétin crétins débile connard connasse salaud salope ordure minable pathétique dégoûtant abruti merde putain raclure nul "
          "idiota idiotas imbécil estúpido estúpida basura patético patética inútil asqueroso asquerosa payaso escoria perdedor mierda puta cabrón gilipollas").split()
THREATS = [("kill", "you"), ("kill", "yourself"), ("hurt", "you"), ("shut", "up"), ("hate", "you"), ("go", "die"), ("drop", "dead"), ("get", "lost"), ("screw", "you"),
           ("fuck", "you"), ("fuck", "off"), ("burn", "in"), ("you", "people"), ("bring", "dich"), ("halt", "maul"), ("ferme", "la"), ("ta", "gueule"), ("cállate", "ya")]
ADDRESSED = "you your du dich dir tu te toi vous tú usted".split()
_PLAIN = {ord(a): ord(b) for a, b in zip("013457@$!", "oieastasi")}
_UNDISGUISED = bytes(_PLAIN.get(k, k) for k in range(256))
_SIGN = np.isin(np.arange(256), list(_PLAIN))
_LETTER = np.isin(np.arange(256), [*range(97, 123), *range(128, 256)])


def word_number(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(numbers(data, np.array([0]), np.array([len(data)]))[0])


def _sorted_numbers(words) -> np.ndarray:
    return np.unique(np.array([word_number(w) for w in words], np.uint64))


def paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return first * np.uint64(0xA24BAED4963EE407) + second


_FIXED = [_sorted_numbers(ENGLISH), _sorted_numbers(OTHERS)]
_THREATS = np.unique(np.concatenate([paired(_one, _two) for _one, _two in (np.array([[word_number(w)] for w in p], np.uint64) for p in THREATS)]))
_ADDRESSED = _sorted_numbers(ADDRESSED)
_SPELLED = {w.encode() for w in (*ENGLISH, *OTHERS)}


class Lexicons(NamedTuple):
    """Sorted numbers of words and, by their length, of word beginnings."""
    words: list[np.ndarray]
    beginnings: list[np.ndarray]


LISTS = len(_FIXED) + 2 + len(BEGINNINGS)
VOTERS = 2 * LISTS + 4


def inside(number: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which numbers are among sorted known ones."""
    if not len(known):
        return np.zeros(len(number), bool)
    return known[np.minimum(np.searchsorted(known, number), len(known) - 1)] == number


def beginnings(found: Words, size: int) -> np.ndarray:
    """Numbers of the first bytes of each word, zero for words that are not longer."""
    number = numbers(found.data, found.start, np.minimum(found.start + size, found.end))
    number[found.end - found.start <= size] = 0
    return number


def disguised(found: Words, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows in which a listed word is spelled with digits or signs for letters that are not its first or last."""
    data, out = found.data, np.zeros(len(offsets) - 1, bool)
    if len(data) < 3:
        return out
    at = np.flatnonzero(_SIGN[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]) + 1
    for row, k in zip(np.searchsorted(offsets, at, "right") - 1, at):
        if not out[row]:
            low, high = max(offsets[row], k - 24), min(offsets[row + 1], k + 24)
            left, right = data[low:k].tobytes().split(), data[k:high].tobytes().split()
            word = ((left[-1] if left else b"") + right[0]).strip(b".,;:?!\"'()")
            out[row] = word.translate(_UNDISGUISED) in _SPELLED
    return out


class Seen(NamedTuple):
    """What voters and classifier see of a group of rows."""
    n: np.ndarray           # words per row
    hits: np.ndarray        # rows x LISTS
    votes: np.ndarray       # voter k in bit k
    row: np.ndarray         # of each distinct hashed word of a row
    term: np.ndarray
    share: np.ndarray


def look(found: Words, original: np.ndarray, offsets: np.ndarray, lexicons: Lexicons) -> Seen:
    rows = len(found.first) - 1
    n = np.diff(found.first)
    row = np.repeat(np.arange(rows), n)
    listed = [inside(found.number, known) for known in _FIXED] + [inside(found.number >> MINED, known) for known in lexicons.words]
    listed += [inside(beginnings(found, size) >> MINED, known) if len(known) else np.zeros(len(row), bool) for size, known in zip(BEGINNINGS, lexicons.beginnings)]
    hits = np.stack([np.bincount(row[h], minlength=rows) for h in listed], axis=1)
    fired = [hits[:, k] > 0 for k in range(LISTS)] + [(hits[:, k] > 1) & (hits[:, k] * DENSE >= n) for k in range(LISTS)]
    insult = listed[0] | listed[1]
    same = row[1:] == row[:-1]
    threat = same & inside(paired(found.number[:-1], found.number[1:]), _THREATS)
    addressed, meant = inside(found.number, _ADDRESSED), np.zeros(len(row), bool)
    for gap in (1, 2, 3):
        meant[gap:] |= insult[gap:] & addressed[:-gap] & (row[gap:] == row[:-gap])
    loud = insult & (found.end - found.start > 2)
    loud[loud] = [not (original[s:e] >= 97).any() for s, e in zip(found.start[loud], found.end[loud])]
    fired += [np.bincount(row[:-1][threat], minlength=rows) > 0, np.bincount(row[meant], minlength=rows) > 0, disguised(found, row, offsets), np.bincount(row[loud], minlength=rows) > 0]
    votes = sum(f.astype(np.int64) << k for k, f in enumerate(fired))
    cell, count = np.unique(row * TERMS + (mix(found.number) % np.uint64(TERMS)).astype(np.int64), return_counts=True)
    return Seen(n, hits, votes, cell // TERMS, cell % TERMS, np.sqrt(count / n[cell // TERMS]))


def seen_groups(column: pa.Array, lexicons: Lexicons) -> Iterator[tuple[int, int, Seen]]:
    """`look` at a column, one group of rows after the other."""
    for at, to, found in word_groups(column, NOT_ALNUM):
        yield at, to, look(found, *texts(column.slice(at, to - at)), lexicons)


def dense_features(seen: Seen) -> np.ndarray:
    """Votes, hits and their density, for the classifier."""
    votes = (seen.votes[:, None] >> np.arange(VOTERS)) & 1
    return np.hstack([votes, np.log1p(seen.hits), np.minimum(50 * seen.hits / np.maximum(seen.n, 1)[:, None], 1)])


FEATURES = VOTERS + 2 * LISTS


class Classifier(NamedTuple):
    lexicons: Lexicons
    terms: np.ndarray
    dense: np.ndarray
    bias: float

    def scores(self, seen: Seen) -> np.ndarray:
        z = self.bias + dense_features(seen) @ self.dense + np.bincount(seen.row, seen.share * self.terms[seen.term], len(seen.n))
        return (1 / (1 + np.exp(-z.clip(-50, 50)))).round(6)


def train(row: np.ndarray, term: np.ndarray, share: np.ndarray, dense: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on probabilities: weights of the terms, of the dense features, and the bias. Accelerated gradient steps
    from zero, with more decay for terms, so the result depends on the rows alone."""
    n = max(len(target), 1)
    w, d, b = np.zeros(TERMS), np.zeros(FEATURES), 0.0
    pw, pd, pb = w, d, b
    limit = 0.25 * (2 + (dense ** 2).sum(axis=1).max(initial=0)) + 1e-2
    for k in range(STEPS):
        push = k / (k + 3)
        yw, yd, yb = w + push * (w - pw), d + push * (d - pd), b + push * (b - pb)
        z = yb + dense @ yd + np.bincount(row, share * yw[term], len(target))
        off = (1 / (1 + np.exp(-z.clip(-50, 50))) - target) / n
        pw, pd, pb = w, d, b
        w = yw - (np.bincount(term, share * off[row], TERMS) + 3e-3 * yw) / limit
        d = yd - (dense.T @ off + 1e-4 * yd) / limit
        b = yb - off.sum() / limit
    return w, d, float(b)


def held_out(doc_id: str) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def least_hashed(df: DataFrame, n: int) -> DataFrame:
    """The `n` rows with the least hashed `doc_id`, as a local table."""
    rows = df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if rows else df.limit(0)


def labelled_texts(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int) -> DataFrame:
    """`doc_id`, `label` (0 or 1) and `text` of at most `sample` labelled documents of each class, held out ones never. An id that is
    labelled several times has the greater label, one text of an id counts."""
    marked = (labels.where(~held_out(doc_id)).where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) >= 1).cast("int").alias("label")))
    ids = docs.select(F.col(doc_id).alias("doc_id")).where("doc_id is not null")
    here = marked.join(ids, "doc_id", "left_semi")
    known = least_hashed(here.where("label = 1"), sample).unionByName(least_hashed(here.where("label = 0"), sample))
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
            .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")))


def mine(known: DataFrame) -> Lexicons:
    """Words and word beginnings that toxic texts of a labelled sample have far more often than others. Texts that share their least hashed
    word count once, so copies do not vote for each other; tasks count before the shuffle."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, found in word_groups(batch.column(1), NOT_ALNUM):
                mixed = mix(found.number)
                least = [int(mixed[a:b].min() >> np.uint64(1)) if b > a else 0 for a, b in zip(found.first, found.first[1:])]
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(least, pa.int64())], ["label", "text", "least"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[np.ndarray]] = {0: [], 1: []}
        docs = [0, 0]
        for batch in batches:
            marks = batch.column(0).to_numpy()
            for at, to, found in word_groups(batch.column(1), NOT_ALNUM):
                kinds = [found.number >> MINED, *(beginnings(found, size) >> MINED for size in BEGINNINGS)]
                for r in range(to - at):
                    a, b = found.first[r], found.first[r + 1]
                    mark = int(marks[at + r])
                    docs[mark] += 1
                    totals[mark] += [np.unique(kind[a:b]) | np.uint64(k << 61) for k, kind in enumerate(kinds)]
        for mark, lists in totals.items():
            term, n = np.unique(np.concatenate([*lists, np.zeros(0, np.uint64)]), return_counts=True)
            term, n = np.append(term, np.uint64((1 << 64) - 1)), np.append(n, docs[mark])
            for at in range(0, len(term), 50_000):
                own = n[at:at + 50_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(term[at:at + 50_000].astype(np.int64)), pa.array(own * mark), pa.array(own * (1 - mark))], ["term", "toxic", "clean"])

    single = known.select("label", "text").mapInArrow(frugal(mark), "label int, text string, least long").groupBy("label", "least").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    counted = (single.select("label", "text").mapInArrow(frugal(count), "term long, toxic long, clean long")
               .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"toxic >= {SUPPORT} or term = -1").collect())
    total = next(((r["toxic"], r["clean"]) for r in counted if r["term"] == -1), (0, 0))
    found = np.array([(r["term"], r["toxic"], r["clean"]) for r in sorted(counted) if r["term"] != -1], np.int64).reshape(-1, 3)
    empty = np.zeros(0, np.uint64)
    if not len(found) or not total[0] or not total[1]:
        return Lexicons([empty, empty], [empty] * len(BEGINNINGS))
    toxic, clean = found[:, 1].astype(float), found[:, 2].astype(float)
    rate, other, both = toxic / total[0], clean / total[1], (toxic + clean) / sum(total)
    with np.errstate(divide="ignore", invalid="ignore"):
        def part(n, k, p):
            return np.where(k > 0, k * np.log(k / (n * p)), 0) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - p))), 0)
        surprise = 2 * (part(total[0], toxic, both) + part(total[1], clean, both))
    kept = found[(rate >= RATIO * other) & (surprise >= SURPRISE), 0].astype(np.uint64)
    kind, number = kept >> np.uint64(61), kept & np.uint64((1 << 61) - 1)
    return Lexicons([np.unique(number[(kind == 0) & (number & np.uint64(1) == half)]) for half in (0, 1)],
                    [np.unique(number[(kind == k + 1) & (number > 0)]) for k in range(len(BEGINNINGS))])


def pattern_counts(rows: DataFrame, lexicons) -> list:
    """How often each pattern of votes occurs in a column `text`, by `label`: at most 2 ** VOTERS patterns, counted in each task first."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}
        for batch in batches:
            marks = batch.column(1).to_numpy()
            for at, to, seen in seen_groups(batch.column(0), lexicons.value):
                both, n = np.unique(seen.votes * 4 + marks[at:to] + 1, return_counts=True)
                for key, c in zip(both.tolist(), n.tolist()):
                    held[key] = held.get(key, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], ["key", "n"])

    return rows.select("text", "label").mapInArrow(frugal(task), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()


def fit_model(rows: list) -> LabelModel:
    """The label model of `pattern_counts`: label -1 is unknown."""
    key, count = np.array([r["key"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    mark = key % 4 - 1
    return fit_labels(key // 4, count, np.where(mark < 0, np.nan, mark), VOTERS)


def fit(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int, trained: int) -> Classifier:
    spark = docs.sparkSession
    known = labelled_texts(docs, labels, text, doc_id, label, sample)
    lexicons = mine(known)
    shared = spark.sparkContext.broadcast(lexicons)
    every = docs.select(F.col(text).alias("text"), F.lit(-1).alias("label"))
    model = fit_model(pattern_counts(every.unionByName(known.select("text", "label")), shared))
    ids = docs.where(F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(F.col(doc_id).alias("doc_id")).distinct()
    drawn = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(least_hashed(ids, trained)), "doc_id")
             .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")).withColumn("label", F.lit(-1)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, seen in seen_groups(batch.column(2), shared.value):
                dense = dense_features(seen).astype(np.float32)
                ends = np.searchsorted(seen.row, np.arange(to - at + 1))
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(seen.votes), pa.array([v.tobytes() for v in dense], pa.binary()),
                    pa.array([seen.term[a:b].astype(np.uint16).tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                    pa.array([seen.share[a:b].astype(np.float32).tobytes() for a, b in zip(ends, ends[1:])], pa.binary())], ["doc_id", "label", "votes", "dense", "term", "share"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = (drawn.select("doc_id", "label", "text").unionByName(known.select("doc_id", "label", "text"))
            .mapInArrow(frugal(task), f"doc_id {kind}, label int, votes long, dense binary, term binary, share binary").orderBy("doc_id", "label").collect())
    if not rows or not any(r["label"] >= 0 for r in rows):
        return Classifier(lexicons, np.zeros(TERMS), np.zeros(FEATURES), 0.0)
    mark = np.array([r["label"] for r in rows])
    target = np.where(mark < 0, model.posterior(np.array([r["votes"] for r in rows], np.int64)), mark)
    term = [np.frombuffer(r["term"], np.uint16) for r in rows]
    return Classifier(lexicons, *train(np.repeat(np.arange(len(rows)), [len(t) for t in term]), np.concatenate(term).astype(np.int64),
                                       np.concatenate([np.frombuffer(r["share"], np.float32) for r in rows]).astype(float),
                                       np.array([np.frombuffer(r["dense"], np.float32) for r in rows], float), target))


def toxicity_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE,
                    trained: int = TRAINED, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` with `held_out`, `score` (0 to 1, higher: label 1 likelier) and `predicted` (1 from `threshold` on).

    The score comes from the text alone; texts that are null, empty or without words get that of no votes. Without any label to learn from
    all scores are 0.5. Repeated rows are scored one by one. Columns named like an added one are replaced; `keep` names those
    that are carried along, all by default."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels, text, doc_id, label, sample, trained))
    carried = [c for c in (docs.columns if keep is None else keep) if c not in ("held_out", "score", "predicted")]
    names, place, places = columns_for(text, carried)
    schema = T.StructType([docs.schema[c] for c in carried] + [T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, seen in seen_groups(batch.column(place), shared.value.lexicons):
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in places), part.column(len(names)), pa.array(shared.value.scores(seen))], schema.fieldNames())

    scored = docs.select(*names, held_out(doc_id).alias("held_out")).mapInArrow(frugal(task), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
