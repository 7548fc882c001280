"""What filters take from a corpus in every order they may run in.

Each document gets a number whose bits are the filters it fails, so all counts of all orders are sums over the few
different numbers of a part. Only the filter for repeated texts looks beyond its own row. A counting Bloom sketch of
all texts goes first: a text with a cell that no other text has met is unique, and only the others are shuffled,
by their whole text, for the least id of each.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import written

FILTERS = "ABCDE"
REPEATED = "E"                  # the filter that needs other rows
CELLS_A_TEXT = 16
BLOCK_CELLS = 512               # a text has all its cells in one block of eight 64-bit numbers
MOST_CELLS = 1 << 29            # of the sketch, which is broadcast: 64 MB of bits
HASHES = 3


def words(text: str) -> Column:
    """Words of a text that is not null; none of a blank one."""
    bare = F.expr(f"trim(BOTH ' \\t\\n\\u000B\\u000C\\r' FROM {text})")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def row_failures(text: Column, words: Column) -> dict[str, Column]:
    """The filters that look at one text, as conditions for failing: under 100 words, under 80 % distinct words, over
    10 % capitals A-Z among its code points, one of the signs `#$%&*|`."""
    n, distinct, capitals = F.size(words), F.size(F.array_distinct(words)), F.regexp_count(text, F.lit("[A-Z]"))
    return {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * capitals > 10 * F.length(text), "D": text.rlike("[#$%&*|]")}


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def cells(h: str, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a text in a sketch and its cells there, from a 64-bit hash."""
    return F.pmod(F.xxhash64(F.col(h)), F.lit(blocks)), [F.shiftrightunsigned(F.col(h), 9 * k).bitwiseAND(BLOCK_CELLS - 1).cast("int") for k in range(HASHES)]


def sketch_blocks(rows: int, most_cells: int = MOST_CELLS) -> int:
    """Blocks of a sketch: a power of two with CELLS_A_TEXT cells for each row, at most `most_cells`."""
    return max(1, min(1 << max(0, rows * CELLS_A_TEXT - 1).bit_length(), most_cells) // BLOCK_CELLS)


def sketch(hashes: DataFrame, blocks: int) -> DataFrame:
    """The merged counting sketch of a column `h`: for every block the bits of the cells that counted more than one
    text. Cells are counted in each task first, so copies of one text send a row a cell and task."""
    block, places = cells("h", blocks)
    counted = (hashes.select(block.alias("block"), F.explode(F.array_distinct(F.array(*places))).alias("cell"))
               .groupBy("block", "cell").count().where("count > 1"))
    word = F.floor(F.col("cell") / 64).cast("int")
    held = [F.coalesce(F.bit_or(F.when(word == k, F.expr("shiftleft(1L, cast(cell % 64 as int))"))), F.lit(0).cast("long")) for k in range(BLOCK_CELLS // 64)]
    return counted.groupBy("block").agg(F.array(*held).alias("bits"))


def possible_repeats(df: DataFrame, found: DataFrame, blocks: int) -> DataFrame:
    """`df`, which has `h`, with `repeat`: false where the sketch proves that no other row has the text. The sketch is
    broadcast; its size is bounded by MOST_CELLS."""
    block, places = cells("h", blocks)
    all_met = reduce(and_, [F.expr(f"getbit(bits[cast(_c{k} div 64 as int)], _c{k} % 64) = 1") for k in range(HASHES)])
    met = df.withColumn("block", block).withColumns({f"_c{k}": p for k, p in enumerate(places)}).join(F.broadcast(found), "block", "left")
    return met.withColumn("repeat", F.coalesce(all_met, F.lit(False))).drop("block", "bits", *[f"_c{k}" for k in range(HASHES)])


def failure_masks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang", most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `part`, and `mask`, the bits of the filters it fails.

    A text fails E if a row with a smaller id has the same whole text. A null text is empty, a null part too; a row
    without an id is neither smaller than others nor fails E, and of rows with one id and one text none is smaller."""
    whole = F.coalesce(F.col(text), F.lit(""))
    each = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), whole.alias("text")).withColumn("words", words("text"))
    mask = reduce(lambda a, b: a + b, [F.when(fails, bit(name)).otherwise(0) for name, fails in row_failures(F.col("text"), F.col("words")).items()])
    rows = written(each.select("doc_id", "part", mask.alias("mask"), F.xxhash64("text").alias("h")), "masks")
    blocks = sketch_blocks(rows.count(), most_cells)
    found = written(sketch(rows.select("h"), blocks), "sketch")
    texts = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("h"))
    first = (possible_repeats(texts, found, blocks).where("repeat").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
             .select("doc_id", F.xxhash64("text").alias("h"), F.lit(True).alias("first")))
    judged = possible_repeats(rows, found, blocks)
    single, several = judged.where("not repeat or doc_id is null"), judged.where("repeat and doc_id is not null")
    later = several.join(first.distinct(), ["doc_id", "h"], "left").withColumn("mask", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + bit(REPEATED)))
    return single.select("doc_id", "part", "mask").unionByName(later.select("doc_id", "part", "mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, doc_id: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Documents of each `part` and `mask`, as `n`, and how many of them are marked good and toxic. An id that is labelled
    several times is marked if one of its labels says so."""
    marks = (labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id"))
             .agg(F.coalesce(F.max(F.col(good) == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col(toxic) == 1), F.lit(False)).alias("toxic")).where("good or toxic"))
    named = masks.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = masks.where("doc_id is null").withColumns({"good": F.lit(None).cast("boolean"), "toxic": F.lit(None).cast("boolean")})
    return (named.unionByName(nameless).groupBy("part", "mask")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of all filters and step: `kept` after it, `removed` by it, `redundant` (fail its filter, gone
    before), `unique_fails` (fail nothing else), marked documents it takes, and `shapley`, what its filter removes in all
    orders together: a document that fails k filters falls to each of them in one of k orders."""
    steps = [f"struct('{''.join(o)}' as filter_order, {k + 1} as step, {bit(o[k])} as own, {sum(bit(f) for f in o[:k])} as before)"
             for o in permutations(FILTERS) for k in range(len(FILTERS))]
    orders = len(steps) // len(FILTERS)
    spread = counts.select("*", F.explode(F.expr(f"array({', '.join(steps)})")).alias("s")).select("*", "s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition, column="n"):
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    return spread.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"), total(gone & fails).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(~gone & fails, "good").alias("good_lost"),
        total(~gone & fails, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * (orders / F.bit_count("mask")).cast("long")).otherwise(0)).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """`audit` of the five filters over whole `docs`, for all parts; none without documents."""
    return audit(mask_counts(failure_masks(docs, **columns), labels))
