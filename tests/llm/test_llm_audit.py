import re
from itertools import permutations

from llm_helpers import no_docs, odd_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm.audit import filter_audit, possible_repeats, sketch, sketch_blocks

NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain(rows, labels):
    """Every order run one filter after the other over a list."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    def fails(i, text):
        words = re.findall("[^ \t-\r]+", text)
        return {f for f, bad in zip("ABCDE", [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                                              bool(re.search("[#$%&*|]", text)), i is not None and i > first[text]]) if bad}
    docs = [(part or "", i, fails(i, text or "")) for i, text, part in rows]
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    out, shapley = {}, {}
    for part in {p for p, _, _ in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                goes = [d for d in left if f in d[2]]
                left = [d for d in left if f not in d[2]]
                failing = [d for d in docs if d[0] == part and f in d[2]]
                out[part, "".join(order), step] = [len(left), len(goes), len(failing) - len(goes), sum(d[2] == {f} for d in failing),
                                                   sum(d[1] in good for d in goes), sum(d[1] in toxic for d in goes)]
                shapley[part, f] = shapley.get((part, f), 0) + len(goes)
    return sorted((*key, *v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


def test_every_order_equals_a_plain_run(spark):
    rows = [(k, (prose(k % 60, 40 + 17 * (k % 11)) + " %" * (k % 5 == 0)).upper() if k % 7 == 0 else prose(k % 60, 40 + 17 * (k % 11), 2000 if k % 2 else 90), ["en", "de", None][k % 3])
            for k in range(240)]
    labels = [(k, k % 4 % 2, int(k % 5 == 0)) for k in range(0, 240, 2)]
    got = filter_audit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows_of(got) == plain(rows, labels)
    assert got.count() == 3 * 600


def test_odd_tables(spark, odd_docs, no_docs):
    labels = [(1, 1, None), (1, 0, 1), (6, 1, 1), (None, 1, 1), (77, 1, 1), (8, None, None)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    assert rows_of(filter_audit(odd_docs, frame)) == plain(rows, [x for x in labels if x[0] is not None])
    assert rows_of(filter_audit(odd_docs, frame.limit(0))) == plain(rows, [])
    assert filter_audit(no_docs, frame).count() == 0


def test_sketch_clears_unique_texts_only(spark):
    texts = spark.range(4000).select(F.xxhash64(F.when(F.col("id") < 3000, F.col("id")).otherwise(F.col("id") % 500)).alias("h"), "id")
    blocks = sketch_blocks(4000)
    judged = possible_repeats(texts, sketch(texts.select("h"), blocks), blocks).collect()
    truth = {r["id"] for r in judged if r["id"] < 500 or r["id"] >= 3000}
    assert all(r["repeat"] for r in judged if r["id"] in truth)
    assert sum(r["repeat"] for r in judged if r["id"] not in truth) < 75
    crowded = possible_repeats(texts, sketch(texts.select("h"), 1), 1)      # a sketch far too small clears none and loses none
    assert all(r["repeat"] for r in crowded.collect() if r["id"] in truth)


def test_a_small_sketch_gives_the_same_counts(spark):
    rows = [(k, prose(k % 150, 30 + k % 100), "en") for k in range(300)] + [(300 + k, t * 9, "en") for k, t in enumerate(["f", "f f", "\x0bx\x0cy\x1c\u00a0", "\x0b\x0c", "ff\r\n"])]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rows_of(filter_audit(docs, labels, most_cells=512)) == plain(rows, [])
