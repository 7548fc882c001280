import hashlib
import random
import re

from llm_helpers import no_docs, odd_docs, prose  # noqa: F401

from tickloom.llm.decontaminate import contamination, decontaminate


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(doc, items):
    w, hit, ids = words(doc), set(), set()
    for item, text in items:
        x = words(text)
        size = min(10, len(x))
        for s in range(len(x) - size + 1) if x else ():
            for p in range(len(w) - size + 1):
                if w[p:p + size] == x[s:s + size]:
                    hit.update(range(p, p + size))
                    ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def test_against_a_plain_search(spark):
    draw = random.Random(2)
    items = [(k, prose(k, draw.randrange(1, 40), 30)) for k in range(25)] + [(100, "solo"), (101, "two words"), (102, ""), (103, None), (104, "solo"), (2, prose(77, 15))]
    docs = []
    for k in range(60):
        parts = [prose(500 + k, draw.randrange(0, 40), 30)]
        for _ in range(draw.randrange(3)):
            x = draw.choice(items)[1] or ""
            cut = draw.randrange(0, max(1, len(x.split())))
            parts += [" ".join(x.split()[cut:]).upper(), draw.choice(["", "!", "\n", "solo"]), prose(900 + k, 3)]
        docs.append((k, draw.choice([" ", ", ", "\n-- "]).join(parts)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in contamination(df, bench).collect()}
    for k, text in docs:
        r = got[k]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == plain(text, items)
    clean = {r["doc_id"] for r in decontaminate(df, bench).collect()}
    assert clean == {k for k, _ in docs if not got[k]["contaminated"]} and 0 < len(clean) < len(docs)


def test_longest_match_has_its_place(spark):
    item = prose(1, 30, 10 ** 6)
    text = prose(2, 7) + " " + " ".join(item.split()[5:25]) + " " + prose(3, 9)
    r = contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([("q", item)], "item_id string, text string")).first()
    assert r["longest"].asDict() == {"item_id": "q", "doc_word": 7, "item_word": 5, "words": 20}


def test_odd_tables(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, prose(1, 60)), (None, "x"), (2, None)], "item_id long, text string")
    rows = contamination(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count()
    assert sorted((str(r["doc_id"]), r["n_hit"], r["n_items"]) for r in rows if r["contaminated"]) == [("1", 60, 1), ("1", 60, 1), ("2", 60, 1), ("8", 1, 0), ("None", 60, 1)]
    assert contamination(no_docs, bench).count() == 0
    assert contamination(odd_docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate(odd_docs, bench).columns == odd_docs.columns
    small = contamination(odd_docs, bench, max_benchmark_bytes=10).collect()
    assert sorted(str(r.asDict()) for r in small) == sorted(str(r.asDict()) for r in rows)


def test_parts_of_a_benchmark_equal_the_whole(spark):
    draw = random.Random(9)
    items = [(k, prose(k, draw.randrange(1, 30), 20)) for k in range(30)]
    docs = [(k, prose(300 + k, 20, 20) + " " + " ".join(draw.choice(items)[1] for _ in range(k % 4))) for k in range(40)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole, parts = (contamination(df, bench, max_benchmark_bytes=n).drop("text") for n in (1 << 20, 1500))
    show = lambda r: (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"], r["longest"] and r["longest"]["words"])
    assert sorted(map(show, whole.collect())) == sorted(map(show, parts.collect()))


def test_shards_equal_all_pairs():
    """Every window compared with every place, on few words so that all kinds of overlaps occur."""
    import numpy as np
    import pyarrow as pa

    from tickloom.llm.decontaminate import Suffixes, shared_with
    from tickloom.llm.words import NOT_ALNUM, texts
    from tickloom.llm.words import words as cut
    draw = random.Random(1)
    for _ in range(150):
        few, window = draw.choice([1, 2, 3, 5, 20]), draw.choice([2, 3, 4, 10])
        items = [(k, " ".join(f"w{draw.randrange(few)}" for _ in range(draw.choice([0, 1, 2, 3, 5, 8, 12, 15])))) for k in range(draw.randrange(1, 6))]
        docs = [" ".join(f"w{draw.randrange(few + 1)}" for _ in range(draw.choice([0, 1, 4, 9, 15, 30]))) for _ in range(draw.randrange(1, 6))]
        bench, found = Suffixes(items, window), cut(*texts(pa.array(docs)), NOT_ALNUM)
        for text, got in zip(docs, shared_with(found, bench, window)):
            w, hit, ids, best = text.split(), set(), set(), None
            for i, (name, item) in enumerate(items):
                x = item.split()
                size = min(window, len(x))
                for s in range(len(x) - size + 1) if x else ():
                    for p in range(len(w) - size + 1):
                        if w[p:p + size] == x[s:s + size]:
                            hit.update(range(p, p + size))
                            ids.add(str(name))
                            length = size
                            while s + length < len(x) and p + length < len(w) and w[p + length] == x[s + length]:
                                length += 1
                            best = min(best or (0, 0, 0, 0), (-length, p, s, i))
            assert {k for a, b in got.spans for k in range(a, b)} == hit and got.items == ids
            assert got.longest == (best and (-best[0], best[1], best[2], str(items[best[3]][0])))
            assert np.all(got.spans[1:, 0] > got.spans[:-1, 1])


def test_repeated_words_cost_their_number():
    import time

    import pyarrow as pa

    from tickloom.llm.decontaminate import Suffixes, shared_with
    from tickloom.llm.words import NOT_ALNUM, texts
    from tickloom.llm.words import words as cut
    bench, began = Suffixes([(1, "a " * 1000), (2, "a " * 400)], 10), time.time()
    got, = shared_with(cut(*texts(pa.array(["a " * 100_000])), NOT_ALNUM), bench, 10)
    assert got.items == {"1", "2"} and got.longest == (1000, 0, 0, "1") and got.spans.tolist() == [[0, 100_000]]
    assert time.time() - began < 10
