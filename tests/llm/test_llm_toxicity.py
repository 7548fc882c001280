import re
import zlib

import numpy as np
import pyarrow as pa
from llm_helpers import no_docs, odd_docs, prose  # noqa: F401

from tickloom.llm.label_model import fit_labels, linked_cliques, patterns
from tickloom.llm.toxicity import (BEGINNINGS, DENSE, ENGLISH, LISTS, OTHERS, TERMS, Classifier, Lexicons, dense_features, held_out, labelled_texts, mine,
                                   seen_groups, toxicity_scores, train, word_number)

NONE = np.zeros(0, np.uint64)
EMPTY = Lexicons([NONE, NONE], [NONE] * len(BEGINNINGS))
INSULTS = ["stupid", "idiot", "zorgface", "blarghead", "blarghing", "blarghish"]


def text(k):
    words = prose(k, 20 + k % 150).split()
    for j in range(0, len(words), 7) if k % 5 == 0 else ():
        words[j] = INSULTS[(k + j) % len(INSULTS)]
    return " ".join(words) + "."


def labelled(spark, n=800):
    docs = spark.createDataFrame([(k, text(k), "s") for k in range(n)], "doc_id long, text string, score string")
    return docs, spark.createDataFrame([(k, int(k % 7 > 0), int(k % 5 == 0)) for k in range(0, n, 2)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    got = {r["doc_id"]: r for r in toxicity_scores(docs, labels).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    held = [k for k, r in got.items() if r["held_out"]]
    assert np.mean([got[k]["predicted"] == int(k % 5 == 0) for k in held]) > 0.98
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())


def test_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels, keep=["doc_id"]).join(labels, "doc_id").where("held_out").toPandas()
    assert (scored["predicted"] == scored["toxic"]).mean() > 0.95
    assert scored[scored["toxic"] == 0]["predicted"].mean() < 0.02


def test_held_out_labels_are_not_learned(spark):
    docs, labels = labelled(spark, 200)
    turned = labels.withColumn("toxic", held_out("doc_id").cast("int").bitwiseXOR(labels["toxic"]))
    assert turned.subtract(labels).count() > 10
    first = [r["score"] for r in toxicity_scores(docs, labels).orderBy("doc_id").collect()]
    assert first == [r["score"] for r in toxicity_scores(docs, turned).orderBy("doc_id").collect()]


def test_mined_lexicons(spark):
    docs, labels = labelled(spark)
    found = mine(labelled_texts(docs, labels, "text", "doc_id", "toxic", 500))
    words = {w for w in INSULTS if any((word_number(w) >> 3) in known for known in found.words)}
    assert words == set(INSULTS)
    assert (word_number("blar") >> 3) in found.beginnings[BEGINNINGS.index(4)]


def test_copies_count_once_when_mining(spark):
    same = "plain harmless sentence of a copied page with words like marigold and tangerine"
    rows = [(k, 1, same) for k in range(60)] + [(100 + k, 0, prose(k, 30)) for k in range(60)] + [(200 + k, 1, prose(k + 70, 30) + " zorgface") for k in range(20)]
    found = mine(spark.createDataFrame(rows, "doc_id long, label int, text string"))
    known = np.concatenate(found.words)
    assert word_number("zorgface") >> 3 in known and word_number("marigold") >> 3 not in known


def plain_votes(value):
    """The votes of the fixed voters, by regular expressions."""
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), value))
    hits = [sum(w in known for w in words) for known in (set(ENGLISH), set(OTHERS))] + [0] * (LISTS - 2)
    return len(words), hits, [h > 0 for h in hits] + [h > 1 and h * DENSE >= len(words) for h in hits]


def test_fixed_voters_equal_a_plain_version():
    draw = np.random.default_rng(3)
    values = [" ".join(draw.choice(["a", "you", "Stupid", "IDIOT", "kill", "crétin", "tree", "id1ot", "$tupid", "tr@sh!", "x1y"], int(draw.integers(0, 60)))) for _ in range(80)] + ["", None, "é", "1"]
    for at, to, seen in seen_groups(pa.array(values), EMPTY):
        for r in range(at, to):
            n, hits, fired = plain_votes(values[r] or "")
            assert (seen.n[r - at], seen.hits[r - at].tolist()) == (n, hits)
            votes = [bool(int(seen.votes[r - at]) >> k & 1) for k in range(2 * LISTS + 4)]
            assert votes[:2 * LISTS] == fired
            lower = (values[r] or "").lower()
            assert votes[2 * LISTS] == bool(re.search(r"\bkill you\b", lower))
            assert votes[2 * LISTS + 2] == bool(re.search(r"id1ot|tr@sh", lower))
            assert votes[2 * LISTS + 3] == ("IDIOT" in (values[r] or ""))


def test_label_model_finds_accuracies():
    draw = np.random.default_rng(1)
    truth = draw.random(20000) < 0.2
    right, wrong = [0.9, 0.8, 0.7, 0.6, 0.85], [0.02, 0.05, 0.1, 0.02, 0.08]
    votes = sum((draw.random(20000) < np.where(truth, right[k], wrong[k])).astype(np.int64) << k for k in range(5))
    pattern, count = np.unique(votes, return_counts=True)
    model = fit_labels(pattern, count, np.full(len(pattern), np.nan), 5)
    assert abs(model.share - 0.2) < 0.02 and len(model.cliques) == 5
    assert np.abs(model.accuracy - [(r + 1 - w) / 2 for r, w in zip(right, wrong)]).max() < 0.03
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.96


def test_voters_that_copy_each_other_count_once():
    draw = np.random.default_rng(2)
    truth = draw.random(20000) < 0.3
    a, b, c = (draw.random(20000) < np.where(truth, p, q) for p, q in ((0.85, 0.1), (0.8, 0.1), (0.75, 0.15)))
    noise = draw.random(20000) < np.where(truth, 0.4, 0.3)
    votes = sum(v.astype(np.int64) << k for k, v in enumerate((a, b, c, noise, noise, noise)))
    assert [3, 4, 5] in linked_cliques(votes, np.ones(20000), truth.astype(float), 6)
    pattern, count = np.unique(votes, return_counts=True)
    start = ((patterns(pattern, [0]) + patterns(pattern, [1]) + patterns(pattern, [2])) >= 2) * 0.8 + 0.1
    model = fit_labels(pattern, count, np.full(len(pattern), np.nan), 6, start)
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.9


def test_posteriors_equal_bayes_by_hand():
    draw = np.random.default_rng(4)
    votes = draw.integers(0, 16, 500)
    pattern, count = np.unique(votes, return_counts=True)
    model = fit_labels(pattern, count, np.where(pattern == 15, 1.0, np.where(pattern == 0, 0.0, np.nan)), 4)
    for v in range(16):
        one, zero = model.share, 1 - model.share
        for clique, table in zip(model.cliques, model.tables):
            key = sum((v >> voter & 1) << k for k, voter in enumerate(clique))
            one, zero = one * np.exp(table[1, key]), zero * np.exp(table[0, key])
        assert abs(model.posterior(np.array([v]))[0] - one / (one + zero)) < 1e-9


def test_scores_equal_a_plain_sum():
    draw = np.random.default_rng(5)
    values = [text(k) for k in range(0, 60, 3)]
    (_, _, seen), = seen_groups(pa.array(values), EMPTY)
    dense = dense_features(seen)
    weights = train(seen.row, seen.term, seen.share, dense, draw.random(len(values)))
    got = Classifier(EMPTY, *weights).scores(seen)
    for r in range(len(values)):
        z = weights[2] + dense[r] @ weights[1] + sum(s * weights[0][t] for row, t, s in zip(seen.row, seen.term, seen.share) if row == r)
        assert abs(got[r] - 1 / (1 + np.exp(-z))) < 1e-5
    assert len(weights[0]) == TERMS


def test_odd_tables(spark, odd_docs, no_docs):
    _, labels = labelled(spark, 40)
    more = labels.union(spark.createDataFrame([(None, 1, 0), (1, None, None), (1, 1, 1)], labels.schema))
    rows = toxicity_scores(odd_docs, more).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "", " \n\t ")}) == 1
    assert {r["score"] for r in toxicity_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity_scores(no_docs, labels).count() == 0
    assert toxicity_scores(odd_docs, spark.createDataFrame([(1, 1, 1)], labels.schema)).count() == odd_docs.count()
