import zlib

import numpy as np
from llm_helpers import no_docs, odd_docs, prose  # noqa: F401

from tickloom.llm.quality import fit, good_documents, quality_scores, term_vectors, vote


def junk(k):
    kind = k // 10 % 4
    text = prose(k, 80)
    return (" | ".join(text.split()), "!! ".join(text.upper().split()), "%%% ".join(text.split()), " ".join(text.split()[:4] * 20))[kind]


def labelled(spark, n=800):
    docs = [(k, junk(k) if k % 5 == 0 else prose(k, 20 + k % 150) + ".") for k in range(n)]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, score string")
    return docs, df, spark.createDataFrame([(k, int(k % 5 != 0), 0) for k in range(0, n, 2)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, df, labels = labelled(spark)
    got = {r["doc_id"]: r for r in quality_scores(df, labels).collect()}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in docs)
    held = [i for i, _ in docs if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == int(i % 5 != 0) for i in held]) > 0.97
    assert all(got[i]["predicted"] == int(got[i]["score"] >= 0.7) for i, _ in docs)
    kept = good_documents(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] for r in got.values())


def test_sample_is_joined_without_the_driver(spark, monkeypatch):
    """Local rows would come through Python workers of another kind, which stay beside those of the tasks."""
    docs, df, labels = labelled(spark, 60)

    def local(*_, **__):
        raise AssertionError("rows of the driver")

    monkeypatch.setattr(type(spark), "createDataFrame", local)
    assert quality_scores(df, labels).count() == len(docs)


def test_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels, keep=["doc_id"]).join(labels, "doc_id").where("held_out").toPandas()
    assert (scored["predicted"] == scored["quality"]).mean() > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs, df, labels = labelled(spark, 200)
    held = [k for k in range(0, 200, 2) if zlib.crc32(str(k).encode()) % 4 == 2]
    turned = spark.createDataFrame([(k, int(k % 5 == 0) if k in held else int(k % 5 != 0)) for k in range(0, 200, 2)], "doc_id long, quality int")
    first = [r["score"] for r in quality_scores(df, labels).orderBy("doc_id").collect()]
    assert first == [r["score"] for r in quality_scores(df, turned).orderBy("doc_id").collect()]


def test_votes_are_exact_weighted_cosines():
    draw = np.random.default_rng(1)
    vectors = draw.random((60, term_vectors.__globals__["TERMS"])).astype(np.float32) * (draw.random((60, 1)) > 0.05)
    label = (draw.random(60) > 0.4).astype(float)
    space = fit(vectors, label, 8)
    got = vote(space, vectors, 5)
    for k in range(60):
        v = vectors[k] * space.weight
        v = v / (np.linalg.norm(v) or 1) @ space.axes
        near = space.known @ (v / (np.linalg.norm(v) or 1))
        best = np.argsort(-near)[:5]
        best = best[near[best] > 0]
        want = near[best] @ space.label[best] / near[best].sum() if len(best) else space.prior
        assert abs(got[k] - want) < 1e-4


def test_odd_tables(spark, odd_docs, no_docs):
    _, _, labels = labelled(spark, 40)
    more = labels.union(spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 1, 1)], labels.schema))
    rows = quality_scores(odd_docs, more).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] in (None, "", " \n\t ")}) == 1
    assert {r["score"] for r in quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(no_docs, labels).count() == 0


def test_texts_that_nothing_judged_stay(spark):
    from tickloom.llm.quality import good_documents
    docs = spark.createDataFrame([(i, f"some plain words number {i}") for i in range(8)] + [(8, ""), (9, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert good_documents(docs, none).count() == 10
    assert good_documents(docs, spark.createDataFrame([(77, 0)], "doc_id long, quality int")).count() == 10
    bad = spark.createDataFrame([(i, 0) for i in range(8)], "doc_id long, quality int")
    assert sorted(r["doc_id"] for r in good_documents(docs, bad).collect()) == [8, 9]
