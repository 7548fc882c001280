import re

import corpus_pipeline as p
from llm_helpers import SF, TOKENIZER, odd_docs  # noqa: F401
from test_llm_decontaminate import plain as contaminated
from test_llm_jaccard import plain as components
from tokenizers import Tokenizer

from tickloom.llm.quality import quality_scores


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}

    good = p.quality(spark, docs, SF)
    assert good.columns == docs.columns
    scored = {r["doc_id"]: r["predicted"] for r in quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    good = spark.createDataFrame(good.collect(), docs.schema)
    assert {r["doc_id"] for r in good.collect()} == {i for i, y in scored.items() if y}

    single = p.near_copies(spark, good, SF)
    assert single.columns == docs.columns
    ids = sorted(r["doc_id"] for r in good.collect())
    single = spark.createDataFrame(single.collect(), docs.schema)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, c in components(ids, [given[i] for i in ids])})

    clean = p.benchmark_passages(spark, single, SF)
    assert clean.columns == docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    near = [(i, t) for i, t in items]
    clean = spark.createDataFrame(clean.collect(), docs.schema)
    joined = {i: " ".join(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for i, t in near}
    windows = {" ".join(w.split()[s:s + 10]) for w in joined.values() for s in range(max(1, len(w.split()) - 9))}
    for r in single.collect():
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        hit = any(" ".join(words[s:s + 10]) in windows for s in range(max(0, len(words) - 9)))
        assert hit == (r["doc_id"] not in {x["doc_id"] for x in clean.select("doc_id").collect()}) if hit else True

    private = p.personal_data(spark, clean, SF)
    assert private.columns == docs.columns
    private = spark.createDataFrame(private.collect(), docs.schema)
    changed = {r["doc_id"]: r["text"] for r in private.collect()}
    assert set(changed) == {r["doc_id"] for r in clean.collect()}
    for i, text in changed.items():
        values = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+@[\w.]+\.com|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", given[i])
        assert (text != given[i]) or not values
        assert all(v not in text for v in values)

    pieces = p.sequences(spark, private, SF).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for r in private.collect():
        assert sum(x["length"] for x in pieces if x["doc_id"] == r["doc_id"]) == len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1


def test_stage_list():
    assert [name for name, _ in p.STAGES] == ["quality", "near_copies", "benchmark_passages", "personal_data", "sequences"]
    assert p.ORACLE_SQL is None and contaminated("a", [(1, "a")])[4]


def test_odd_documents(spark, odd_docs):
    docs = odd_docs
    for _, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_docs.columns
    assert p.sequences(spark, docs, SF).count() > 0
    docs = odd_docs.limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
