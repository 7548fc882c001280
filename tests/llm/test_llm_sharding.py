import zlib

import pytest
from llm_helpers import no_docs, odd_docs, prose  # noqa: F401

from tickloom.llm.sharding import borders, keyed, shard


def check(df, docs, shards):
    rows = df.select("doc_id", "text", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()
    assert len(rows) == len(docs)
    slots, sizes, homes = {}, [0] * shards, {}
    for r in rows:
        data = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
        homes.setdefault(r["text"], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, homes


def test_sizes_are_near_equal_and_copies_stay_together(spark):
    data = [(i, prose(i % 1900, 5 + i % 70)) for i in range(4000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    sizes, homes = check(shard(df), data, 16)
    mean = sum(sizes) / 16
    assert max(abs(s - mean) for s in sizes) < 0.02 * mean
    assert sum(len(h) > 1 for h in homes.values()) <= 3


def test_a_group_larger_than_a_shard_is_cut_by_id(spark):
    data = [(i, "the same text" if i % 2 else prose(i, 3)) for i in range(3000)]
    sizes, homes = check(shard(spark.createDataFrame(data, "doc_id long, text string"), 8), data, 8)
    assert max(sizes) < 1.03 * min(sizes) and len(homes["the same text"]) > 1


def test_borders_are_exact_counts(spark):
    df = spark.createDataFrame([(i, prose(i, 1 + i % 9)) for i in range(500)], "doc_id long, text string")
    narrow = keyed(df, "text", "doc_id").select("key", "tie", "size")
    rows = sorted((r["key"], r["tie"], r["size"]) for r in narrow.collect())
    total = sum(r[2] for r in rows)
    for i, cut in enumerate(borders(narrow, 4, 0.02), 1):
        below = sum(r[2] for r in rows if (r[0], r[1]) < (cut.key, cut.tie))
        assert abs(below - total * i / 4) <= max(0.02 * total / 4, max(r[2] for r in rows))


def test_odd_tables(odd_docs, no_docs, spark):
    out = shard(odd_docs, 4)
    check(out, odd_docs.collect(), 4)
    assert "lang" in out.columns and out.columns.count("size") == 1
    assert shard(no_docs).count() == 0
    one = spark.createDataFrame([(None, None)] * 5, "doc_id long, text string")
    check(shard(one, 3), [0] * 5, 3)
    with pytest.raises(ValueError):
        shard(no_docs, 0)
