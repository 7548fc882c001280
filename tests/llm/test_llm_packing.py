import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import SF, TOKENIZER, no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from tickloom.llm.packing import Bins, Encoder, pack, sequences
from tickloom.llm.words import texts


def plainly(special_as_text=False):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    if special_as_text:
        tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def plain():
    return plainly()


def check(pieces, docs, plain, capacity):
    """Each id in one piece, sequences gapless and within capacity. Returns padding over ids."""
    by = {}
    for p in pieces:
        by.setdefault(p["doc_id"], []).append(p)
    for i, text in docs.items():
        ids, at = plain(text), 0
        for p in sorted(by.pop(i), key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(np.array(ids[at:at + p["length"]], "<u4").tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids)
    assert not by
    used = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == used.get(p["sequence_id"], 0) and p["length"] > 0
        used[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(used.values()) <= capacity
    return sum(0 if u & (u - 1) == 0 else capacity - u for u in used.values()) / sum(used.values())


@pytest.mark.parametrize("special_as_text", [False, True])
def test_encoder_gives_the_ids_of_the_tokenizer(special_as_text):
    plain = plainly(special_as_text)
    assert (plain("hello <|endoftext|> world")[:-1] == [3306, 49407, 1002]) != special_as_text
    draw = random.Random(3)
    signs = list("abcXYZ  \n\n\t.,'#!1é9ßÜ×÷ñ") + ["'s", "'re", "\u0301", "α", "J", "\u030c", "\u00a0", "日", "\x00", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "text|>", "ª", "İ", "\u2028"]
    made = ["".join(draw.choice(signs) for _ in range(draw.randrange(60))) for _ in range(3000)] + [None, ""]
    for cached in (1_000_000, 500):
        encoder = Encoder(TOKENIZER, cached, special_as_text)
        for at in range(0, len(made), 700):
            ids, until = encoder.encode(*texts(pa.array(made[at:at + 700], pa.string())))
            for k, text in enumerate(made[at:at + 700]):
                assert ids[until[k]:until[k + 1]].tolist() == plain(text)[:-1]


def test_documents(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = pack(docs, TOKENIZER).collect()
    assert check(pieces, {r["doc_id"]: r["text"] for r in docs.collect()}, plain, 4096) < 0.01
    assert len(pieces) < 3 * docs.count()


@pytest.mark.parametrize("capacity, classes", [(8, 2), (64, 16), (64, 1), (4096, 16)])
def test_small_capacities_and_many_tasks(spark, plain, capacity, classes):
    texts_ = {i: " ".join(["word"] * (i * 7 % 90)) for i in range(150)}
    docs = spark.createDataFrame(list(texts_.items()), "doc_id long, text string").repartition(3)
    packed = pack(docs, TOKENIZER, capacity=capacity, classes=classes, with_ids=True)
    check(packed.collect(), texts_, plain, capacity)
    whole = sequences(packed, capacity).collect()
    assert all(len(r["tokens"]) == (r["used"] if r["used"] & (r["used"] - 1) == 0 else capacity) for r in whole)
    assert sum(r["used"] for r in whole) == sum(len(plain(t)) for t in texts_.values())


def test_bins_hold_a_fixed_number_of_documents():
    bins = Bins(0, 64, 16, 64)
    for i in range(8):
        bins.add(i, np.arange(16))       # a quarter each
    assert [(p[0], p[5], p[6]) for p in bins.out] == [(i, i // 4, 16 * (i % 4)) for i in range(8)]


def test_odd_tables(odd_docs, no_docs, plain):
    pieces = pack(odd_docs, TOKENIZER).collect()
    assert sum(p["length"] for p in pieces) == sum(len(plain(r["text"])) for r in odd_docs.collect())
    assert sorted(p["doc_tokens"] for p in pieces if p["doc_id"] in (3, 4, 5)) == [1, 1, 1]
    assert pack(no_docs, TOKENIZER).count() == 0
    with pytest.raises(ValueError):
        pack(no_docs, TOKENIZER, capacity=0)
