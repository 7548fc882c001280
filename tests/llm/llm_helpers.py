import random

import pytest

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
SF = "/root/testdata/sf0.01"


def prose(seed, words, vocabulary=300):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}{'abc'[draw.randrange(3)]}" for _ in range(words))


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long text, repeated rows, ids that are null or occur twice, and columns
    named like those that operators add."""
    long = " ".join(f"long{i % 977} text{i % 31}" for i in range(60_000))
    same = prose(1, 60)
    data = [(1, same), (1, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (6, long), (None, same), (None, None), (7, prose(2, 40)), (7, prose(3, 50)),
            (8, "x"), (9, "Ünïcode ÄÖ ’ 日本語 \U0001f600 e\u0301 \x00 end"), (10, "a" * 5000), (11, "ab " * 3000)]
    extra = "score double, size string, host string, shard string, n_words string, license string, n_values string, predicted string, start string"
    rows = [(i, t, "en", None, 0.5, *["own"] * 8) for i, t in data]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {extra}")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
