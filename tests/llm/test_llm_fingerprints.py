import hashlib

import numpy as np
from llm_helpers import no_docs, odd_docs, prose  # noqa: F401

from tickloom.llm.fingerprints import edited_text, fingerprints, in_id_order, likeness, phrases, sketches
from tickloom.llm.words import mix


def named(text):
    data = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
    symbol, row = mix(data + np.uint64(1)), np.zeros(len(data), np.int64)
    for _ in range(2):
        symbol, row = phrases(symbol, row)
    return symbol.tolist()


def test_a_passage_has_the_same_names_at_any_place():
    passage = prose(1, 200)
    inner = None
    for shift in range(40):
        names = named("x" * 3 + "q" * shift + prose(2, 3)[:shift] + passage + prose(3, shift))
        inner = set(names) if inner is None else inner & set(names)
    assert len(inner) > 0.85 * len(set(named(passage)))


def test_runs_and_short_texts():
    for text in ("a", "aa", "a" * 10_000, "ab" * 5000, "abcabc", "\x00" * 9):
        assert 1 <= len(named(text)) <= max(1, len(text))


def test_likeness_follows_the_shared_part():
    texts = [prose(k, 400, 10 ** 5) for k in range(60)]
    own = sketches([t.encode() for t in texts])
    half = sketches([edited_text(t, texts[(k + 1) % 60]).encode() for k, t in enumerate(texts)])
    near = likeness(own, half)
    assert 0.27 < near.mean() < 0.40 and near.min() > 0.12
    assert likeness(own, np.roll(own, 1, 0)).max() < 0.15 and (likeness(own, own) == 1).all()


def plain_order(docs):
    return sorted(docs, key=lambda d: d[0])


def test_edited_texts_follow_the_order_of_ids(spark):
    docs = [((k * 37) % 1009, prose(k, k % 50) if k % 9 else None) for k in range(1009)] + [(2000, "Ünï日\U0001f600x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r for r in fingerprints(df).collect()}
    order = [(i, t or "") for i, t in plain_order(docs)]
    equal = {}
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        want = text[:len(text) - half] + following[:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), hashlib.sha256(want.encode()).hexdigest())
        assert equal.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        assert (got[i]["near_edited"] == 1) == (got[i]["fingerprint"] == got[i]["edited_fingerprint"])


def test_odd_tables(spark, odd_docs, no_docs):
    rows = fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r["n_chars"] for r in rows if r["doc_id"] in (3, 4)) == [0, 0]
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert fingerprints(no_docs).count() == 0
    one = fingerprints(spark.createDataFrame([("k", "only one")], "doc_id string, text string")).first()
    assert one["near_next"] == 1 and one["doc_id"] == "k"
    assert in_id_order(odd_docs, "doc_id", "text").where("after = 0").count() == odd_docs.count()


def test_sketches_equal_a_plain_parser():
    """The whole fingerprint by loops over Python numbers."""
    from tickloom.llm.fingerprints import _MULTIPLIERS, _STEP, SAMPLES
    whole, step = (1 << 64) - 1, int(_STEP)

    def mixed(x):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & whole
        return x ^ x >> 29

    def level(symbols):
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        names = [mixed(s + n * step & whole) if n > 1 else s for s, n in runs]
        label = names
        for turn in range(4):
            new = []
            for k, own in enumerate(label):
                differ = own ^ (label[k - 1] if k else own ^ 1) or 1
                low = differ & -differ
                new.append(2 * (low.bit_length() - 1) + bool(own & low))
            label = new
        starts = [k for k in range(len(label)) if k == 0 or (k < len(label) - 1 and label[k] > label[k - 1] and label[k] > label[k + 1])]
        out = []
        for a, b in zip(starts, [*starts[1:], len(names)]):
            out.append(mixed(sum(mixed(names[k] + (k - a + 1) * step & whole) for k in range(a, b)) + b - a & whole))
        return out

    def sketch(data):
        symbols = [mixed(byte + 1) for byte in data]
        for _ in range(2):
            symbols = level(symbols)
        seen, counted = {}, []
        for s in symbols:
            times = seen.get(s, 0)
            seen[s] = times + 1
            counted.append(mixed(s + times * step & whole) if times else s)
        out = []
        for factor in map(int, _MULTIPLIERS):
            hashed = [s * factor & whole for s in counted]
            least = min((h ^ h >> 31) * step & whole for h in hashed)
            out.append(mixed(least) % 255 + 1)
        return out

    texts = [t.encode() for t in (prose(1, 40), prose(2, 7), "a", "aaaa", "ab" * 30, "abcabcabc", "é ü 日本", " ", prose(3, 15) * 2)]
    got = sketches([b"", *texts])
    assert got[0].tolist() == [0] * SAMPLES
    for text, row in zip(texts, got[1:]):
        assert row.tolist() == sketch(text)
