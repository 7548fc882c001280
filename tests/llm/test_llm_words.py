import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import words as w

TEXT = st.text(st.sampled_from("aAbZ09 \n\t.,-éÀß日\x00\x7f\x0b"), max_size=60)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    for table, pattern in ((w.SPACE, "[^\x20\x09-\x0d]+"), (w.NOT_ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        got = []
        for at, to, found in w.word_groups(column, table):
            for row in range(to - at):
                inside = range(found.first[row], found.first[row + 1])
                got.append([found.data[found.start[k]:found.end[k]].tobytes().decode() for k in inside])
        assert got == [re.findall(pattern, lower(t or "")) for t in texts]


def test_numbers_tell_words_apart_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(w, "BLOCK", 64)
    text = " ".join(f"word{i % 50}" for i in range(500)) + " " + "x" * 300 + " word7"
    found = w.words(*w.texts(pa.array([text])), w.SPACE)
    by = {}
    for word, number in zip(text.split(), found.number.tolist()):
        assert by.setdefault(word, number) == number
    assert len(set(by.values())) == len(by) == 51


def test_sliced_columns_and_groups(monkeypatch):
    monkeypatch.setattr(w, "GROUP", 10)
    column = pa.array(["zz", "a b", None, "c" * 30, "d e f"]).slice(1)
    rows = [(at, to, len(f.number)) for at, to, f in w.word_groups(column, w.SPACE)]
    assert [r[0] for r in rows] == [0] + [r[1] for r in rows[:-1]] and rows[-1][1] == 4
    assert sum(r[2] for r in rows) == 6


def test_shingles():
    def of(text):
        return w.shingles(w.words(*w.texts(pa.array([text])), w.SPACE).number)
    assert len(of("")) == 0 and len(of("a b")) == 1 and len(of("a b c d e")) == 1 and len(of("a b c d e f")) == 2
    assert len(of("a b " * 10)) == 2
    assert of("a b")[0] != of("b a")[0]
    assert np.array_equal(of("A B c"), of("a  b\nC"))
