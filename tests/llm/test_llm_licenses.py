import re

from llm_helpers import no_docs, odd_docs, prose  # noqa: F401
from tickloom.llm.license_texts import MIT, TEMPLATES
from tickloom.llm.licenses import scan_licenses


def plain(text):
    text = text or ""

    def pairs(part):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), part))
        return set(zip(words, words[1:]))
    hits = set()
    for part in {text, *text.split("\n"), *text.split("\n\n")}:
        a = pairs(part)
        for name, body in TEMPLATES:
            b = pairs(body)
            if a and 200 * len(a & b) >= 80 * (len(a) + len(b)):
                hits.add((-2 * len(a & b) / (len(a) + len(b)), name))
    best = min(hits, default=(None, None))
    return best[1], None if best[0] is None else -best[0], ",".join(sorted({n for _, n in hits}))


def test_against_a_plain_scan(spark):
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n * ", MIT.replace("\n", " "))
    texts = [MIT, "/*\n * " + wrapped + "\n */\n\nint main() {}", prose(1, 50) + "\nReleased under the MIT license.\n" + prose(2, 50), "Licensed under CC BY-NC 4.0.", "licensed under cc by 4.0",
             prose(3, 300) + "\n\n" + TEMPLATES[7][1] + "\n\n" + prose(4, 30), MIT[:400], TEMPLATES[4][1] + "\n\n" + TEMPLATES[9][1], "", None, "\n\n\n", "Licensed", prose(5, 20), "\nLicensed under CC0 1.0\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["dice"], r["licenses"]) for r in scan_licenses(df).collect()}
    assert [got[i] for i in range(len(texts))] == [plain(t) for t in texts]
    assert got[1][0] == "MIT" and got[2][0] == "MIT" and got[3][0] == "CC-BY-NC-4.0" and got[12][0] is None


def test_odd_tables(odd_docs, no_docs):
    rows = scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["license"] is None and r["licenses"] == "" for r in rows)
    assert scan_licenses(no_docs).count() == 0
    assert scan_licenses(odd_docs, templates=[]).where("license is not null").count() == 0


def runs(text, body):
    """The highest coefficient of any run of words."""
    def pairs(part):
        words = re.findall("[A-Za-z0-9]+", part.lower())
        return list(zip(words, words[1:]))
    found, template = pairs(text), set(pairs(body))
    windows = [set(found[i:j]) for i in range(len(found)) for j in range(i + 1, min(len(found), i + len(pairs(body)) * 120 // 80) + 1)]
    return max((2 * len(w & template) / (len(w) + len(template)) for w in windows), default=0)


def test_licences_of_several_paragraphs_between_prose(spark):
    at = {name: body for name, body in reversed(TEMPLATES) if len(body) > 400}
    cut = {"MIT": ["subject to the\nfollowing conditions: ", "copies or substantial portions of the\nSoftware. "],
           "BSD-2-Clause": ["conditions\nare met: ", "the following disclaimer.\n", "provided with the distribution. "],
           "GPL-3.0": ["any later version. ", "General Public License for more details. "], "Zlib": ["use of this software. ", "restrictions: ", "not required. "]}
    texts = []
    for name, ends in cut.items():
        body = at[name]
        for end in ends:
            assert end in body
            body = body.replace(end, end.strip() + "\n\n", 1)
        texts.append(prose(1, 200) + "\n\nCopyright (c) 2020 Somebody\n\n" + body + "\n\n" + prose(2, 200))
    got = [(r["license"], r["dice"]) for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [(name, 1.0) for name in cut]


def test_runs_against_all_windows(spark):
    short = [(name, body) for name, body in TEMPLATES if len(body) < 100]
    texts = ["This project is licensed under the MIT License - see the LICENSE file for details.", "it is licensed under the apache license version 2 0 or under the MIT license", "x " * 30 + "licensed under cc by nc 4 0 licensed under cc by 4 0",
             "under the MIT License under the MIT License is released under the MIT", "Licensed", "this work is licensed under the very GNU General Public License, version 3 of it", "under the MIT", "License and not more", "the MIT License the MIT License"]
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), templates=short).orderBy("doc_id").collect()
    for text, row in zip(texts, got):
        want = {}
        for name, body in short:
            want[name] = max(want.get(name, 0), runs(text, body))
        want = {name: d for name, d in want.items() if d >= 0.8}
        assert row["licenses"] == ",".join(sorted(want)) and row["dice"] == max(want.values(), default=None)
    assert got[0]["license"] == "MIT" and got[0]["dice"] == 1.0 and got[6]["license"] is None


def test_whole_texts_and_statements_of_usual_licences(spark):
    whole = {name: body for name, body in TEMPLATES if len(body) > 1000}
    texts = [(n, b) for n, b in whole.items() if n in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "Apache-2.0", "MPL-2.0", "Unlicense")]
    assert len(texts) == 7
    texts += [("Apache-2.0", "Available under the Apache License 2.0"), ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
              ("AGPL-3.0", "You may use it under the GNU Affero General Public License, version 3, only."), ("EPL-2.0", "made available under the Eclipse Public License 2.0.")]
    df = spark.createDataFrame([(i, prose(i, 30) + "\n\n" + body) for i, (_, body) in enumerate(texts)], "doc_id long, text string")
    rows = scan_licenses(df).orderBy("doc_id").collect()
    assert [r["license"] for r in rows] == [name for name, _ in texts]
    assert all(r["dice"] == 1.0 for r, (name, _) in zip(rows, texts) if name != "AGPL-3.0")
    line = spark.createDataFrame([(1, "This work is licensed under the GNU General Public License, version 3.")], "doc_id long, text string")
    assert scan_licenses(line).first()["licenses"] == "GPL-2.0,GPL-3.0"
