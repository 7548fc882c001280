import html

import numpy as np
import pytest

from tickloom.llm.blocks import blocks, vectors
from tickloom.llm.labeller import is_main, made_pages, trained
from tickloom.llm.pages import main_text


def test_blocks_decode_and_join_white_space():
    page = "<p>a &amp; b&nbsp;\n c<b> d</b>e<p>next<br>line &lt;p&gt;<!-- <p>no --><script>if (a < b) '</p>'</script><div class='x-y Z' id=q>in <a href='>'>link</a></div>tail &copy"
    got = blocks(page)
    assert [b.text for b in got] == ["a & b c de", "next", "line <p>", "in link", "tail ©"]
    assert got[3].path == ("div", "x", "y", "z", "q") and got[3].linked == 4 and got[4].path == ()


@pytest.mark.parametrize("page", ["", None, "<", "<p", "</p></div>", "<script>never ends", "<!-- never ends", "a<b", "<a" * 50, "<p>" * 3000, "&#0; &#xZ; &bogus;", "\x00<p>\x00"])
def test_broken_pages(page):
    got = blocks(page)
    assert vectors(got).shape[0] == len(got) and all(b.text for b in got)


def test_held_out_made_up_pages():
    held_out = made_pages(150, 4242)
    out = is_main(trained(), [p for p, _ in held_out])
    label = np.concatenate([y for _, y in held_out]) > 0
    got = np.concatenate(out)
    assert (got == label).mean() > 0.97 and got[label].mean() > 0.97 and label[got].mean() > 0.96


def test_padding_does_not_change_a_page():
    pages = [p for p, _ in made_pages(20, 7)]
    alone = [is_main(trained(), [p])[0] for p in pages]
    assert all(np.array_equal(a, b) for a, b in zip(alone, is_main(trained(), pages)))


PAGE = """<html><head><title>T</title><style>p {{}}</style></head><body><header class="site-header"><a href="/">Logo</a></header><nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu
two</a></li></ul></nav><div class="cookie-notice"><p>We use cookies.</p></div><article><h1>{title}</h1>{body}<div class="ad">Buy now</div></article><section class="comments"><h2>Comments</h2><div
class="comment"><p>I disagree with all of it.</p></div></section><aside class="sidebar"><h3>Related</h3><ul><li><a href="/c">Other story</a></li></ul></aside><form><label>Email</label><button>Send</button></form><footer>&copy; 2024 Us</footer></body></html>"""


def test_main_text_of_pages(spark):
    paragraphs = ["First paragraph of the story, with a &amp; b.", "Second one goes on   for\na while.", "Third."]
    page = PAGE.format(title="A long day", body="".join(f"<p>{p}</p>" for p in paragraphs))
    want = "\n".join(["A long day"] + [html.unescape(" ".join(p.split())) for p in paragraphs])
    df = spark.createDataFrame([(1, "u", page, "own"), (1, "u", page, "own"), (2, None, None, None), (3, "v", "", ""), (None, "w", "plain words", "")], "page_id long, url string, html string, text string")
    rows = main_text(df).collect()
    assert [r["text"] for r in rows if r["page_id"] == 1] == [want] * 2
    assert all(r["n_chars"] == len(r["text"]) for r in rows) and [r["text"] for r in rows if r["page_id"] in (2, 3)] == ["", ""]
    assert main_text(df.limit(0)).count() == 0 and "html" not in main_text(df).columns


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wrong = 0
    for r in main_text(df, keep=["page_id", "html"]).collect():
        article = r["html"][r["html"].index("<article"):r["html"].index("<footer")]
        wrong += r["text"] != "\n".join(b.text for b in blocks(article))
    assert wrong <= 0.01 * df.count()
