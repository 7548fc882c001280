"""Whole articles out of hand-made pages, and the labeller against plain loops."""

import numpy as np
import pytest

from tickloom.llm.blocks import blocks, vectors
from tickloom.llm.labeller import _backward, _forward, _slopes, _scores, is_main, is_main_long, main_blocks, made_pages, trained

MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact</a></li></ul></nav>'
FOOT = '<footer><p>&copy; 2024 Example. All rights reserved.</p><a href="/p">Privacy</a></footer>'
SIDE = '<aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">Another story</a></li><li><a href="/2">More of it</a></li></ul></aside>'
TALK = '<section class="comments"><h2>Comments</h2><div class="comment"><b>Jo</b><p>I do not agree.</p></div></section>'
ADVERT = '<div class="ad">Buy now!</div>'
COOKIES = '<div class="cookie-notice"><p>We use cookies.</p><button>Accept</button></div>'
TEXT = "<p>The river rose again in the night and the town woke to wet streets.</p><p>Nobody was hurt, the mayor said.</p>"


def page(main, before=MENU, after=FOOT):
    return f"<html><head><title>T</title></head><body>{before}{main}{after}</body></html>"


#: Pages and the blocks of their articles; what is not named here is no part of it.
CASES = {
    "paragraphs": (page(f"<article><h1>High water</h1>{TEXT}</article>"), 3),
    "table": (page(f"<article><h1>Levels</h1>{TEXT}<table><tr><th>Day</th><th>Metres</th></tr><tr><td>Monday</td><td>3.2</td></tr><tr><td>Tuesday</td><td>3.9</td></tr></table></article>"), 9),
    "table alone": (page("<article><table><tr><th>Name</th><th>Age</th></tr><tr><td>Ann</td><td>31</td></tr><tr><td>Bob</td><td>28</td></tr></table></article>"), 6),
    "list": (page(f"<article><h1>Packing</h1>{TEXT}<ul><li>Boots</li><li>A warm coat</li><li>Rope</li></ul></article>"), 6),
    "numbered list": (page("<main><h1>Soup</h1><ol><li>Cut the onions.</li><li>Boil the water.</li><li>Wait for an hour.</li></ol><p>Serve hot.</p></main>"), 5),
    "code": (page(f"<article><h1>Loops</h1>{TEXT}<pre><code>for i in range(3):\n  print(i)</code></pre><p>This prints three numbers.</p></article>"), 5),
    "definitions": (page("<article><h1>Terms</h1><dl><dt>Weir</dt><dd>A low dam across a river.</dd><dt>Quay</dt><dd>A place to land.</dd></dl></article>"), 5),
    "everything": (page("<article><h1>Rivers</h1><p>A short guide.</p><table><tr><th>River</th><th>Length</th></tr><tr><td>Rhine</td><td>1233</td></tr></table><ul><li>Boats</li><li>Fish</li></ul><pre>x = 1</pre></article>"), 9),
    "german": (page("<article><p>Der Fluss stieg in der Nacht wieder an, und die Stadt erwachte in nassen Straßen.</p><p>Verletzt wurde niemand, sagte die Bürgermeisterin.</p></article>"), 2),
    "french": (page("<article><h1>La crue</h1><p>La rivière est montée dans la nuit.</p><p>Personne n’a été blessé.</p></article>"), 3),
    "spanish": (page("<div class='content'><h1>La crecida</h1><p>El río volvió a subir por la noche.</p><p>Nadie resultó herido.</p></div>"), 3),
    "one word": ("<article><p>Ok.</p></article>", 1),
    "one line": ("Just one line of plain text", 1),
    "one paragraph": ("<html><body><p>Only this.</p></body></html>", 1),
    "two paragraphs": ("<p>The first of two.</p><p>And the second.</p>", 2),
    "advert inside": (page(f"<article><h1>High water</h1><p>The river rose.</p>{ADVERT}<p>Nobody was hurt.</p></article>"), 3),
    "sidebar": (page(f"<article><h1>High water</h1>{TEXT}</article>{SIDE}"), 3),
    "comments": (page(f"<article><h1>High water</h1>{TEXT}</article>{TALK}"), 3),
    "cookies": (page(f"<article><h1>High water</h1>{TEXT}</article>", before=COOKIES + MENU), 3),
    "all parts": (page(f"<article><h1>High water</h1>{TEXT}<ul><li>One bridge is shut.</li><li>Two roads are closed.</li></ul></article>{TALK}{SIDE}", before=COOKIES + MENU + ADVERT), 5),
    "quote": (page(f"<article><h1>High water</h1>{TEXT}<blockquote>We have seen worse.</blockquote><p>That was in 1953.</p></article>"), 5),
    "subheadings": (page("<article><h1>Guide</h1><h2>Before</h2><p>Read it all.</p><h2>After</h2><p>Read it again.</p></article>"), 5),
    "utility classes": (page(f'<div class="flex items-center justify-between p-4 mt-2 bg-white shadow rounded article">{TEXT}</div><div class="flex items-center justify-between p-4 mt-2 bg-white shadow rounded comments"><p>I do not agree.</p></div>'), 2),
}


def article(html, count):
    """The blocks of the article: the first `count` blocks that stand in no other part."""
    other = {"nav", "footer", "aside", "comments", "ad", "cookie"}
    return [not (other & set(b.path)) for b in blocks(html)]


@pytest.mark.parametrize("name", CASES)
def test_whole_articles(name):
    html, count = CASES[name]
    want = article(html, count)
    assert sum(want) == count
    assert main_blocks(trained(), [blocks(html)])[0].tolist() == want


def test_long_pages_in_stretches():
    found = [p for p in (blocks(f"<article>{TEXT}</article>" * 9 + MENU + FOOT), blocks("<p>a" * 50))]
    for p in found:
        whole = is_main(trained(), [vectors(p)])[0]
        assert all(np.array_equal(is_main_long(trained(), p, stretch), whole) for stretch in (1, 7, 1000))
    assert [len(x) for x in main_blocks(trained(), [found[0], [], found[1]])] == [len(found[0]), 0, 50]


def test_forward_equals_a_plain_loop():
    draw = np.random.default_rng(1)
    size, x = 3, draw.normal(size=(5, 4))
    w, u, b = draw.normal(size=(4, 12)), draw.normal(size=(3, 12)), draw.normal(size=12)
    h, c = np.zeros(size), np.zeros(size)
    got = _forward(x[None], np.ones((1, 5)), w, u, b, training=False)[0][0]
    for t in range(5):
        z = x[t] @ w + h @ u + b
        i, f, o = (1 / (1 + np.exp(-z[k * size:(k + 1) * size])) for k in range(3))
        c = f * c + i * np.tanh(z[9:])
        h = o * np.tanh(c)
        assert np.allclose(got[t], h, atol=1e-5)


def test_slopes_equal_differences():
    draw = np.random.default_rng(2)
    shapes = [(4, 12), (3, 12), (12,)] * 2 + [(6, 1), (1,)]
    weights = [draw.normal(0, 0.5, s) for s in shapes]
    x, mask = draw.normal(size=(2, 5, 4)), np.array([[1.0] * 5, [1, 1, 1, 0, 0]])
    turn, label = np.array([[4, 3, 2, 1, 0], [2, 1, 0, 3, 4]]), (draw.random((2, 5)) > 0.5) * mask

    def loss():
        z = _scores(weights, x, mask, turn)[0]
        return float(((np.log1p(np.exp(z)) - label * z) * mask).sum() / mask.sum())

    slopes = _slopes(weights, x, mask, turn, label)
    for k, w in enumerate(weights):
        for at in list(np.ndindex(w.shape))[::5]:
            kept, values = w[at], []
            for shift in (1e-3, -1e-3):
                w[at] = kept + shift
                values.append(loss())
            w[at] = kept
            assert abs((values[0] - values[1]) / 2e-3 - np.reshape(slopes[k], w.shape)[at]) < 2e-3


def test_made_up_pages_have_all_kinds():
    assert _backward and sum(len(p) == 1 for p, _ in made_pages(100, 5)) > 2
