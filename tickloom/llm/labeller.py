"""A recurrent block labeller: a bidirectional LSTM in numpy that reads the vectors of a page's blocks in both
directions, so that each block is judged knowing the whole page. It is trained on pages that are
made up here, from many layouts of main text, menus, headers, footers, sidebars, notices, adverts, forms and
comments, with words without meaning; training is repeatable."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from tickloom.llm.blocks import VECTOR, Block, blocks, vectors

HIDDEN = 24
PAGES = 3000             # made-up pages the labeller is trained on
EPOCHS = 4
BATCH = 32
RATE = 0.004
STRETCH = 4096           # blocks whose vectors are held at a time

_MARK = ""         # begins the main blocks of a made-up page

#: Elements that hold each part of a page, as tag and attribute, and words that are typical of it.
HOLDERS = {
    "main": ["article", "main", 'div class="content"', 'div id="content"', 'div class="post-body"', 'section class="story"', 'div class="entry-content"',
             'div class="article-body"', 'div class="article"', 'div class="post"', 'div id="main"', 'div class="text"', 'article class="post"'],
    "menu": ["nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="breadcrumbs"', 'nav class="main-nav"', 'div class="navbar"', 'div role="navigation"'],
    "header": ["header", 'div class="header"', 'div id="masthead"', 'div class="top-bar"', 'header class="site-header"', 'div id="header"', 'div class="logo"'],
    "footer": ["footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"', 'footer class="site-footer"', 'div class="legal"'],
    "sidebar": ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', 'section class="related-posts"', 'aside class="side"', 'div class="recommended"'],
    "notice": ['div class="cookie"', 'div class="notice"', 'div class="banner"', 'div class="alert"', 'div id="consent"', 'section class="newsletter"', 'div class="cookie-notice"', 'div class="popup"', 'div class="subscribe"', 'div role="alert"'],
    "advert": ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="sponsored"', 'div id="ad-top"', 'div class="promo"', 'aside class="ad"', 'div class="advertisement"', 'section class="sponsor"'],
    "form": ["form", 'div class="form"', 'form class="search"', 'div class="login"', 'form id="signup"', 'form class="contact-form"'],
    "comments": ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"', 'div class="responses"', 'section id="discussion"', 'div class="comments-area"', 'ul class="comments"'],
}
TYPICAL = {
    "menu": "Home News Sport About Contact Login Archive Search Help Blog Shop Topics".split(),
    "header": "Home Search Login Daily Subscribe Menu".split(),
    "footer": "© Copyright Privacy Terms Imprint Contact rights reserved 2024 policy".split(),
    "sidebar": "Related Popular Read more Latest Trending posts Tags Follow".split(),
    "notice": "We use cookies Accept Subscribe newsletter privacy consent OK close browser sign up".split(),
    "advert": "Advertisement Sponsored Buy now Sale offer % free Ad click".split(),
    "form": "Name Email Send Search Password Submit Your message Sign in".split(),
    "comments": "Reply comment says wrote ago Like Report comments posted thanks".split(),
}

LOOKS = "flex grid block row col col-6 items-center justify-between p-2 p-4 mt-2 mb-4 mx-auto bg-white bg-gray text-sm text-lg shadow rounded border w-full container clearfix left right wide".split()


class _Maker:
    """Made-up pages."""

    def __init__(self, seed: int):
        self.draw = np.random.default_rng(seed)
        self.syllables = [a + b for a in "b c d f g h k l m n p r s t v w th sh".split() for b in "a e i o u an er in on é ü".split()]

    def some(self, values):
        return values[int(self.draw.integers(len(values)))]

    def chance(self, share: float) -> bool:
        return self.draw.random() < share

    def words(self, low: int, high: int, kind: str | None = None) -> str:
        out = []
        for _ in range(int(self.draw.integers(low, high + 1))):
            out.append(self.some(TYPICAL[kind]) if kind and self.chance(0.5) else "".join(self.some(self.syllables) for _ in range(int(self.draw.integers(1, 4)))))
        text = " ".join(out)
        return text[:1].upper() + text[1:]

    def sentences(self, low: int, high: int, kind: str | None = None) -> str:
        return " ".join(self.words(1, 16, kind) + self.some([".", ".", ".", "!", "?", ",."]) for _ in range(int(self.draw.integers(low, high + 1))))

    def inside(self, holder: str, content: str) -> str:
        if self.chance(0.4):            # names of looks, which say nothing of the part
            looks = " ".join(self.some(LOOKS) for _ in range(int(self.draw.integers(2, 9))))
            holder = holder.replace('class="', f'class="{looks} ') if "class=" in holder else f'{holder} class="{looks}"'
        return f"<{holder}>{content}</{holder.split()[0]}>"

    def part(self, kind: str) -> str:
        typical = kind if self.chance(0.6) else None
        if kind in ("menu", "sidebar", "header") and self.chance(0.75):
            items = "".join(f'<li><a href="/x">{self.words(1, 3, typical)}</a></li>' for _ in range(int(self.draw.integers(2, 9))))
            content = (f"<h3>{self.words(1, 3, typical)}</h3>" if self.chance(0.3) else "") + f"<ul>{items}</ul>"
        elif kind == "form":
            content = "".join(self.some([f"<label>{self.words(1, 2, kind)}</label><input>", f"<button>{self.words(1, 2, kind)}</button>", f"<p>{self.words(2, 8, kind)}</p>", "<select><option>A</option><option>B</option></select>"])
                              for _ in range(int(self.draw.integers(1, 5))))
        elif kind == "comments":
            content = (f"<h2>{self.words(1, 3, kind)}</h2>" if self.chance(0.6) else "") + "".join(
                self.inside(self.some(['div class="comment"', "li", "div", "article", 'div class="reply"']), self.some(["<p>{}</p>", "<b>{}</b>", "{}", "<h4>{}</h4>"]).format(self.words(1, 4, kind)) * self.chance(0.6) + f"<p>{self.sentences(1, 4, typical)}</p>")
                for _ in range(int(self.draw.integers(1, 6))))
        elif kind == "footer" and self.chance(0.6):
            content = f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2, typical)}"
        else:
            content = self.some(["{}", "<p>{}</p>", "<span>{}</span>", "<div>{}</div>"]).format(self.sentences(1, 3, typical))
        return self.inside(self.some(HOLDERS[kind]), content)

    def main(self) -> str:
        out = [f"<h1>{_MARK}{self.words(2, 14)}</h1>"] if self.chance(0.9) else []
        if out and self.chance(0.2):
            out = [f"<header>{out[0]}</header>"]
        for _ in range(int(self.draw.integers(1, 16))):
            if self.chance(0.12):
                out.append(self.several())
                continue
            text = _MARK + self.some([self.sentences(1, 8), self.sentences(1, 8), self.sentences(1, 1), self.words(1, 3) + self.some(["", "."]),
                                      " ".join([self.words(1, 1)] * int(self.draw.integers(1, 40)))][:int(self.draw.choice([2, 4, 5], p=[0.5, 0.3, 0.2]))])
            out.append(self.some(["<p>{}</p>"] * 8 + ["<p><b>{}<br>", "<p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<pre>{}</pre>", "<figcaption>{}</figcaption>", "<p><a href='/x'>{}</a></p>"]).format(text))
            if self.chance(0.04):
                out.append(self.part(self.some(["advert", "notice", "sidebar", "form"])))
        if self.chance(0.12):
            out.append(self.part("comments"))
        return "".join(out)

    def several(self) -> str:
        """Lists, tables and definitions of an article, of short or long entries."""
        def entry():
            text = _MARK + self.some([self.words(1, 3), self.words(1, 1), self.words(2, 8), self.sentences(1, 2), str(int(self.draw.integers(0, 9999))), self.words(1, 2) + " " + str(int(self.draw.integers(0, 99)))])
            return f"<a href='/x'>{text}</a>" if self.chance(0.08) else text

        kind, rows = self.some(["ul", "ol", "table", "table", "dl", "pre"]), int(self.draw.integers(1, 8))
        if kind in ("ul", "ol"):
            return self.inside(kind, "".join(f"<li>{entry()}</li>" for _ in range(rows)))
        if kind == "dl":
            return "<dl>" + "".join(f"<dt>{entry()}</dt><dd>{entry()}</dd>" for _ in range(rows)) + "</dl>"
        if kind == "pre":
            return self.inside("pre", self.inside("code", _MARK + "\n".join(f"{self.words(1, 2).lower()} = {self.words(1, 1).lower()}({k});" for k in range(rows))))
        across = int(self.draw.integers(2, 5))
        head = "<tr>" + "".join(f"<th>{entry()}</th>" for _ in range(across)) + "</tr>" if self.chance(0.7) else ""
        body = "".join("<tr>" + "".join(f"<td>{entry()}</td>" for _ in range(across)) + "</tr>" for _ in range(rows))
        return (f"<table><thead>{head}</thead><tbody>{body}</tbody></table>" if self.chance(0.4) else f"<table>{head}{body}</table>") if not self.chance(0.1) else f"<figure><table>{head}{body}</table></figure>"

    def bare(self) -> str:
        """A page that is little more than its text."""
        text = _MARK + self.some([self.words(1, 3) + ".", self.sentences(1, 1), self.sentences(1, 6), self.words(1, 4)])
        content = self.some(["{}", "<p>{}</p>", "<p>{}</p>", "<article><p>{}</p></article>", "<div>{}</div>", "<main>{}</main>", "<h1>{}</h1>", "<pre>{}</pre>"]).format(text)
        more = "".join(f"<p>{_MARK}{self.sentences(1, 4)}</p>" for _ in range(int(self.draw.integers(0, 4)))) if self.chance(0.5) else ""
        return self.some(["{}", "<html><body>{}</body></html>", "<html><head><title>T</title></head><body>{}</body></html>"]).format(content + more)

    def page(self) -> str:
        if self.chance(0.12):
            return self.bare()
        top = [k for k, share in (("notice", 0.25), ("header", 0.4), ("menu", 0.85), ("advert", 0.4), ("form", 0.15)) if self.chance(share)]
        low = [k for k, share in (("advert", 0.2), ("sidebar", 0.35), ("comments", 0.35), ("form", 0.2), ("notice", 0.15), ("footer", 0.85)) if self.chance(share)]
        if self.chance(0.2):
            low.insert(0, top.pop(int(self.draw.integers(len(top))))) if top else None
        main = self.main()
        for _ in range(int(self.draw.integers(0, 3)) if self.chance(0.9) else 0):
            main = self.inside(self.some(HOLDERS["main"]), main)
        body = "".join(map(self.part, top)) + main + "".join(map(self.part, low))
        if self.chance(0.3):
            body = self.inside(self.some(["div", 'div id="page"', 'div class="wrapper"']), body)
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x.clip(-30, 30)))


def _forward(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, state=None, training: bool = True):
    """One direction of the LSTM over padded sequences: outputs, and what the way back needs in training, else the last state, from
    which a later stretch goes on."""
    n, steps, _ = x.shape
    size = u.shape[0]
    given = x @ w + b
    h, c = state or (np.zeros((n, size), np.float32), np.zeros((n, size), np.float32))
    out, kept = np.zeros((n, steps, size), np.float32), []
    for t in range(steps):
        gates = given[:, t] + h @ u
        i, f, o = (_sigmoid(gates[:, k * size:(k + 1) * size]) for k in range(3))
        g = np.tanh(gates[:, 3 * size:])
        now, m = f * c + i * g, mask[:, t, None]
        squeezed = np.tanh(now)
        if training:
            kept.append((h, c, i, f, o, g, squeezed))
        c = m * now + (1 - m) * c
        h = m * o * squeezed + (1 - m) * h
        out[:, t] = h
    return out, kept if training else (h, c)


def _backward(x: np.ndarray, mask: np.ndarray, u: np.ndarray, kept: list, slope: np.ndarray):
    """Slopes of the weights of one direction from those of its outputs."""
    n, steps, _ = x.shape
    size = u.shape[0]
    of_gates = np.zeros((n, steps, 4 * size), np.float32)
    du = np.zeros_like(u)
    dh, dc = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
    for t in reversed(range(steps)):
        h, c, i, f, o, g, squeezed = kept[t]
        m = mask[:, t, None]
        dh = dh + slope[:, t]
        dnow = m * (dc + dh * o * (1 - squeezed ** 2))
        d = np.concatenate([dnow * g * i * (1 - i), dnow * c * f * (1 - f), m * dh * squeezed * o * (1 - o), dnow * i * (1 - g ** 2)], axis=1)
        of_gates[:, t] = d
        du += h.T @ d
        dh, dc = (1 - m) * dh + d @ u.T, dnow * f + (1 - m) * dc
    flat = of_gates.reshape(-1, 4 * size)
    return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pages as one array, the mask of its blocks, and for each page the order that turns it round."""
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), steps, VECTOR), np.float32), np.zeros((len(pages), steps), np.float32)
    turn = np.tile(np.arange(steps), (len(pages), 1))
    for k, p in enumerate(pages):
        x[k, :len(p)], mask[k, :len(p)] = p, 1
        turn[k, :len(p)] = np.arange(len(p))[::-1]
    return x, mask, turn


def _turned(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return np.take_along_axis(x, turn[:, :, None], axis=1)


def _scores(weights: list[np.ndarray], x: np.ndarray, mask: np.ndarray, turn: np.ndarray, training: bool = True):
    there, kept_there = _forward(x, mask, *weights[0:3], training=training)
    back_x = _turned(x, turn)
    back, kept_back = _forward(back_x, mask, *weights[3:6], training=training)
    both = np.concatenate([there, _turned(back, turn)], axis=2)
    return (both @ weights[6] + weights[7])[:, :, 0], both, (kept_there, back_x, kept_back)


def _slopes(weights: list[np.ndarray], x, mask, turn, label):
    z, both, (kept_there, back_x, kept_back) = _scores(weights, x, mask, turn)
    dz = (_sigmoid(z) - label) * mask / mask.sum()
    dboth = dz[:, :, None] * weights[6][:, 0]
    size = weights[1].shape[0]
    there = _backward(x, mask, weights[1], kept_there, dboth[:, :, :size])
    back = _backward(back_x, mask, weights[4], kept_back, _turned(dboth[:, :, size:], turn))
    return [*there, *back, both.reshape(-1, 2 * size).T @ dz.reshape(-1, 1), dz.sum().reshape(1)]


def made_pages(count: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of made-up pages."""
    maker, out = _Maker(seed), []
    for _ in range(count):
        page = blocks(maker.page())
        label = np.array([b.text.startswith(_MARK) for b in page], np.float32)
        page = [b._replace(text=b.text.replace(_MARK, "")) for b in page]
        if page and all(b.text for b in page):
            out.append((vectors(page), label))
    return out


@lru_cache(4)
def trained(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, ...]:
    """The weights of the labeller, trained once in a process by Adam."""
    draw = np.random.default_rng(seed)
    made = sorted(made_pages(pages, seed), key=lambda p: len(p[0]))
    shape = [(VECTOR, 4 * HIDDEN), (HIDDEN, 4 * HIDDEN), (4 * HIDDEN,)] * 2 + [(2 * HIDDEN, 1), (1,)]
    weights = [(draw.normal(0, 0.15, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in shape]
    for k in (2, 5):
        weights[k][HIDDEN:2 * HIDDEN] = 1            # remember at first
    mean, spread, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    batches = [made[i:i + BATCH] for i in range(0, len(made), BATCH)]
    for epoch in range(epochs):
        for b in draw.permutation(len(batches)):
            x, mask, turn = _padded([p for p, _ in batches[b]])
            label = np.zeros(mask.shape, np.float32)
            for k, (_, y) in enumerate(batches[b]):
                label[k, :len(y)] = y
            if epoch:
                x = x * (draw.random(x.shape) > 0.05)       # parts of the path may be missing on other pages
            step += 1
            for k, slope in enumerate(_slopes(weights, x.astype(np.float32), mask, turn, label)):
                slope = np.clip(slope, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                spread[k] = 0.99 * spread[k] + 0.01 * slope ** 2
                weights[k] = (weights[k] - RATE * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(spread[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return tuple(weights)


def is_main(weights: tuple[np.ndarray, ...], pages: list[np.ndarray]) -> list[np.ndarray]:
    """For every page, which of its blocks are main text. Pages of like length are read together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to - at + 1) * len(pages[order[to]]) <= 4096:
            to += 1
        x, mask, turn = _padded([pages[k] for k in order[at:to]])
        z = _scores(list(weights), x, mask, turn, training=False)[0]
        for row, k in enumerate(order[at:to]):
            out[k] = z[row, :len(pages[k])] > 0
        at = to
    return out


def is_main_long(weights: tuple[np.ndarray, ...], page: list[Block], stretch: int = STRETCH) -> np.ndarray:
    """The same for one long page, whose vectors are made stretch by stretch, once for each direction. Only the outputs of the first
    direction are held for all blocks."""
    size = weights[1].shape[0]
    there, z = np.zeros((len(page), size), np.float32), np.zeros(len(page), np.float32)
    starts, state = range(0, len(page), stretch), None
    for low in starts:
        x = vectors(page, low, min(low + stretch, len(page)))[None]
        out, state = _forward(x, np.ones(x.shape[:2], np.float32), *weights[0:3], state, training=False)
        there[low:low + stretch] = out[0]
    state = None
    for low in reversed(starts):
        x = vectors(page, low, min(low + stretch, len(page)))[None, ::-1]
        out, state = _forward(x, np.ones(x.shape[:2], np.float32), *weights[3:6], state, training=False)
        z[low:low + stretch] = (np.hstack([there[low:low + stretch], out[0, ::-1]]) @ weights[6] + weights[7])[:, 0]
    return z > 0


def main_blocks(weights: tuple[np.ndarray, ...], pages: list[list[Block]]) -> list[np.ndarray]:
    """For every page, which of its blocks are main text, with bounded memory: pages are read in lots of STRETCH blocks, longer ones alone."""
    out: list[np.ndarray] = []
    lot: list[list[Block]] = []
    for page in [*pages, None]:
        if page is None or len(page) > STRETCH or sum(map(len, lot)) + len(page) > STRETCH:
            out += is_main(weights, [vectors(p) for p in lot])
            lot = []
        if page is not None and len(page) > STRETCH:
            out.append(is_main_long(weights, page))
        elif page is not None:
            lot.append(page)
    return out
