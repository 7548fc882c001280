"""Raw pages as sequences of text blocks, and the vector of each block."""

from __future__ import annotations

import html
import math
import re
import zlib
from typing import NamedTuple

import numpy as np

#: Elements that stand inside a line of text, that have no end, and whose content is no text.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
             "strong sub sup time tt u var wbr".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "noframes", "xmp"}

PATH_SIZE, WORD_SIZE, OTHER = 256, 64, 8
VECTOR = PATH_SIZE + WORD_SIZE + OTHER

_MARKUP = re.compile(r"""<(?:!--(?:>|.*?(?:-->|\Z))|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+(?:>|\Z)|[^>]*(?:>|\Z)))""", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    path: tuple[str, ...]    # tags and names of the elements around it, from the outside
    text: str                # decoded, one space between words
    linked: int              # characters inside links


def blocks(page: str | None) -> list[Block]:
    """The texts between block elements in page order; what is inside scripts, styles and the like is none."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0

    def flush():
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(Block(tuple(name for _, names in stack for name in names), text, min(linked, len(text))))
        parts.clear()
        linked = 0

    page = page or ""
    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        text = page[at:found.start() if found else len(page)]
        parts.append(text)
        linked += len(text.strip()) if links else 0
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag == "a":
            links = max(0, links - 1) if found[1] else links + 1
        if tag in INLINE:
            continue
        flush()
        if found[1]:
            if any(tag == open_ for open_, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            links = 0
        elif tag in NO_TEXT:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
        elif tag not in EMPTY:
            if stack and stack[-1][0] in ("p", "li", "dt", "dd", "td", "th", "tr", "option") and (stack[-1][0] == "p" or stack[-1][0] == tag):
                stack.pop()          # its end tag was left out
            names = [tag]
            for _, value in _NAMES.findall(found[3]):
                names += _TOKEN.findall(value.lower())
            stack.append((tag, tuple(names)))
    flush()
    return out


class _Slots(dict):
    """The slot of every token, remembered; bounded."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, token: str) -> int:
        if len(self) > 1 << 17:
            self.clear()
        self[token] = slot = zlib.crc32(token.encode()) % self.size
        return slot


_PATH_SLOT, _WORD_SLOT = _Slots(PATH_SIZE), _Slots(WORD_SIZE)
_WORD = re.compile(r"\w+|[©%]")
_END = re.compile(r"[.!?]")


def vectors(page: list[Block], low: int = 0, high: int | None = None) -> np.ndarray:
    """A row for each block, or those of a stretch: hashed tag path, hashed words, and numbers of size, links, signs and place."""
    high = len(page) if high is None else high
    out = np.zeros((high - low, VECTOR), np.float32)
    for i, block in enumerate(page[low:high], low):
        row = out[i - low]
        names = [_PATH_SLOT[name] for name in block.path]
        if block.path:
            names.append(_PATH_SLOT["in " + block.path[-1]])
        row[names] = 1
        words = _WORD.findall(block.text.lower())
        row[PATH_SIZE:PATH_SIZE + WORD_SIZE] = np.log1p(np.bincount([_WORD_SLOT[w] for w in words] or [0], minlength=WORD_SIZE)) / 2 if words else 0
        size = len(block.text)
        row[-OTHER:] = (math.log1p(len(words)) / 4, block.linked / size, block.text[-1] in ".!?\"'", math.log1p(len(_END.findall(block.text))) / 2,
                        "©" in block.text, i / len(page), 1 / (1 + i), 1 / (len(page) - i))
    return out
