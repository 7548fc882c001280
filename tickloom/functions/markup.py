"""Elements of a page found by tag, class or id, with their ends matched, as column expressions."""

from typing import NamedTuple

from pyspark.sql import functions as F

from tickloom.functions.text import _col, _let

OPENING = r"(?s)^<[^>]*>"


class Element(NamedTuple):
    """What an opening tag must be: a name, a word of its class, a part of its class, an id. None asks nothing."""
    tag: str | None = None
    cls: str | None = None
    part: str | None = None
    id: str | None = None


def attribute(opening, name):
    """Value of an attribute of an opening tag, empty without one."""
    value = rf"""(?is)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    return F.concat(*[F.regexp_extract(_col(opening), value, k) for k in (1, 2, 3)])


def is_element(opening, element):
    """Whether an opening tag is the given element; its name is taken for granted."""
    cls = F.concat(F.lit(" "), F.regexp_replace(attribute(opening, "class"), r"\s", " "), F.lit(" "))
    out = F.lit(True)
    if element.cls:
        out = out & F.contains(cls, F.lit(f" {element.cls} "))
    if element.part:
        out = out & F.contains(cls, F.lit(element.part))
    if element.id:
        out = out & (attribute(opening, "id") == element.id)
    return out


def _name_of_first(html, element):
    """Name of the first tag that is the element."""
    opening = F.filter(F.regexp_extract_all(html, F.lit(r"(?s)<[a-zA-Z][^>]*>"), F.lit(0)), lambda t: is_element(t, element))
    return F.lower(F.regexp_extract(F.try_element_at(opening, F.lit(1)), r"^<([a-zA-Z][a-zA-Z0-9-]*)", 1))


def balanced(html, element):
    """All outermost elements of a kind, whole, in page order; one that is never closed ends with the text.

    The text is cut before every tag of the name, and a fold over the pieces counts how deep it is in elements of that
    name, so elements of the same name inside do not end one. Without a name, that of the first tag with the class or id counts."""
    def with_name(name):
        def tokens(pieces):
            named = lambda p: F.lower(F.regexp_extract(p, r"^</?([a-zA-Z][a-zA-Z0-9-]*)", 1)) == name
            closes = lambda p: named(p) & F.startswith(p, F.lit("</"))
            opens = lambda p: named(p) & ~F.startswith(p, F.lit("</"))
            return F.transform(pieces, lambda p, i: F.struct(
                i.alias("at"), F.when(closes(p), -1).when(opens(p), 1).otherwise(0).alias("step"),
                (opens(p) & F.contains(p, F.lit(">")) & is_element(F.regexp_extract(p, OPENING, 0), element)).alias("hit")))

        def step(held, t):
            inside = held["start"] >= 0
            depth = F.when(inside, held["depth"] + t["step"]).when(t["hit"], 1).otherwise(0)
            ends = inside & (depth == 0)
            return F.struct(depth.alias("depth"), F.when(ends, -1).when(~inside & t["hit"], t["at"]).otherwise(held["start"]).alias("start"),
                            F.when(ends, F.concat(held["found"], F.array(F.struct(held["start"].alias("start"), t["at"].alias("end"))))).otherwise(held["found"]).alias("found"))

        def found(pieces):
            start = F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("start"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))
            last = lambda held: F.when(held["start"] >= 0, F.concat(held["found"], F.array(F.struct(
                held["start"].alias("start"), F.size(pieces).alias("end"))))).otherwise(held["found"])
            spans = F.aggregate(tokens(pieces), start, step, last)
            return F.transform(spans, lambda s: F.concat(
                F.array_join(F.slice(pieces, s["start"] + 1, s["end"] - s["start"]), ""), F.when(s["end"] < F.size(pieces), F.concat(F.lit("</"), name, F.lit(">"))).otherwise("")))

        cut = F.split(html, F.concat(F.lit(r"(?i)(?=</?"), name, F.lit(r"[\s>/])")), F.lit(-1))
        return F.when(name == "", F.array().cast("array<string>")).otherwise(_let(cut, found))

    html = _col(html)
    return with_name(F.lit(element.tag)) if element.tag else _let(F.coalesce(_name_of_first(html, element), F.lit("")), with_name)


def opening(outer):
    """The opening tag of a whole element."""
    return F.regexp_extract(_col(outer), OPENING, 0)


def inner(outer):
    """What a whole element holds, without its own tags."""
    return F.regexp_replace(F.regexp_replace(_col(outer), OPENING, ""), r"</[^<>]*>\z", "")


def first(html, element):
    """The first such element, whole; null without one."""
    return F.try_element_at(balanced(html, element), F.lit(1))
