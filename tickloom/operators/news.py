"""Raw pages to articles and listings. Everything about one page is an expression on its
row, so cleaning a page table needs no shuffle. Where the layout of a site is known (`Site`), only its own containers are read."""

from typing import NamedTuple

from pyspark.sql import functions as F

from tickloom.functions import markup as M
from tickloom.functions import text as X
from tickloom.functions.markup import Element
from tickloom.operators.series import latest
from tickloom.sources.store import union_all


def paragraphs(pages, html="html", keys=("page_id", "url")):
    """Cleaned paragraphs by position, with a flag for the ones in plain style."""
    found = X.elements(X.drop_hidden(html), X.PARAGRAPH)
    return (pages.select(*keys, F.posexplode(found).alias("pos", "_p"))
            .select(*keys, "pos", X.clean("_p").alias("text"), X.is_plain(F.col("_p")).alias("plain")))


def plain_paragraphs(pages, html="html", keys=("page_id", "url")):
    """Paragraphs that are not bold or italic as a whole."""
    return paragraphs(pages, html, keys).filter("plain").drop("plain")


def summary_bullets(html, sep="\n"):
    """Text of the list items."""
    return F.array_join(F.transform(X.elements(X.drop_hidden(html), X.LIST_ITEM), lambda item: X.clean(item)), sep)


def _plain(html):
    return F.filter(X.elements(X.drop_hidden(html), X.PARAGRAPH), X.is_plain)


def content(html, sep="\n"):
    """Text of the plain paragraphs."""
    return F.array_join(F.transform(_plain(html), lambda p: X.clean(p)), sep)


def summary_first(html):
    """Text of the first plain paragraph; null without one."""
    return X.clean(F.try_element_at(_plain(html), F.lit(1)))


def title(html):
    """Text of the page title, tags and entities resolved."""
    return X.clean(F.regexp_extract(X.drop_hidden(html), X.TITLE, 1), end=False)


def articles(pages, sep="\n", summary="first", html="html", keys=("page_id", "url")):
    """One article per page: title, published time in seconds, summary and content.
    `summary` is ``first`` (first paragraph) or ``bullets`` (list items).

    The visible page and the cleaned paragraphs are columns of their own, which keeps them
    from being worked out again for every output that needs them."""
    texts = F.transform(F.filter(X.elements("_visible", X.PARAGRAPH), X.is_plain), lambda p: X.clean(p))
    staged = (pages.withColumn("_visible", X.drop_hidden(html)).withColumn("_texts", texts))
    short = {
        "first": lambda: F.try_element_at("_texts", F.lit(1)),
        "bullets": lambda: F.array_join(F.transform(
            X.elements("_visible", X.LIST_ITEM), lambda item: X.clean(item)), sep),
    }[summary]()
    return staged.select(*keys, X.clean(F.regexp_extract("_visible", X.TITLE, 1), end=False).alias("title"),
                         F.unix_seconds(X.published_time(html)).alias("time"),
                         short.alias("summary"), F.array_join("_texts", sep).alias("content"))


def listing(pages, html="html", keys=("page_id",), base=None):
    """Article links of listing pages by position. Title and time are the first two spans
    of a link; a link without spans has its text as title and no time."""
    found = X.elements(X.drop_hidden(html), X.ANCHOR)
    spans = F.regexp_extract_all("_a", F.lit(X.SPAN), F.lit(1))
    url = F.regexp_extract("_a", X.HREF, 1)
    rows = pages.select(*keys, *([] if base is None else [base.alias("_base")]),
                        F.posexplode(found).alias("pos", "_a"))
    first = F.coalesce(F.try_element_at(spans, F.lit(1)), F.col("_a"))
    return rows.select(*keys, "pos", F.trim(X.clean(first, end=False)).alias("title"),
                       X.parse_utc(F.try_element_at(spans, F.lit(2))).alias("time"),
                       (url if base is None else X.absolute_url("_base", url)).alias("url"))


def with_source(df, source, symbol):
    """Constant columns of a feed."""
    return df.withColumns({"source": F.lit(source), "symbol": F.lit(symbol)})


def news(*feeds):
    """All feeds as one table, one row per url: the newest article, then by source."""
    return latest(union_all(feeds), ["url"], ["time", "source", "title"])


class Site(NamedTuple):
    """Where a news site keeps what is wanted of its pages."""
    source: str
    symbol: str
    body: Element                       # holds the article
    paragraph: Element                  # a paragraph of it
    listing: Element                    # holds the links of a listing page
    item: Element                       # one of them
    title: Element                      # in an item
    bullets: Element | None = None      # in the body: the list that is the summary; else the first paragraph is
    plain_only: bool = False            # leave bold and italic paragraphs out
    published: tuple[Element, str] | None = None    # element and attribute of the time; else it is embedded as JSON
    time: Element | None = None         # in an item
    time_place: int = 1                 # which of these
    every_list: bool = False            # all such lists of a page, not the first only
    base: str | None = None             # in front of relative links
    exclude: str | None = None          # links that hold this are left out


# The layouts of three sites.
SITES = {
    "bullets": Site("DailyFX", "EURUSD", Element(cls="dfx-articleBody__content"), Element("p", cls="gsstx"), Element("div", cls="dfx-articleList"), Element("a"),
                    Element("span"), bullets=Element("ul", cls="gsstx"), plain_only=True, published=(Element(cls="dfx-articleHead__displayDate"), "data-time"),
                    time=Element("span"), time_place=2, every_list=True, exclude="fundamental/article"),
    "headlines": Site("Reuters", "EURUSD", Element(cls="ArticleBodyWrapper"), Element("p", part="Paragraph-"), Element("div", cls="news-headline-list"),
                      Element("article", cls="story"), Element("h3", cls="story-title"), time=Element("span", cls="timestamp"), base="https://reuters.com"),
    "stories": Site("Wall Street Journal", "EURUSD", Element(cls="ArticleBodyWrapper"), Element("p", part="Paragraph-"), Element("div", id="latest-stories"),
                    Element("article"), Element("h3")),
}


def _shown(outer):
    """Text of an element, tags and entities resolved."""
    return F.trim(X.clean(M.inner(outer), end=False))


def site_articles(pages, site, sep="\n", html="html", keys=("page_id", "url")):
    """Articles out of the containers of a site: published time in seconds, summary and content. Menus, footers and other parts of
    a page do not count, and a page without the body container gives no row. The summary is null where a site takes the first
    paragraph and there is none."""
    wanted = lambda p: M.is_element(M.opening(p), site.paragraph) & (X.is_plain(p) if site.plain_only else F.lit(True))
    staged = (pages.withColumn("_visible", X.drop_hidden(html)).withColumn("_body", M.inner(M.first("_visible", site.body))).filter("_body is not null")
              .withColumn("_texts", F.transform(F.filter(X.elements("_body", X.PARAGRAPH), wanted), lambda p: X.clean(p))))
    if site.published:
        element, name = site.published
        time = X.parse_iso(M.attribute(M.opening(M.first("_visible", element)), name))
    else:
        time = X.published_time(html)
    if site.bullets:
        items = F.transform(X.elements(M.first("_body", site.bullets), X.LIST_ITEM), lambda item: X.clean(item))
        summary = F.array_join(F.coalesce(items, F.array().cast("array<string>")), sep)
    else:
        summary = F.try_element_at("_texts", F.lit(1))
    return staged.select(*keys, F.unix_seconds(time).alias("time"), summary.alias("summary"), F.array_join("_texts", sep).alias("content"))


def site_listing(pages, site, html="html", keys=("page_id",)):
    """Links of the listing pages of a site, each record once a page, newest first by position; links without a time come last. Title and time are
    texts inside a link's item; items without a link are left out."""
    def record(item):
        link = M.attribute(F.when(F.lit(site.item.tag == "a"), M.opening(item)).otherwise(M.opening(M.first(item, Element("a")))), "href")
        url = X.absolute_url(F.lit(site.base), link) if site.base else link
        when = F.lit(None).cast("long")
        if site.time:
            text = _shown(F.try_element_at(M.balanced(item, site.time), F.lit(site.time_place)))
            when = F.coalesce(X.parse_utc(text), F.unix_seconds(X.parse_iso(text)))
        return F.struct(_shown(M.first(item, site.title)).alias("title"), when.alias("time"), F.when(link != "", url).alias("url"))

    lists = M.balanced(X.drop_hidden(html), site.listing)
    lists = lists if site.every_list else F.slice(lists, 1, 1)
    items = F.flatten(F.transform(lists, lambda part: M.balanced(M.inner(part), site.item)))
    kept = lambda r: r["url"].isNotNull() & (~F.contains(r["url"], F.lit(site.exclude)) if site.exclude else F.lit(True))
    # Arrays sort by their fields in turn: the time falls, and equal times keep the order of the page.
    placed = F.array_sort(F.transform("_records", lambda r, i: F.struct(F.coalesce(-r["time"], F.lit(2 ** 62)).alias("late"), i.alias("i"), r.alias("r"))))
    found = (pages.select(*keys, F.transform(items, record).alias("_all")).withColumn("_records", F.array_distinct(F.filter("_all", kept)))
             .select(*keys, F.posexplode(placed).alias("pos", "_r")))
    return found.select(*keys, "pos", "_r.r.*")


def site_news(listings, pages, site, sep="\n", html="html", url="url"):
    """News of a site: the links of its listing pages with their articles. The listing gives the title and a time in case the article has none of its
    own; a link whose article is missing stays, without summary and content. A link that several listing pages show alike comes
    once."""
    links = site_listing(listings, site, html).select("title", "time", "url").distinct()
    found = site_articles(pages, site, sep, html, keys=(url,)).select(F.col(url).alias("url"), F.col("time").alias("_time"), "summary", "content")
    joined = links.join(found, "url", "left")
    return with_source(joined.select("title", "url", F.coalesce("_time", "time").alias("time"), "summary", "content"), site.source, site.symbol)
