"""Containers of pages, and news built from listings and articles."""

from conftest import values
from pyspark.sql import functions as F

from tickloom.functions import markup as M
from tickloom.functions.markup import Element
from tickloom.operators import news as N


def balanced(rows, html, element):
    return rows("h string", (html,)).select(M.balanced("h", element)).first()[0]


def test_elements_end_where_they_do(rows):
    html = '<p>x</p><DIV class="a">one<div class="b c">two<div>in</div>three</div></DIV><div class=\'c\'>last<divider></div><div class="open c">never'
    assert balanced(rows, html, Element("div")) == ['<DIV class="a">one<div class="b c">two<div>in</div>three</div></div>', "<div class='c'>last<divider></div>", '<div class="open c">never']
    assert balanced(rows, html, Element("div", cls="c")) == ['<div class="b c">two<div>in</div>three</div>', "<div class='c'>last<divider></div>", '<div class="open c">never']
    assert balanced(rows, html, Element("div", part="pe")) == ['<div class="open c">never']
    assert balanced(rows, html, Element(cls="none")) == []


def test_names_are_whole(rows):
    assert balanced(rows, "<divider class='c'>x</divider><div class='c'/>y", Element("div", cls="c")) == ["<div class='c'/>y"]
    assert balanced(rows, "<a-b class=c>x</a-b><a class=c>y</a>", Element("a", cls="c")) == ["<a class=c>y</a>"]


def test_id_and_first_name(rows):
    html = '<section id="s"><section>q</section>z</section><div id=s>no</div>'
    assert balanced(rows, html, Element(id="s")) == ['<section id="s"><section>q</section>z</section>']
    assert balanced(rows, html, Element("div", id="s")) == ["<div id=s>no</div>"]


def test_odd_texts(rows):
    df = rows("h string", ("",), (None,), ("</div></div>",), ("<div",), ("plain",))
    assert [r[0] for r in df.select(M.balanced("h", Element("div"))).collect()] == [[], None, [], [], []]
    assert [r[0] for r in df.select(M.first("h", Element(cls="x"))).collect()] == [None] * 5


def test_many_and_deep_elements(rows):
    flat = "".join(f"<li class=k>{k}</li>" for k in range(3000))
    assert len(balanced(rows, flat, Element("li"))) == 3000
    deep = "<div class=top>" + "<div>" * 2000 + "x" + "</div>" * 2000 + "</div><div>rest</div>"
    assert balanced(rows, deep, Element("div", cls="top")) == [deep.removesuffix("<div>rest</div>")]


def test_attributes(rows):
    df = rows("t string", ('<a class="x y" HREF="/u?a=1">',), ("<a\nhref='/v'>",), ("<a href=/w data-href=/no>",), ("<a data-href=/no>",), ("<a>",))
    assert [r[0] for r in df.select(M.attribute("t", "href")).collect()] == ["/u?a=1", "/v", "/w", "", ""]


BULLETS = N.SITES["bullets"]


def test_article_without_its_container_gives_no_row(rows):
    body = '<div class="dfx-articleBody__content">{}</div><p class="gsstx">Foot</p>'
    df = rows("page_id long, url string, html string", (1, "a", body.format('<p class="gsstx">One</p><p class="x">No</p><p class="gsstx" style="font-style:italic">No</p>')),
              (2, "b", '<p class="gsstx">Menu</p>'), (3, "c", body.format("")), (4, "d", None))
    got = N.site_articles(df, BULLETS).orderBy("page_id")
    assert values(got, "page_id", "time", "summary", "content") == [(1, None, "", "One."), (3, None, "", "")]


def test_attribute_time_wins_over_the_listing(rows):
    page = '<b class="dfx-articleHead__displayDate" data-time="2021-01-04T10:00:00+00:00">x</b><div class="dfx-articleBody__content"><p class="gsstx">One</p></div>'
    link = '<a href="{0}"><span>{0}</span><span> 2021-01-01 00:00:0{1} </span></a>'
    lists = rows("page_id long, html string", (1, '<div class="dfx-articleList">' + link.format("u", 1) + link.format("u", 1) + link.format("v", 3) + "</div><div class=dfx-articleList>" + link.format("w", 2) + "</div>"),
                 (2, '<div class="dfx-articleList">' + link.format("u", 1) + "</div>"), (3, ""), (4, None))
    pages = rows("url string, html string", ("u", page), ("v", page.replace("data-time", "data-x")), ("other", page))
    assert values(N.site_listing(lists, BULLETS).orderBy("page_id", "pos"), "page_id", "pos", "title") == [(1, 0, "v"), (1, 1, "w"), (1, 2, "u"), (2, 0, "u")]
    got = N.site_news(lists, pages, BULLETS).orderBy("url")
    assert values(got, "url", "time", "content") == [("u", 1609754400, "One."), ("v", 1609459203, "One."), ("w", 1609459202, None)]


def test_headlines_need_an_address(rows):
    html = ('<div class="news-headline-list"><article class="story"><a href="/x"></a><h3 class="story-title"> T <b>1</b> </h3></article>'
            '<article class="story"><h3 class="story-title">No link</h3></article><article>none</article></div>')
    got = N.site_listing(rows("page_id long, html string", (1, html)), N.SITES["headlines"])
    assert values(got, "title", "time", "url") == [("T 1", None, "https://reuters.com/x")]
    assert values(got.select(F.col("pos").cast("int").alias("p")), "p") == [(0,)]
