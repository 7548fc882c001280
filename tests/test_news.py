from datetime import datetime, timezone

import pytest
from conftest import values
from pyspark.sql import functions as F

from tickloom.functions import text as X
from tickloom.operators import filters as L
from tickloom.operators import news as N
from tickloom.operators import projections as P

PAGE = """<html><title>Rates &amp; <b>more</b></title><script>var t="<p>no</p>"</script><style>p{}</style>
<!-- <p>no</p> --><ul><li>First point</li><li class="x">Second!</li></ul>
<p style="font-weight:bold">Chart</p><p class="a">Rates <i>rise</i></p><P STYLE='color:red'>Caf&eacute;</P>
<p style='x; font-style: italic'>Source</p><pre>not a paragraph</pre><p></p></html>"""


def one(rows, col, *texts):
    return [r[0] for r in rows("s string", *[(t,) for t in texts]).select(col).collect()]


def test_tags(rows):
    assert one(rows, X.strip_tags("s"), "<p a='b'>x<br/>y</p>", "a < b > c", "<\nx>", "</ b>") == ["xy", "a < b > c", "", "</ b>"]


@pytest.mark.parametrize("raw, text", [
    ("a &amp;lt; b", "a &lt; b"), ("&copy 1 &AMP;x", "© 1 &x"), ("&nosuch; &nosuch x", "&nosuch; &nosuch x"),
    ("&#65;&#x42;&#X43", "ABC"), ("&#128;|&#129;|&#xD800;|&#99999999999;", "€|&#129;|&#xD800;|&#99999999999;"), ("AT&T &", "AT&T &"),
    ("&euro;&Eacute;&eacute;", "€Éé"), ("&#x1F600;", "😀"), ("", ""), ("&&amp;&", "&&&"), ("&nbsp;&equals", "\xa0&equals")])
def test_entities(rows, raw, text):
    assert one(rows, X.decode_entities("s"), raw) == [text]


def test_html5_names_and_dropping_unknown_ones(rows):
    raw = "it&apos;s up 5&percnt; to &dollar;3 &unknown; &NotEqualTilde;"
    assert one(rows, X.decode_entities("s"), raw) == ["it's up 5% to $3 &unknown; \u2242\u0338"]
    assert one(rows, X.decode_entities("s", drop_unknown=True), raw) == ["it's up 5% to $3  \u2242\u0338"]


def test_full_stop(rows):
    assert one(rows, X.ensure_period("s"), "Rates rise", "Rates rise!", "", "été", "a_", "end\n") == [
        "Rates rise.", "Rates rise!", "", "été.", "a_.", "end\n"]


def test_article(rows):
    df = rows("page_id long, url string, html string", (1, "u", PAGE))
    got = N.articles(df, sep="$$$$", summary="bullets").first()
    assert (got["title"], got["time"], got["summary"]) == ("Rates & more", None, "First point.$$$$Second!")
    assert got["content"] == "Rates rise.$$$$Café.$$$$"
    assert N.articles(df).first()["summary"] == "Rates rise."


def test_paragraphs(rows):
    df = rows("page_id long, url string, html string", (1, "u", PAGE))
    assert [r["text"] for r in N.paragraphs(df).orderBy("pos").collect()] == ["Chart.", "Rates rise.", "Café.", "Source.", ""]
    assert [r["text"] for r in N.plain_paragraphs(df).orderBy("pos").collect()] == ["Rates rise.", "Café.", ""]


def test_page_without_paragraphs(rows):
    df = rows("page_id long, url string, html string", (1, "u", "<html></html>"), (2, "v", None))
    assert values(N.articles(df).orderBy("page_id"), "summary", "content") == [(None, ""), (None, None)]


def test_listing(rows):
    html = ('<div><a class="x" href="/a"><span> One &amp; two </span><span> 2021-01-04 10:00:00 </span></a>'
            "<a href='https://other.example/b'>Plain</a><area href='no'></div>")
    df = rows("page_id long, html string", (1, html))
    got = N.listing(df, base=F.lit("https://site.example")).orderBy("pos")
    assert values(got, "title", "time", "url") == [
        ("One & two", 1609754400, "https://site.example/a"), ("Plain", None, "https://other.example/b")]


def test_published_time(rows):
    tag = '{"property":"og:article:published_time","content":"2021-01-04T10:00:00Z"}'
    got = one(rows, F.unix_seconds(X.published_time("s")), f"<script>{tag}</script>", "none", tag.replace("2021", "x"))
    assert got == [int(datetime(2021, 1, 4, 10, tzinfo=timezone.utc).timestamp()), None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, rows, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(rows, X.parse_utc("s"), "1970-01-02 00:00:01", "oops", " 1970-01-01 00:00:00 ") == [86401, None, 0]
        assert one(rows, F.unix_seconds(X.parse_iso("s")), "1970-01-02T00:00:01", "1970-01-02T02:00:01+02:00",
                   "1970-01-02T02:00:01+0200", "1970-01-02", "1970-01-02T00:00:01.5Z", "no", " ") == [
                       86401, 86401, 86401, 86400, 86401, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_excluded_link(rows):
    df = rows("url string", ("https://x/fundamental/article/1",), ("https://x/market/1",))
    assert values(L.exclude_url(df, "fundamental/article"), "url") == [("https://x/market/1",)]


def test_words_are_case_sensitive(rows):
    df = rows("t string", ("about EUR/USD",), ("eurusd",), ("EURUSD",))
    assert values(L.mentions_any(df, "t", ["EUR/USD", "EURUSD"]), "t") == [("about EUR/USD",), ("EURUSD",)]


def test_feeds_merge_by_url(rows):
    feed = "title string, url string, time long, summary string, content string"
    a = N.with_source(rows(feed, ("old", "u", 1, "", ""), ("only", "v", 1, "", "")), "A", "S")
    b = N.with_source(rows(feed, ("new", "u", 2, "x" * 300, "")), "B", "S")
    merged = N.news(a, b)
    assert sorted(values(merged, "title", "source")) == [("new", "B"), ("only", "A")]
    assert values(P.news_page(merged, 0, 1), "title") == [("new",)]
    item = P.feed_items(merged.filter("url = 'u'")).first()
    assert (len(item["content"]), item["created_at"]) == (200, 2000)
