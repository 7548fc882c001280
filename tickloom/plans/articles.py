"""Queries over pages and news."""

from pyspark.sql import functions as F
from pyspark.sql import types as Y

from tickloom.functions import text as X
from tickloom.operators import news as N
from tickloom.operators import projections as P
from tickloom.operators import requests as Q
from tickloom.plans import tables as T
from tickloom.plans.registry import query
from tickloom.session import fresh_dir
from tickloom.sources import store as W

FIRST_TIME = 1609459200     # 2021-01-01 00:00:00 UTC
BOLD = '<p style="font-weight: bold"><b>'

SQL_TEXT = rf"""
hidden(page_id, url, html) AS (
  SELECT page_id, url, regexp_replace(html, '{X.HIDDEN}', '', 'g') FROM pages)"""


def sql_clean(expr, end=True):
    """Strip tags, decode the entities the pages hold, end with a full stop."""
    bare = rf"regexp_replace({expr}, '{X.TAG}', '', 'g')"
    for name, char in (("quot", '"'), ("middot", "·"), ("copy", "©")):
        bare = f"replace({bare}, '&{name};', '{char}')"
    bare = rf"regexp_replace(replace({bare}, '&amp;', chr(1)), '&amp([^a-zA-Z0-9;]|$)', chr(1) || '\1', 'g')"
    bare = f"replace({bare}, chr(1), '&')"
    return rf"regexp_replace({bare}, '([\p{{L}}\p{{N}}_])\z', '\1.')" if end else bare


SQL_PARAGRAPHS = rf"""{SQL_TEXT},
found AS (SELECT page_id, url, regexp_extract_all(html, '{X.PARAGRAPH}') AS ps FROM hidden),
raw AS (SELECT page_id, url, unnest(ps) AS p, unnest(range(len(ps))) AS pos FROM found),
styled AS (SELECT page_id, url, pos, p, p NOT LIKE '<p><b>%' AS plain FROM raw),
paragraphs AS (SELECT page_id, url, pos, plain, {sql_clean('p')} AS text FROM styled)"""


def pages(spark, sf):
    return T.load(spark, sf, "pages")


def styled_pages(spark, sf):
    """Pages whose bold paragraphs say so in their style, as news sites write them."""
    return pages(spark, sf).withColumn("html", F.replace("html", F.lit("<p><b>"), F.lit(BOLD)))


def timed_pages(spark, sf):
    """Pages with the published time embedded as JSON; every third page has none."""
    at = F.date_format(F.make_date(F.lit(2021), (F.col("page_id") % 12 + 1).cast("int"),
                                   (F.col("page_id") % 28 + 1).cast("int")), "yyyy-MM-dd")
    tag = F.concat(F.lit('<script>{"property":"og:article:published_time","content":"'), at,
                   F.lit('T10:00:00Z"}</script>'))
    return styled_pages(spark, sf).withColumn(
        "html", F.when(F.col("page_id") % 3 != 0, F.concat("html", tag)).otherwise(F.col("html")))


SQL_TIME = """CASE WHEN page_id % 3 <> 0
  THEN CAST(epoch(make_timestamp(2021, page_id % 12 + 1, page_id % 28 + 1, 10, 0, 0)) AS BIGINT) END"""


@query("strip_tags", f"SELECT page_id, regexp_replace(html, '{X.TAG}', '', 'g') AS text FROM pages")
def strip_tags(spark, sf):
    return pages(spark, sf).select("page_id", X.strip_tags("html").alias("text"))


@query("decode_entities", f"SELECT page_id, {sql_clean('html', end=False)} AS text FROM pages")
def decode_entities(spark, sf):
    return pages(spark, sf).select("page_id", X.decode_entities(X.strip_tags("html")).alias("text"))


@query("decode_entities_html5", """SELECT page_id,
  'it''s up ' || page_id || '% to $3 &unknown; < &nosemicolon ' || url AS text FROM pages""")
def decode_entities_html5(spark, sf):
    raw = F.concat(F.lit("it&apos;s up "), "page_id", F.lit("&percnt; to &dollar;3 &unknown; &lt &nosemicolon "),
                   F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")))
    return T.load(spark, sf, "pages").select("page_id", X.decode_entities(raw).alias("text"))


@query("ensure_period", r"""SELECT doc_id, regexp_replace(text, '([\p{L}\p{N}_])\z', '\1.') AS text FROM documents""")
def ensure_period(spark, sf):
    return T.load(spark, sf, "documents").select("doc_id", X.ensure_period("text").alias("text"))


@query("paragraphs", f"WITH {SQL_PARAGRAPHS} SELECT page_id, url, pos, text, plain FROM paragraphs")
def paragraphs(spark, sf):
    return N.paragraphs(styled_pages(spark, sf)).withColumn("pos", F.col("pos").cast("long"))


@query("plain_paragraphs", f"WITH {SQL_PARAGRAPHS} SELECT page_id, pos, text FROM paragraphs WHERE plain")
def plain_paragraphs(spark, sf):
    return (N.plain_paragraphs(styled_pages(spark, sf), keys=("page_id",))
            .withColumn("pos", F.col("pos").cast("long")))


@query("article_content", f"""WITH {SQL_PARAGRAPHS}, joined AS (
  SELECT page_id, string_agg(text, '$$$$' ORDER BY pos) AS content FROM paragraphs WHERE plain GROUP BY page_id)
SELECT page_id, coalesce(content, '') AS content FROM pages LEFT JOIN joined USING (page_id)""")
def article_content(spark, sf):
    return styled_pages(spark, sf).select("page_id", N.content("html", "$$$$").alias("content"))


@query("summary_bullets", rf"""WITH {SQL_TEXT},
items AS (SELECT page_id, regexp_extract_all(html, '{X.LIST_ITEM}') AS ls FROM hidden),
item AS (SELECT page_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM items),
joined AS (SELECT page_id, string_agg({sql_clean('l')}, chr(10) ORDER BY pos) AS summary FROM item GROUP BY page_id)
SELECT page_id, coalesce(summary, '') AS summary FROM pages LEFT JOIN joined USING (page_id)""")
def summary_bullets(spark, sf):
    return pages(spark, sf).select("page_id", N.summary_bullets("html").alias("summary"))


@query("summary_first", f"""WITH {SQL_PARAGRAPHS}, firsts AS (
  SELECT page_id, text FROM paragraphs WHERE plain QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1)
SELECT page_id, text AS summary FROM pages LEFT JOIN firsts USING (page_id)""")
def summary_first(spark, sf):
    return styled_pages(spark, sf).select("page_id", N.summary_first("html").alias("summary"))


SQL_ARTICLES = rf"""{SQL_PARAGRAPHS},
joined AS (
  SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS content, first(text ORDER BY pos) AS summary
  FROM paragraphs WHERE plain GROUP BY page_id),
articles AS (
  SELECT page_id, h.url, {sql_clean(f"regexp_extract(html, '{X.TITLE}', 1)", end=False)} AS title,
         {SQL_TIME} AS time, summary, coalesce(content, '') AS content
  FROM hidden h LEFT JOIN joined USING (page_id))"""


@query("articles", f"WITH {SQL_ARTICLES} SELECT page_id, url, title, time, summary, content FROM articles")
def articles(spark, sf):
    return N.articles(timed_pages(spark, sf))


@query("published_time", f"SELECT page_id, {SQL_TIME} AS time FROM pages")
def published_time(spark, sf):
    return timed_pages(spark, sf).select("page_id", F.unix_seconds(X.published_time("html")).alias("time"))


@query("listing", rf"""WITH {SQL_TEXT},
links AS (SELECT page_id, regexp_extract_all(html, '{X.ANCHOR}') AS ls FROM hidden),
link AS (SELECT page_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM links)
SELECT page_id, pos, trim({sql_clean('l', end=False)}) AS title, CAST(NULL AS BIGINT) AS time,
       'https://news.example' || regexp_extract(l, 'href="([^"]*)"', 1) AS url FROM link""")
def listing(spark, sf):
    found = N.listing(pages(spark, sf), base=F.lit("https://news.example"))
    return found.withColumn("pos", F.col("pos").cast("long"))


@query("listing_with_times", f"""WITH {SQL_TEXT},
links AS (SELECT page_id, regexp_extract_all(html, '{X.ANCHOR}') AS ls FROM hidden),
link AS (SELECT page_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM links)
SELECT page_id, pos, trim({sql_clean('l', end=False)}) AS title,
       CAST({FIRST_TIME} + (page_id % 24) * 3600 AS BIGINT) AS time, regexp_extract(l, 'href="([^"]*)"', 1) AS url
FROM link""")
def listing_with_times(spark, sf):
    """Links rewritten to carry a title span and a time span."""
    hour = F.lpad((F.col("page_id") % 24).cast("string"), 2, "0")
    spans = F.concat(F.lit("<a $1><span>$2</span><span> 2021-01-01 "), hour, F.lit(":00:00 </span></a>"))
    listed = pages(spark, sf).withColumn("html", F.regexp_replace(
        X.drop_hidden("html"), F.lit(r"(?s)<a ([^>]*)>(.*?)</a>"), spans))
    return N.listing(listed).withColumn("pos", F.col("pos").cast("long"))


@query("parse_times", """SELECT event_id, epoch_us(ts) // 1000000 AS plain, epoch_us(ts) // 1000000 AS iso,
  epoch_us(ts) // 1000000 - 7200 AS shifted, CAST(NULL AS BIGINT) AS bad FROM events""")
def parse_times(spark, sf):
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    return T.load(spark, sf, "events").select(
        "event_id", X.parse_utc(F.concat_ws(" ", day, clock)).alias("plain"),
        F.unix_seconds(X.parse_iso(F.concat_ws("T", day, clock))).alias("iso"),
        F.unix_seconds(X.parse_iso(F.concat(day, F.lit("T"), clock, F.lit("+0200")))).alias("shifted"),
        X.parse_utc("event_type").alias("bad"))


@query("absolute_url", """SELECT page_id, url AS kept,
  'https://news.example' || '/' || page_id || '/' || length(url) AS built FROM pages""")
def absolute_url(spark, sf):
    link = F.concat(F.lit("/"), "page_id", F.lit("/"), F.length("url"))
    base = F.lit("https://news.example")
    return pages(spark, sf).select("page_id", X.absolute_url(base, "url").alias("kept"),
                                   X.absolute_url(base, link).alias("built"))


def feed(spark, sf, source="Wire", shift=0):
    """Articles of all pages as one feed; three pages share a time."""
    found = N.articles(styled_pages(spark, sf)).withColumn(
        "time", F.lit(FIRST_TIME + shift) + F.floor(F.col("page_id") / 3) * 60)
    return N.with_source(found.drop("page_id"), source, "EURUSD")


SQL_FEED = f"""{SQL_ARTICLES},
feed AS (
  SELECT title, url, CAST({FIRST_TIME} + page_id // 3 * 60 AS BIGINT) AS time, summary, content,
         'EURUSD' AS symbol, 'Wire' AS source, page_id FROM articles)"""


@query("with_source", f"WITH {SQL_FEED} SELECT title, url, time, summary, content, symbol, source FROM feed")
def with_source(spark, sf):
    return feed(spark, sf)


@query("news", f"""WITH {SQL_FEED}
SELECT title, url, CAST(time + CASE WHEN page_id % 2 = 0 THEN 3600 ELSE 0 END AS BIGINT) AS time, summary, content,
       symbol, CASE WHEN page_id % 2 = 0 THEN 'Desk' ELSE source END AS source FROM feed""")
def news(spark, sf):
    """Two feeds; the second brings half of the articles again, an hour later."""
    even = pages(spark, sf).filter("page_id % 2 = 0").select("url")
    return N.news(feed(spark, sf), feed(spark, sf, "Desk", 3600).join(even, "url", "left_semi"))


@query("upsert_news", f"""WITH {SQL_FEED}
SELECT url, CASE WHEN page_id % 2 = 0 THEN 'New: ' || title ELSE title END AS title, time FROM feed""")
def upsert_news(spark, sf):
    table = feed(spark, sf).select("url", "title", "time")
    even = pages(spark, sf).filter("page_id % 2 = 0").select("url")
    batch = table.join(even, "url", "left_semi").withColumn("title", F.concat(F.lit("New: "), "title"))
    return W.upsert(table, batch, ["url"], ["time"])


@query("news_page", f"""WITH {SQL_FEED} SELECT title, url, time, source FROM feed
ORDER BY time DESC, url LIMIT 20 OFFSET 5""")
def news_page(spark, sf):
    return P.news_page(feed(spark, sf).select("title", "url", "time", "source"), offset=5)


@query("news_page_deep", f"""WITH {SQL_FEED} SELECT title, url, time, source FROM feed
ORDER BY time DESC, url LIMIT 20 OFFSET (SELECT count(*) // 2 FROM feed)""")
def news_page_deep(spark, sf):
    """The page in the middle of all news."""
    found = feed(spark, sf).select("title", "url", "time", "source")
    return P.deep_news_page(found, pages(spark, sf).count() // 2, rows=40)


@query("news_feed", f"""WITH {SQL_FEED} SELECT title, substring(summary, 1, 200) AS content, url AS link, source,
  time * 1000 AS created_at FROM feed ORDER BY time DESC, url LIMIT 20""")
def news_feed(spark, sf):
    """The first page of the feed, as the dashboard shows it."""
    return P.feed_items(Q.news_feed(feed(spark, sf), "EUR/USD"))


@query("feed_items", f"""WITH {SQL_FEED}
SELECT title, substring(summary, 1, 200) AS content, url AS link, source, time * 1000 AS created_at FROM feed""")
def feed_items(spark, sf):
    return P.feed_items(feed(spark, sf))


@query("write_tsv", f"WITH {SQL_FEED} SELECT title, url, time, coalesce(summary, '') AS summary, content FROM feed")
def write_tsv(spark, sf):
    path = fresh_dir(spark, "news")
    W.write_tsv(feed(spark, sf), path)
    schema = Y.StructType([Y.StructField(c, Y.LongType() if c == "time" else Y.StringType()) for c in W.NEWS_COLUMNS])
    return W.read_tsv(spark, path, schema)
