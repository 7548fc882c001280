"""News as sites lay it out: articles in containers among menus and footers, listings that lead to them."""

from pyspark.sql import functions as F

from tickloom.functions import markup as M
from tickloom.functions import text as X
from tickloom.functions.markup import Element
from tickloom.operators import news as N
from tickloom.plans import articles as A
from tickloom.plans.articles import SQL_PARAGRAPHS, SQL_TIME, pages, sql_clean
from tickloom.plans.registry import query

GROUP = 10                  # links of a listing page
FIRST = A.FIRST_TIME
HOME = "https://news.example/"
P_OPEN = {"bullets": '<p class="gsstx">', "headlines": '<p class="Text Paragraph-para-2 x">', "stories": '<p class="Text Paragraph-para-2 x">'}
BOLD = '<p class="gsstx" style="font-weight: bold"><b>'


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def article_url(page="page_id"):
    return _text(HOME, F.col(page).cast("string"), "?a=1&b=2")


def site_pages(spark, sf, form):
    """The given pages inside the article container of a site, between a menu and a footer of the same elements. The time stands
    where the site has it; every third page has none."""
    site, para = N.SITES[form], P_OPEN[form]
    number = F.col("page_id").cast("string")
    time = F.concat(F.date_format(F.make_date(F.lit(2021), (F.col("page_id") % 12 + 1).cast("int"), (F.col("page_id") % 28 + 1).cast("int")), "yyyy-MM-dd"), F.lit("T10:00:00Z"))
    body = F.replace("html", F.lit("<p><b>"), F.lit(BOLD)) if form == "bullets" else F.col("html")
    body = F.replace(body, F.lit("<p>"), F.lit(para))
    if form == "bullets":
        stamp = _text('<span class="x dfx-articleHead__displayDate" data-time="', time, '">today</span>')
        body = _text('<div class="in"><ul class="gsstx"><li>Point one of ', number, "</li><li>Point <b>two</b>!</li></ul></div>", body)
    else:
        stamp = _text('<script id="__NEXT_DATA__">{"property":"og:article:published_time","content":"', time, '"}</script>')
    wrapped = _text('<header><ul class="gsstx"><li>Menu</li></ul>', para, "Menu</p></header>", F.when(F.col("page_id") % 3 != 0, stamp).otherwise(""),
                    f"<div class='row {site.body.cls}' id=main>", '<p class="other">Other</p>', body, "</div><footer>", para, "Footer</p><li>Foot</li><div>End</div></footer>")
    return pages(spark, sf).select("page_id", article_url().alias("url"), wrapped.alias("html"))


def site_lists(spark, sf, form):
    """Listing pages of ten links each, in page order, among links that are none of theirs. The first link stands twice, one leads to a
    page that is not there, and one is of a kind that is left out."""
    def item(url, title, time):
        if form == "bullets":
            return _text('<a class="x" href="', url, '"><span>', title, "</span><div><span> ", time, " </span></div></a>")
        stamp = _text('<span class="timestamp">', time, "</span>") if form == "headlines" else F.lit("")
        return _text('<article class="story big"><a href="', url, '"><h3 class="story-title"> ', title, " </h3></a>", stamp, "</article>")

    clock = F.from_unixtime(F.lit(FIRST) + F.col("page_id") * 60, "yyyy-MM-dd HH:mm:ss")
    own = item(article_url() if form != "headlines" else F.regexp_replace(article_url(), "^https://[^/]*", ""), _text("Title ", F.col("page_id").cast("string"), " &amp; <i>more</i>"), clock)
    listed = (pages(spark, sf).select(F.floor(F.col("page_id") / GROUP).alias("page_id"), F.struct("page_id", own.alias("a")).alias("link"))
              .groupBy("page_id").agg(F.array_sort(F.collect_list("link")).alias("links")))
    number = F.col("page_id").cast("string")
    path = "" if form == "headlines" else HOME.rstrip("/")
    lost = item(_text(f"{path}/missing/", number), _text("Missing ", number), F.lit("2021-01-01 00:00:00"))
    out = item(_text(f"{path}/fundamental/article/", number), F.lit("Out"), F.lit("2021-01-01 00:00:00")) if form == "bullets" else F.lit("")
    inside = _text(F.element_at("links", 1)["a"], F.array_join(F.transform("links", lambda x: x["a"]), "<hr>"), lost, out)
    open_ = {"bullets": '<div class="dfx-articleList big"><div class="in">', "headlines": '<div class="news-headline-list"><div class="in">', "stories": '<div id="latest-stories"><div class="in">'}[form]
    return listed.select("page_id", _text("<nav>", item(F.lit("/nav"), F.lit("Nav"), F.lit("2021-01-01 00:00:00")), "</nav>", open_, inside, "</div></div><footer>",
                                          item(F.lit("/foot"), F.lit("Foot"), F.lit("2021-01-01 00:00:00")), "</footer>").alias("html"))


def _sql_site(form):
    """Articles and links of a form; the plain paragraphs of a given page are those of `SQL_PARAGRAPHS`."""
    plain = "WHERE plain" if form == "bullets" else ""
    summary = "'Point one of ' || page_id || '.' || chr(10) || 'Point two!'" if form == "bullets" else "first"
    listed = f"CAST({FIRST} + page_id * 60 AS BIGINT)" if form != "stories" else "CAST(NULL AS BIGINT)"
    missing = str(FIRST) if form != "stories" else "CAST(NULL AS BIGINT)"
    home = "'https://reuters.com/'" if form == "headlines" else f"'{HOME}'"
    return rf"""{SQL_PARAGRAPHS},
joined AS (SELECT page_id, string_agg(text, chr(10) ORDER BY pos) AS content, first(text ORDER BY pos) AS first FROM paragraphs {plain} GROUP BY page_id),
site AS (SELECT page_id, {home} || page_id || '?a=1&b=2' AS url, {SQL_TIME} AS time, {summary} AS summary, coalesce(content, '') AS content FROM pages LEFT JOIN joined USING (page_id)),
links AS (
  SELECT page_id // {GROUP} AS page, 'Title ' || page_id || ' & more' AS title, {listed} AS time, {home} || page_id || '?a=1&b=2' AS url, page_id AS place FROM pages
  UNION ALL SELECT DISTINCT page_id // {GROUP}, 'Missing ' || page_id // {GROUP}, {missing}, {home} || 'missing/' || page_id // {GROUP}, NULL FROM pages)"""


def _register(form, name):
    site = N.SITES[form]

    @query(f"articles_{name}", f"WITH {_sql_site(form).replace('https://reuters.com/', HOME)} SELECT page_id, url, time, summary, content FROM site")
    def site_articles(spark, sf):
        return N.site_articles(site_pages(spark, sf, form), site)

    @query(f"listing_{name}", f"""WITH {_sql_site(form)} SELECT page AS page_id, title, time, url,
  row_number() OVER (PARTITION BY page ORDER BY time DESC NULLS LAST, place NULLS LAST) - 1 AS pos FROM links""")
    def site_listing(spark, sf):
        return N.site_listing(site_lists(spark, sf, form), site).withColumn("pos", F.col("pos").cast("long"))

    @query(f"news_{name}", f"""WITH {_sql_site(form)}
SELECT l.title, l.url, coalesce(s.time, l.time) AS time, s.summary, s.content, '{site.source}' AS source, '{site.symbol}' AS symbol
FROM links l LEFT JOIN site s USING (url)""")
    def site_news(spark, sf):
        found = site_pages(spark, sf, form)
        if site.base:       # the pages under the addresses their listing leads to
            found = found.withColumn("url", F.replace("url", F.lit(HOME.rstrip("/")), F.lit(site.base)))
        return N.site_news(site_lists(spark, sf, form), found, site)

    return site_articles, site_listing, site_news


for _form in N.SITES:
    _register(_form, _form)


@query("containers", rf"""WITH {A.SQL_TEXT}
SELECT page_id, {sql_clean("regexp_extract(html, '(?is)<article>(.*?)</article>', 1)", end=False)} AS article,
       CAST(len(regexp_extract_all(html, '(?i)<div[ >]')) AS BIGINT) + 1 AS n_div FROM hidden""")
def containers(spark, sf):
    """The article of each page, and its divisions when a further one wraps them all."""
    visible = X.drop_hidden("html")
    shown = X.clean(M.inner(M.first(visible, Element("article"))), end=False)
    wrapped = F.concat(F.lit("<div><em>x</em>"), visible, F.lit("</div>"))
    outer = M.balanced(wrapped, Element("div"))
    nested = F.size(M.balanced(M.inner(F.element_at(outer, 1)), Element("div")))
    return pages(spark, sf).select("page_id", shown.alias("article"), (F.size(outer) + nested).cast("long").alias("n_div"))
