import pytest

from tickloom.llm.urls import PATTERNS, Rule, url_verdicts

RULES = [Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"), Rule("com/fr/", "allow"), Rule("com/de/", "block")]


def judge(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rows = {r["page_id"]: r for r in url_verdicts(df, rules).collect()}
    assert sorted(rows) == list(range(len(urls)))
    return [(rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) for i in range(len(urls))]


def test_site_rules(spark):
    got = judge(spark, [
        "http://a.Example.ORG/es/x?y#z", "https://example.org/en/12", "https://example.org/en/2", "http://notexample.org/es/", "http://example.org?es/", "http://x.com/DE/",
        "http://x.com/de/1", "http://de.com/fr/", "ftp://org/", "http://org.net/", None, "no scheme/org/", "x://y://z.org/", "http://org", "http://example.org:80/es/", "http://u@org/\n"], RULES)
    assert got == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"),
        ("notexample.org", "/es/", "org/", "allow"), ("example.org", "", None, "allow"), ("x.com", "/DE/", None, "allow"), ("x.com", "/de/1", "com/de/", "block"),
        ("de.com", "/fr/", "com/fr/", "allow"), ("org", "/", "org/", "allow"), ("org.net", "/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("y:", "//z.org/", None, "allow"), ("org", "", None, "allow"), ("example.org:80", "/es/", None, "allow"), ("u@org", "/\n", None, "allow")]


def test_patterns_and_ties(spark):
    rules = [*PATTERNS, Rule("a.net/", "allow"), Rule("a.net/", "block"), Rule("*p*q", "block", False), Rule("^casino^.^royale^", "allow", False)]
    got = judge(spark, ["http://m.Casino-win.net/", "http://casinos.net/", "http://a.net/ads/", "http://x/PxQ", "http://casino.royale.net/"], rules)
    assert [(g[2], g[3]) for g in got] == [(None, "block"), (None, "allow"), ("a.net/", "block"), (None, "block"), (None, "allow")]


def test_every_rule_is_found_through_its_token(spark):
    rules = [Rule(f"h{i}.net/p{j}", "block") for i in range(15) for j in range(4)] + [Rule("/", "block"), Rule("é.org/ü", "block")]
    urls = [f"http://w.h{i}.net/p{j}{k}" for i in range(17) for j in range(5) for k in ("", "x", "/y")] + ["http://é.org/üx", "http:///"]

    def plain(url):
        rest = url.split("://", 1)[1]
        host, slash, path = rest.partition("/")
        fit = [r.text for r in rules if (host == r.text.partition("/")[0] or host.endswith("." + r.text.partition("/")[0])) and (slash + path).startswith("/" + r.text.partition("/")[2])]
        return max(fit, key=len, default=None)
    assert [g[2] for g in judge(spark, urls, rules)] == [plain(u) for u in urls]


def test_repeats_empty_tables_and_no_rules(spark):
    assert [g[3] for g in judge(spark, ["http://x.com/de/"] * 3, [])] == ["allow"] * 3
    assert [g[3] for g in judge(spark, ["http://x.com/de/"] * 3, RULES)] == ["block"] * 3
    empty = spark.createDataFrame([], "url string")
    assert url_verdicts(empty, RULES).count() == 0
    with pytest.raises(ValueError):
        url_verdicts(spark.createDataFrame([], "host string"), RULES, url="host")


def test_very_long_urls(spark):
    long = "x" * 2_000_000
    got = judge(spark, [f"http://example.org/es/{long}", f"http://{long}.com/de/a", "http://a.net/" + "a/b-c." * 200_000 + "casino", "http://" + long, long], [*PATTERNS, *RULES])
    assert [(g[2], g[3]) for g in got] == [("example.org/es/", "block"), ("com/de/", "block"), (None, "block"), (None, "allow"), (None, "allow")]
    assert [len(g[0]) + len(g[1]) for g in got] == [11 + 4 + len(long), len(long) + 4 + 5, 5 + 1 + 6 * 200_000 + 6, len(long), 0]
