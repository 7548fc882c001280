"""URL filters: many pattern rules, of which only a few are tried on each url.

A rule is indexed by one literal token that every url it fits must have, the rarest one among the urls at hand. The
tokens of a url fetch its candidate rules by an equi-join, and only those run their regular expressions.
Rules without a whole token are candidates of every url.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("host", "path", "rule", "verdict", "pattern")


class Rule(NamedTuple):
    """`text` of a site rule is a host, which stands for its subdomains too, and the start of a path. The text of a pattern
    rule fits anywhere in host and path, small or capital: `*` is any text, `^` the edge of a run of letters and digits."""
    text: str
    action: str
    site: bool = True

    def regex(self) -> str:
        if self.site:
            return r"\A(?:[^/]*\.)?" + re.escape(self.text)
        parts = {"*": ".*", "^": r"(?:(?<![a-z0-9])(?=[a-z0-9])|(?<=[a-z0-9])(?![a-z0-9]))"}
        return "(?is)" + "".join(parts.get(c, re.escape(c)) for c in self.text)

    def tokens(self) -> list[str]:
        """Tokens that every fitting url has as a whole."""
        if self.site:
            text = "." + self.text.translate(str.maketrans(UPPER, LOWER))
            return re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", text)
        return re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", self.text.lower())


#: Words of hosts and paths that the patterns block where no site rule fits.
UNWANTED = ("ads", "adult", "bets", "casino", "malware", "phishing", "pills", "porn", "spam", "viagra", "xxx")
PATTERNS = tuple(Rule(f"^{word}^", BLOCK, False) for word in UNWANTED)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for null and where `://` is missing."""
    form = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, form, i), F.lit("")) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def url_verdicts(urls: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Rows of `urls` with `host`, `path`, `rule` (the longest site rule that fits, or null), `verdict` (its action; else block
    where a pattern rule that blocks fits and none that allows is longer; else allow) and `pattern` (that pattern rule).

    Of equally long rules a blocking one counts, then the first by text. Each distinct url is judged once. Null urls and those
    without `://` have no host, so no site rule fits them. Repeated rows repeat; without rules all is allowed; columns named like an added one are
    replaced. Select what is needed before calling: every column of `urls` is carried along."""
    spark = urls.sparkSession
    if url in ADDED:
        raise ValueError(f"the column of urls must not be named {url}")
    own = [c for c in urls.columns if c not in (*ADDED, "u")]
    host, path = url_parts(F.col(url))
    rows = urls.select(*own, host.alias("host"), path.alias("path"))
    target = F.concat(*url_parts(F.col("u")))
    small = F.translate(F.col("target"), UPPER, LOWER)
    tokens = F.array_append(F.array_distinct(F.regexp_extract_all(small, F.lit("[a-z0-9]+"), 0)), F.lit(""))
    seen = (urls.select(F.col(url).alias("u")).where("u is not null").distinct().select("u", target.alias("target"))
            .select("u", "target", F.explode(tokens).alias("token")))

    listed = [(r.text, r.action, r.site, r.regex(), sorted(set(r.tokens())) or [""]) for r in dict.fromkeys(rules)]
    table = spark.createDataFrame(listed, "text string, action string, site boolean, regex string, tokens array<string>")
    of_rule = table.select("text", "action", "site", "regex", F.explode("tokens").alias("token"))
    often = seen.join(of_rule.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = W.partitionBy("text", "action", "site").orderBy(F.coalesce("urls", F.lit(0)), "token")
    index = of_rule.join(often, "token", "left").withColumn("place", F.row_number().over(rarest)).where("place = 1")

    fits = seen.join(index.select("token", "text", "action", "site", "regex"), "token").where(F.rlike("target", F.col("regex")))
    first = F.struct((-F.length("text")).alias("size"), (F.col("action") != BLOCK).alias("allows"), "text", "action")
    won = fits.groupBy("u").agg(F.min(F.when(F.col("site"), first)).alias("site"), F.min(F.when(~F.col("site"), first)).alias("other"))
    names = won.select("u", F.col("site.text").alias("rule"), F.coalesce("site.action", "other.action").alias("verdict"), F.col("other.text").alias("pattern"))
    joined = rows.join(names, F.col(url) == F.col("u"), "left")
    return joined.select(*own, "host", "path", "rule", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"), "pattern")
