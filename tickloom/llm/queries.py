"""The registered queries of this subpackage and the SQL that checks them where SQL can."""

import os

from pyspark.sql import functions as F

from tickloom.llm.audit import filter_audit
from tickloom.llm.decontaminate import contamination
from tickloom.llm.fingerprints import fingerprints
from tickloom.llm.jaccard import jaccard_components
from tickloom.llm.license_texts import TEMPLATES
from tickloom.llm.licenses import scan_licenses
from tickloom.llm.packing import pack
from tickloom.llm.pages import main_text
from tickloom.llm.pii import pseudonymise
from tickloom.llm.quality import quality_scores
from tickloom.llm.sharding import shard
from tickloom.llm.toxicity import toxicity_scores
from tickloom.llm.urls import PATTERNS, UNWANTED, Rule, url_verdicts
from tickloom.llm.whitening import whiten
from tickloom.plans.registry import query
from tickloom.plans.tables import load

#: Where the vocabulary files of public tokenizers are, the same on every machine.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
SQL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def pii_key(spark):
    """The key of the pseudonyms, a secret of the cluster in `PII_KEY`. Whoever has it can undo them, so only a local session may go
    without one."""
    key = os.environ.get("PII_KEY")
    if not key and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set PII_KEY to a secret key")
    return key or "a key for tests"


SITE_RULES = [Rule("org/", "allow"), Rule("example.org/es/", "block"), Rule("example.org/en/1", "block"), Rule("com/fr/", "allow"), Rule("com/de/", "block")]


@query("op1_urls", f"""
WITH parts AS (
  SELECT page_id, {SQL_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path, row_number() OVER () AS line FROM pages),
rules(host, path, action) AS (VALUES {", ".join("('" + r.text.partition("/")[0] + "', '/" + r.text.partition("/")[2] + "', '" + r.action + "')" for r in SITE_RULES)}),
fits AS (
  SELECT line, r.host || r.path AS rule, action,
         row_number() OVER (PARTITION BY line ORDER BY length(r.host || r.path) DESC, action DESC, r.host || r.path) AS place
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN regexp_matches({SQL_LOWER.format("host || path")}, '(^|[^a-z0-9])({"|".join(UNWANTED)})($|[^a-z0-9])') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (line)""")
def op1_urls(spark, sf_dir):
    judged = url_verdicts(load(spark, sf_dir, "pages").select("page_id", "url"), SITE_RULES + list(PATTERNS))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_WORDS = "regexp_extract_all(" + SQL_LOWER.format("{0}") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_PAIRS = "unnest(list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda z: z[1] || ' ' || z[2]))"


@query("op2_licenses", f"""
WITH names(t, license, body) AS (VALUES {", ".join(f"({k}, '{name}', '" + body.replace("'", "''") + "')" for k, (name, body) in enumerate(TEMPLATES))}),
grams AS (SELECT DISTINCT t, license, {_PAIRS} AS pair FROM (SELECT t, license, {_WORDS.format("body")} AS w FROM names)),
template AS (SELECT *, count(*) OVER (PARTITION BY t) AS size FROM grams),
lines AS (SELECT doc_id, coalesce(text, '') AS part FROM documents
  UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents
  UNION ALL SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) FROM documents),
part AS (SELECT doc_id, p, w FROM (SELECT doc_id, row_number() OVER () AS p, {_WORDS.format("part")} AS w FROM lines) WHERE len(w) > 1),
pairs AS (SELECT DISTINCT doc_id, p, {_PAIRS} AS pair FROM part),
sizes AS (SELECT p, count(*) AS n FROM pairs GROUP BY p),
common AS (SELECT doc_id, p, t, license, n, size, count(*) AS c FROM pairs JOIN template USING (pair) JOIN sizes USING (p) GROUP BY ALL),
hits AS (SELECT doc_id, license, max(2 * c / CAST(n + size AS DOUBLE)) AS dice FROM common WHERE 200 * c >= 80 * (n + size) GROUP BY 1, 2),
best AS (SELECT doc_id, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice, string_agg(license, ',' ORDER BY license) AS licenses FROM hits GROUP BY 1)
SELECT doc_id, license, dice, coalesce(licenses, '') AS licenses FROM documents LEFT JOIN best USING (doc_id)""")
def op2_licenses(spark, sf_dir):
    return scan_licenses(load(spark, sf_dir, "documents"), keep=["doc_id"])


@query("op6_jaccard", f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
runs AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS run FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM doc WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM runs x JOIN runs y USING (run) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT b, c FROM reach JOIN links ON a = doc_id)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""")
def op6_jaccard(spark, sf_dir):
    return jaccard_components(load(spark, sf_dir, "documents"))


@query("op7_decontaminate", f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS words FROM (
    SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS words FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, p, size FROM runs JOIN windows USING (size, words)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY 1),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(l.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered c USING (doc_id) LEFT JOIN listed l USING (doc_id)""")
def op7_decontaminate(spark, sf_dir):
    found = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op3_packing")
def op3_packing(spark, sf_dir):
    return pack(load(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


@query("op9_quality")
def op9_quality(spark, sf_dir):
    scored = quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op10_pii")
def op10_pii(spark, sf_dir):
    return pseudonymise(load(spark, sf_dir, "documents"), pii_key(spark)).select("doc_id", "text", "n_values")


@query("op4_sharding")
def op4_sharding(spark, sf_dir):
    placed = shard(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op8_fingerprints")
def op8_fingerprints(spark, sf_dir):
    return fingerprints(load(spark, sf_dir, "documents"))


@query("op5_html")
def op5_html(spark, sf_dir):
    return main_text(load(spark, sf_dir, "pages"), keep=["page_id", "url"])


@query("op11_audit", f"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
masks AS (
  SELECT doc_id, part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM doc),
marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1),
counts AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
           FROM masks LEFT JOIN marks USING (doc_id) GROUP BY ALL),
f(l, own) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.own, w.own, x.own, y.own, z.own] AS owns
           FROM f v, f w, f x, f y, f z WHERE v.own + w.own + x.own + y.own + z.own = 31 AND v.own | w.own | x.own | y.own | z.own = 31),
steps AS (SELECT filter_order, CAST(k AS INT) AS step, owns[k] AS own, coalesce(list_sum(owns[1:k - 1]), 0)::INT AS before FROM orders, range(1, 6) t(k))
SELECT part, filter_order, step,
       CAST(sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
       CAST(sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
       CAST(sum(CASE WHEN mask & before <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
       CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
       CAST(sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
       CAST(sum(CASE WHEN mask & before = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
       CAST(sum(CASE WHEN mask & own <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley
FROM counts, steps GROUP BY ALL""")
def op11_audit(spark, sf_dir):
    return filter_audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whiten(load(spark, sf_dir, "embeddings"))


@query("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    scored = toxicity_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")
