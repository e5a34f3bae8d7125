"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, embedding_dedup, html_text, importance, langid, packing, secret_scan, sharding, simhash, token_store, toxicity, url_filter
from .common import shared_dir, table

WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
SHARDS = tuple(f"shard-{i:02d}" for i in range(48))
URL_RULES = (
    url_filter.prefix_rule("net", "/", "block"),
    url_filter.prefix_rule("example.net", "/en/", "allow"),
    url_filter.prefix_rule("example.com", "/de/", "block"),
    url_filter.prefix_rule("org", "/fr/", "allow"),
)


#: Words of pages that no corpus wants: shops, gambling, adult and pirated goods, and pages that hold no text.
UNWANTED = (
    "backlinks basket betting calendar cart casino checkout cialis crack escort essays feed jackpot keygen loans login logout lottery nulled nude payday "
    "pharmacy pills poker porn print register replica roulette rss serials sex signin signup slots torrent viagra warez webcam wishlist xxx"
).split()
#: Where such a word stands: a label of the host, a part of one, a step of the path, a script, a part of a step.
SHAPES = {
    "label": r"^(?:[^/]*\.)?{}\.",
    "host": r"^[^/]*-{}[.-]",
    "step": r"/{}(?:/|$)",
    "script": r"/{}\.(?:php|aspx?|html?)$",
    "part": r"/[^/]*-{}(?:[-./]|$)",
}
PATTERN_RULES = tuple(url_filter.pattern_rule(f"{shape}:{word}", "block", pattern.format(word), (word,)) for word in UNWANTED for shape, pattern in SHAPES.items())


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit(table(spark, sf_dir, "documents"))
    return langid.identify_pages(table(spark, sf_dir, "pages"), model)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS).select("doc_id", "slot", "shard", "shard_name")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/stores/{uuid.uuid4().hex}"
    token_store.write_store(table(spark, sf_dir, "documents"), out, tokenizer_path(WORD_TOKENIZER), end_id=1)
    return token_store.digests(token_store.read_store(spark, out))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), end_id=2)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), (*URL_RULES, *PATTERN_RULES))
    # what a pattern decides is the method's verdict, under no rule of the list
    listed = F.when(F.col("rule").isin(*(r.name for r in URL_RULES)), F.col("rule"))
    return judged.select("page_id", "host", "path", listed.alias("rule"), "verdict")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(table(spark, sf_dir, "documents")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_html": op3_html,
    "op4_sharding": op4_sharding,
    "op5_tokens": op5_tokens,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_decontamination": op8_decontamination,
    "op9_embeddings": op9_embeddings,
    "op10_urls": op10_urls,
    "op11_divergence": op11_divergence,
    "op12_secrets": op12_secrets,
    "op13_importance": op13_importance,
}


def _sharding_sql() -> str:
    owner = ",".join(map(str, sharding.fill(SHARDS)))
    return f"""
    WITH t AS (SELECT string_split('{owner}', ',') AS owner),
    s AS (SELECT doc_id, (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N')), 1, 15))::BIGINT % {sharding.SLOTS})::INTEGER AS slot FROM documents)
    SELECT doc_id, slot, owner[slot + 1]::INTEGER AS shard, 'shard-' || lpad(owner[slot + 1], 2, '0') AS shard_name FROM s, t
    """


_WORDS = f"({'|'.join(UNWANTED)})"
_URL_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(h, pre, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(v, length(h || pre)) AS verdict
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id),
w AS (
  SELECT page_id, regexp_matches('.' || host, '[.]{_WORDS}[.]') OR regexp_matches(host || '/', '-{_WORDS}[.-]')
    OR regexp_matches(path, '/{_WORDS}(/|$|[.](php|asp|aspx|htm|html)$)') OR regexp_matches(path, '/[^/]*-{_WORDS}([-./]|$)') AS unwanted FROM p)
SELECT p.page_id, host, path, rule, coalesce(verdict, CASE WHEN unwanted THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN m USING (page_id) JOIN w USING (page_id)
"""

#: All pairs, and reachability row by row: for small tables.
_EMBEDDING_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT *, sqrt(list_sum([x * x FOR x IN e])) AS size FROM v),
u AS (SELECT r, len(e) AS d, [x / size FOR x IN e] AS w FROM n WHERE isfinite(size) AND size > 0 AND NOT list_contains([x IS NULL FOR x IN e], true)),
l AS (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.d = b.d AND a.r <> b.r WHERE list_dot_product(a.w, b.w) >= 0.95),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
c AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
k AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (r) LEFT JOIN k USING (r)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWERED} AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN v USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
voc AS (SELECT lang, count(*) AS v, sum(n) AS total FROM v GROUP BY lang),
p AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(tot.total, 0) + 2 * voc.v) AS p,
         1 + (1000000000::HUGEINT * (v.n + 2)) // (voc.total + 2 * voc.v) AS q
  FROM g JOIN v USING (lang) JOIN voc USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN tot USING (lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: CRC-32 byte by byte, over the table of its polynomial, once for each distinct feature.
_IMPORTANCE_SQL = f"""
WITH poly AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS crc),
texts AS (SELECT true AS mine, row_number() OVER () AS r, doc_id, {_LOWERED} AS text FROM documents UNION ALL SELECT false, row_number() OVER (), NULL, {_LOWERED} FROM benchmark),
cut AS MATERIALIZED (SELECT mine, r, doc_id, regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
word AS (SELECT mine, r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM cut),
run AS (SELECT mine, r, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM word WINDOW w AS (PARTITION BY mine, r ORDER BY i)),
feature AS (SELECT mine, r, f, count(*) AS n FROM (SELECT mine, r, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c]) AS f FROM run) WHERE f IS NOT NULL GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM feature)),
hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, poly.crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS k
  FROM hexed, poly),
filled AS MATERIALIZED (SELECT mine, r, k, n FROM feature JOIN hashed USING (f)),
bucket AS (SELECT k, coalesce(sum(n) FILTER (mine), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT mine), 0)::DOUBLE AS t FROM filled GROUP BY k),
whole AS (SELECT coalesce(sum(s), 0)::DOUBLE AS S, coalesce(sum(t), 0)::DOUBLE AS T FROM bucket),
gain AS (SELECT k, floor(1000 * ln((bucket.t + 1) * (whole.S + 10000) / ((bucket.s + 1) * (whole.T + 10000))))::BIGINT AS gain FROM bucket, whole),
weight AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM filled JOIN gain USING (k) WHERE mine GROUP BY r),
scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM cut LEFT JOIN weight USING (r) WHERE mine),
drawn AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS k, count(*) FILTER (n_words >= 20) OVER () AS fit FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= 5 * fit // 100 THEN k END AS rank FROM drawn
"""

ORACLE_SQL = {
    "op4_sharding": _sharding_sql(),
    "op9_embeddings": _EMBEDDING_SQL,
    "op10_urls": _URL_SQL,
    "op11_divergence": _DIVERGENCE_SQL,
    "op13_importance": _IMPORTANCE_SQL,
}
