"""One query for each operator over its whole table, with SQL where that can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.llm import bpe, decontaminate, hard_negatives, lm, merkle, near_dup, pii, quality, substring_dup, toxicity, url_rules, warc, window_dup
from tablejobs.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return register


@_query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
OP2_SQL = """
WITH r(rule, h, p, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM a),
m AS (SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS rk
  FROM b LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE rk = 1
"""


@_query("op2_url_filter", OP2_SQL)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


@_query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), bpe.default_path())


@_query("op4_minhash_near_dedup")
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op5_repeated_passages")
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dup.repeated_passages(table(spark, sf_dir, "documents"))
    listed = F.expr("array_join(transform(spans, s -> concat(s.first, ':', s.last)), ',')")
    return found.withColumn("spans", listed)


LATER = 5005  # a page is asked for again when about 500 more have been fetched
OP6_SQL = f"""
WITH p AS (SELECT page_id, url, substr(sha1(coalesce(html, '')), 1, 16) AS tag,
  CASE WHEN strpos(url, '://') = 0 THEN NULL ELSE regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?', '') END AS rest FROM pages),
q AS (SELECT page_id, url, tag, rest, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), ':(80|443)$', ''), '^www[0-9]*[.]', '') AS host,
  regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*[?](.*)$', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)'))) AS args FROM p),
k AS (SELECT page_id, tag, CASE WHEN rest IS NULL THEN url ELSE host || path || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS url_key FROM q),
best AS (SELECT v.page_id, v.url_key, v.tag, f.page_id AS source, f.tag AS source_tag,
    row_number() OVER (PARTITION BY v.page_id ORDER BY f.page_id DESC NULLS LAST) AS rk
  FROM k v LEFT JOIN k f ON v.url_key = f.url_key AND 10 * f.page_id < 10 * v.page_id + {LATER})
SELECT 2 * page_id AS record_id, page_id, url_key, 'response' AS type, page_id AS source_page, 'full' AS status,
  'content-type=text/html;date=' || 10 * page_id || ';etag="' || tag || '"' AS headers FROM k
UNION ALL
SELECT 2 * page_id + 1, page_id, url_key, 'revisit', CASE WHEN tag = source_tag THEN source END,
  CASE WHEN source IS NULL THEN 'missing' WHEN tag = source_tag THEN 'resolved' ELSE 'changed' END,
  CASE WHEN tag = source_tag THEN 'content-type=text/html;' ELSE '' END || 'date=' || (10 * page_id + {LATER}) || ';etag="' || tag || '"'
    || CASE WHEN tag = source_tag THEN '' ELSE ';server=again' END
FROM best WHERE rk = 1
"""


@_query("op6_warc_revisits", OP6_SQL)
def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a full response and, later, as a revisit with the entity tag it had then."""
    tag = F.substring(F.sha1(F.coalesce("html", F.lit(""))), 1, 16)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", tag.alias("digest"))
    etag = "'etag', concat('\"', digest, '\"')"
    first = pages.selectExpr(
        "2 * page_id as record_id", "url", "10 * page_id as time", "'response' as type", "digest",
        f"map({etag}, 'date', string(10 * page_id), 'content-type', 'text/html') as headers",
    )
    later = pages.selectExpr(
        "2 * page_id + 1 as record_id", "url", f"10 * page_id + {LATER} as time", "'revisit' as type", "digest",
        f"map({etag}, 'date', string(10 * page_id + {LATER}), 'server', 'again') as headers",
    )
    found = warc.resolve_revisits(first.unionByName(later))
    listed = "array_join(transform(array_sort(map_entries(headers)), e -> concat(e.key, '=', e.value)), ';') as headers"
    return found.selectExpr("record_id", "record_id div 2 as page_id", "url_key", "type", "source_id div 2 as source_page", "status", listed)


_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP7_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
d AS (SELECT doc_id, text, list_filter(string_split(translate(text, {_BLANKS}, '     '), ' '), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: trim(translate(x, {_BLANKS}, '     ')) <> '') AS l FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR (n_dup_lines >= 5 AND 2 * n_dup_lines > n_lines) OR word_chars > 25 * n_words
    OR 10 * n_capitals > 4 * word_chars) AS kept
FROM b
"""


@_query("op7_quality_rules", OP7_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@_query("op8_lm_scores")
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.scores(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


@_query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


# A word of another class than the library's: split after all other characters have become blanks.
_WORDS = r"list_filter(string_split(regexp_replace(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '')"
OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.n, p.i, g.item_id
  FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM places) p JOIN grams g ON p.n = g.n AND p.g = g.g
),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@_query("op10_decontaminate", OP10_SQL)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label, CAST(list_sum(list_transform(list_zip(a.q, c.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.q) = len(c.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT anchor_id, vec_id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS rk FROM s WHERE label = own) WHERE rk <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rk
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rk AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rk <= 5
"""


@_query("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth row is an anchor; every seventh has the next label."""
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return hard_negatives.Index(vectors, F.col("vec_id") % 100 == 0).mine()


# crc32 of a text, bit by bit: a byte is taken in, then eight steps (-1) follow.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({x}, ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, o: CASE WHEN o >= 0 THEN xor(a, o) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""
_FIELD = "coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
_FIELDS = " || ".join(_FIELD.format(x=x) for x in ("doc_id", "source", "lang", "{n_chars}", "text"))
OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_FIELDS.format(n_chars="n_chars")}) AS leaf,
    CASE WHEN {_CRC.format(x="CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN sha256({_FIELDS.format(n_chars="(n_chars + 1)")}) END AS other FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaves),
up AS (SELECT g, 0 AS k, p, n, leaf AS h FROM d UNION ALL
  SELECT g, k + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM up WHERE n > 1 GROUP BY g, k, p // 2, n),
subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM up WHERE n = 1),
tops AS (SELECT 0 AS k, p, n, subroot AS h FROM subroots UNION ALL
  SELECT k + 1, p // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY p)) FROM tops WHERE n > 1 GROUP BY k, p // 2, n),
steps AS (
  SELECT d.doc_id, d.leaf, d.p AS pos, u.k, (d.p >> u.k) & 1 AS slot, s.h FROM d JOIN (SELECT DISTINCT g, k FROM up WHERE n > 1) u USING (g)
    LEFT JOIN up s ON s.g = d.g AND s.k = u.k AND s.p = xor(d.p >> u.k, 1)
  UNION ALL
  SELECT d.doc_id, d.leaf, d.p, 100 + u.k, (r.p >> u.k) & 1, s.h FROM d JOIN subroots r USING (g) CROSS JOIN (SELECT DISTINCT k FROM tops WHERE n > 1) u
    LEFT JOIN tops s ON s.k = u.k AND s.p = xor(r.p >> u.k, 1)),
listed AS (SELECT doc_id, leaf, pos, list(struct_pack(slot := slot, h := coalesce(h, '')) ORDER BY k) AS steps FROM steps GROUP BY ALL),
folded AS (
  SELECT d.doc_id, d.leaf, d.g, d.p, coalesce(steps, []) AS steps, 0 AS k, coalesce(other, d.leaf) AS h FROM d LEFT JOIN listed l ON l.doc_id = d.doc_id AND l.leaf = d.leaf AND l.pos = d.p
  UNION ALL
  SELECT doc_id, leaf, g, p, steps, k + 1, sha256(CASE steps[k + 1].slot WHEN 0 THEN h || steps[k + 1].h ELSE steps[k + 1].h || h END) FROM folded WHERE k < len(steps))
SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(array_to_string(list_transform(steps, lambda s: s.h), '')) AS proof_sha256,
  h AS folded_root, h = (SELECT h FROM tops WHERE n = 1) AS verified FROM folded JOIN subroots USING (g) WHERE k = len(steps)
"""


@_query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language; where 7 divides the checksum of the id, the row is shown with one more in ``n_chars``."""
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    rows = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "lang", {"n_chars": more})
    found = merkle.verify(rows).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@_query("op13_substring_dedup")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dup.digests(table(spark, sf_dir, "documents"))


@_query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
