"""Registered queries of the operators, and DuckDB twins of those that SQL expresses."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, decontam, htmltext, importance, lm, mixing, phrases, pii, quality, simhash, tokenfiles, urlfilter
from .common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: The rules of the URL filter, the share of its pages that they must block to put a host on
#: the list, and the host-name parts that do so too.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]
BLOCKED_SHARE = 0.25
BLOCK_TERMS = ("ads", "adult", "bets", "casino", "pills", "spam")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_files(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.rendered(table(spark, sf_dir, "pages"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    named = urlfilter.located(pages).select(F.col("host").alias("key")).where(urlfilter.has_term(F.col("key"), BLOCK_TERMS))
    return urlfilter.url_filter(pages, URL_RULES, urlfilter.blocked_hosts(pages, URL_RULES, BLOCKED_SHARE).union(named))


def op7_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.without_repeats(table(spark, sf_dir, "documents"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"), lm.held_out(F.col("doc_id")))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.ByteBPE(spark, RANKS, public_tokenizers.PATTERN)
    out = codec.decoded(codec.encoded(table(spark, sf_dir, "documents")))
    return out.select("doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.Clustering().fit(table(spark, sf_dir, "embeddings")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_token_files, op3_simhash, op4_html_text, op5_personal_data, op6_url_filter, op7_repeated_phrases, op8_language_model, op9_decontamination, op10_mixing, op11_byte_bpe, op12_centroids, op13_importance)}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"



def _centroid_sql(rounds: int) -> str:
    """Rounds of assignment and floored means, unrolled."""
    near = """SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT r, c, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - m.v[i]) * (k.v[i] - m.v[i]))) AS d FROM k, m{0} m) GROUP BY r"""
    steps = "".join(f"""
a{n} AS ({near.format(n)}),
s{n} AS (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{n} JOIN k USING (r), unnest(range(1, 65)) AS t(i) GROUP BY c, i),
m{n + 1} AS (
  SELECT c, coalesce(new.v, m{n}.v) AS v
  FROM m{n} LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{n} GROUP BY c) new USING (c)),""" for n in range(rounds))
    return f"""
WITH k AS (
  SELECT row_number() OVER () AS r, vec_id, embedding, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m0 AS (
  SELECT row_number() OVER (ORDER BY h, embedding) - 1 AS c, v
  FROM (SELECT *, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM k ORDER BY h, embedding LIMIT 16)),{steps}
a AS ({near.format(rounds)})
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a JOIN k USING (r) JOIN m{rounds} m USING (c)"""


ORACLES = {
    "op12_centroids": _centroid_sql(3),
    "op7_repeated_phrases": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, {_WORD}), []) AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
first AS (SELECT win, min(doc_id) AS least FROM win GROUP BY win),
gone AS (
  SELECT DISTINCT r, p FROM (SELECT r, i FROM win JOIN first USING (win) WHERE doc_id > least), unnest(range(i, i + 13)) AS t(p)),
word AS (SELECT r, p, w[p] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS text FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)""",
    "op6_url_filter": """
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u),
l AS (
  SELECT host, avg(CASE WHEN rule IS NULL OR rule IN ('com/', 'www.example.com/en/') THEN 0 ELSE 1 END) >= 0.25
           OR list_has_any(string_split_regex(host, '[.-]'), ['ads', 'adult', 'bets', 'casino', 'pills', 'spam']) AS listed
  FROM j GROUP BY host)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict FROM j JOIN l USING (host)""",
    "op9_decontamination": f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM item, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER}, {_ALNUM}), []) AS w FROM documents),
hit AS (
  SELECT r, i, d.l, item
  FROM (SELECT r, i, l, array_to_string(w[i:i + l - 1], ' ') AS win
        FROM doc, (SELECT DISTINCT l FROM win), unnest(range(1, len(w) - l + 2)) AS t(i)) d
  JOIN win USING (l, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, i, l FROM hit), unnest(range(i, i + l)) AS t(p) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)""",
    "op10_mixing": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {_WORD})), 0) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12) AS h FROM documents),
s AS (
  SELECT source, sum(size) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_n,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w
  FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST)),
level AS (SELECT left_n AS n, left_w AS lw FROM r WHERE cap * left_w >= w * left_n ORDER BY cap / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         CASE WHEN cap * lw >= w * n THEN CAST(w * n AS DOUBLE) / CAST(lw AS DOUBLE) ELSE CAST(cap AS DOUBLE) END AS target
  FROM r, level),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS repeats FROM t),
-- rows that share a hash are equal: any order among them takes as many
c AS (
  SELECT d.r, sum(size) OVER (PARTITION BY d.source ORDER BY h, r) - size AS before, target - repeats * source_size AS budget
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
e AS (SELECT c.r, before <= budget AND (budget - before) * 2 > size AS extra FROM c JOIN d USING (r))
SELECT doc_id, size, b.source_size, target, CAST(size * (repeats + CASE WHEN repeats < 3 AND extra THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN e USING (r) JOIN b ON d.source IS NOT DISTINCT FROM b.source""",
    # CRC-32 bit by bit: the first of a byte's eight steps takes the byte in
    "op13_importance": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER}, {_ALNUM}), []) AS w FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark WHERE text IS NOT NULL),
df AS (SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM d),
bf AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM b),
f AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)),
bucket AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(0, len(x) // 2), lambda i:
           [CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295) % 10000 AS bucket FROM f),
s AS (SELECT bucket, count(*) AS s FROM df JOIN bucket USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN bucket USING (f) GROUP BY bucket),
total AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS n_s, (SELECT coalesce(sum(t), 0) FROM t) AS n_t),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (n_s + 10000) AS DOUBLE) / CAST((s + 1) * (n_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), total),
weight AS (
  SELECT r, count(*) AS n, CAST((sum(gain) - ((sum(gain) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS weight
  FROM df JOIN bucket USING (f) JOIN gain USING (bucket) GROUP BY r),
score AS (
  SELECT r, doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weight USING (r)),
scored AS (
  SELECT r, doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM score),
fit AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN CAST(rank AS BIGINT) END AS rank FROM scored LEFT JOIN fit USING (r)""",
}
