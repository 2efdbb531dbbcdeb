"""The queries of the ten operators and of the pipeline, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from threadloom.llm import (
    centroids, decontaminate, fingerprints, importance, langid, linededup, lm, mixing, pii, simhash, tokens, urls, warc,
)
from threadloom.llm.common import LOWER, UPPER, prepare, read, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The rules of the URL contract, as (host, path, verdict).
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_line_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, o.top IS NOT NULL AND k.doc_id < o.top AS gone
  FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, sum(gone::BIGINT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op2_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100
""")
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_lm_score", f"""
WITH t AS (
  SELECT doc_id, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS s FROM documents),
p AS (SELECT doc_id, chr(1) || chr(1) || s AS s, unnest(range(1, length(s) + 1)) AS i FROM t),
g AS (SELECT doc_id, substr(s, i, 3) AS k, count(*) AS tf FROM p GROUP BY 1, 2),
c AS (SELECT k, sum(tf) AS n FROM g GROUP BY 1),
n3 AS (SELECT k, n FROM c), m3 AS (SELECT substr(k, 1, 2) AS k, sum(n) AS n FROM c GROUP BY 1),
n2 AS (SELECT substr(k, 2, 2) AS k, sum(n) AS n FROM c GROUP BY 1),
m2 AS (SELECT substr(k, 2, 1) AS k, sum(n) AS n FROM c GROUP BY 1),
n1 AS (SELECT substr(k, 3, 1) AS k, sum(n) AS n FROM c GROUP BY 1),
m1 AS (SELECT sum(n) AS n FROM c),
s AS (
  SELECT c.k, CASE WHEN n3.n >= {lm.MIN_COUNT} THEN ln(n3.n / m3.n)
                   WHEN n2.n >= {lm.MIN_COUNT} THEN ln(n2.n / m2.n) + ln({lm.BACKOFF})
                   ELSE ln(n1.n / m1.n) + 2 * ln({lm.BACKOFF}) END AS log_s
  FROM c JOIN n3 ON n3.k = c.k JOIN m3 ON m3.k = substr(c.k, 1, 2) JOIN n2 ON n2.k = substr(c.k, 2, 2)
  JOIN m2 ON m2.k = substr(c.k, 2, 1) JOIN n1 ON n1.k = substr(c.k, 3, 1) CROSS JOIN m1),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n, sum(tf * log_s) AS l FROM g JOIN s ON g.k = s.k GROUP BY 1)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_units, round(coalesce(l, 0.0), 4) AS log_score,
       round(l / n, 6) AS mean_log_score
FROM t LEFT JOIN d ON t.doc_id = d.doc_id
""")
def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_documents(read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_units", F.round("log_score", 4).alias("log_score"),
                         F.round("mean_log_score", 6).alias("mean_log_score"))


@query("op4_word_lm_score", f"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
g AS (SELECT doc_id, CASE WHEN i > 1 THEN w[i - 1] ELSE '' END AS a, w[i] AS b, count(*) AS tf FROM p GROUP BY ALL),
n2 AS (SELECT a, b, sum(tf) AS n2 FROM g GROUP BY ALL), m2 AS (SELECT a, sum(tf) AS m2 FROM g GROUP BY ALL),
n1 AS (SELECT b, sum(tf) AS n1 FROM g GROUP BY ALL), m1 AS (SELECT sum(tf) AS m1 FROM g),
d AS (
  SELECT doc_id, sum(tf)::BIGINT AS n, sum(tf * CASE WHEN n2 >= {lm.MIN_COUNT} THEN ln(n2 / m2)
                                                     ELSE ln(n1 / m1) + ln({lm.BACKOFF}) END) AS l
  FROM g JOIN n2 USING (a, b) JOIN m2 USING (a) JOIN n1 USING (b) CROSS JOIN m1 GROUP BY 1)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_units, round(coalesce(l, 0.0), 4) AS log_score,
       round(l / n, 6) AS mean_log_score
FROM t LEFT JOIN d ON t.doc_id = d.doc_id
""")
def word_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_words(read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_units", F.round("log_score", 4).alias("log_score"),
                         F.round("mean_log_score", 6).alias("mean_log_score"))


@query("op5_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op6_url_filter", """
WITH r(host, path, verdict) AS (VALUES %s),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
p AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
q AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM p),
h AS (SELECT q.page_id, q.host, q.path, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY q.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
      FROM q LEFT JOIN r ON (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM h WHERE n = 1
""" % ", ".join(str(r) for r in RULES))
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = urls.judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op7_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


@query("op8_token_ids")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens").path("ids")
    tokens.write_ids(read(spark, sf_dir, "documents"), path, tokenizer_path())
    return tokens.read_documents(spark, path)


@query("op9_decontamination", """
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') FROM benchmark),
p AS (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5),
s AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM p),
n AS (SELECT id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY 1),
f AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS found
      FROM s d JOIN s i ON d.s = i.s AND d.kind = 'd' AND i.kind = 'i' GROUP BY 1, 2)
SELECT doc_id, item_id, n::BIGINT AS n_shingles, found::BIGINT AS n_found, found / n AS containment
FROM f JOIN n ON n.id = f.item_id WHERE found >= ceil(n * 0.8 - 1e-9)
""")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", corpus_pipeline.held_out())
    model = langid.fit(docs.filter("not held_out"))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def pii_sql() -> str:
    """The same search over RE2: candidates with their places, validators, second looks, scores."""
    def candidates(name: str, text: str, pattern: str) -> str:
        quoted = pattern.replace("'", "''")
        return f"""
  SELECT rid, '{name}' AS rule, unnest(h) AS v, unnest(g[:-2]) AS gap, unnest(g[2:]) AS after, generate_subscripts(h, 1) AS i
  FROM (SELECT rid, regexp_extract_all({text}, '{quoted}') AS h, string_split_regex({text}, '{quoted}') AS g FROM {"d" if text == "t" else "left_" + name[:-6]})"""

    def placed(parts: list[str]) -> str:
        return f"""
  SELECT *, sum(length(gap) + length(v)) OVER (PARTITION BY rid, rule ORDER BY i) - length(v) AS start,
         translate(right(gap, {pii.NEAR}) || ' ' || left(after, {pii.NEAR}), '{UPPER}', '{LOWER}') AS near,
         regexp_replace(v, '[^0-9]', '', 'g') AS digits, replace(v, ' ', '') AS bare
  FROM ({" UNION ALL ".join(parts)})"""

    luhn = """list_sum(list_transform(range(1, length(digits) + 1), lambda k:
      CASE WHEN k % 2 = 1 THEN digits[-k]::INT WHEN digits[-k]::INT > 4 THEN 2 * digits[-k]::INT - 9 ELSE 2 * digits[-k]::INT END)) % 10 = 0"""
    turned = "substr(bare, 5) || substr(bare, 1, 4)"
    valid = f"""CASE split_part(rule, '_', 1) WHEN 'ip' THEN regexp_matches(v, '{pii.IP}')
    WHEN 'card' THEN CASE WHEN length(digits) BETWEEN 14 AND 19 THEN {luhn} ELSE false END
    WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
    WHEN 'iban' THEN length(bare) BETWEEN 15 AND 34 AND (list_reduce(list_prepend(0, list_transform(string_split({turned}, ''),
      lambda x: instr('{pii.ALNUM}', x) - 1)), lambda a, b: (a * CASE WHEN b < 10 THEN 10 ELSE 100 END + b) % 97)) = 1
    ELSE true END AS valid"""
    kinds = ", ".join(f"('{k}', {i}, '{pii.nearby(pii.WORDS[k])}')" for i, k in enumerate(pii.KINDS))
    worth = ", ".join(f"('{name}', {rule.worth})" for name, rule in [
        *pii.RULES.items(), *[(f"{k}_again", r) for k, r in pii.AGAIN.items()]])
    left = ",".join(f"""
left_{k} AS (
  SELECT rid, string_agg(gap || CASE WHEN valid THEN repeat('#', length(v)) ELSE v END, '' ORDER BY i) || max_by(after, i) AS m
  FROM one WHERE rule = '{k}' GROUP BY rid HAVING NOT bool_and(valid))""" for k in pii.AGAIN)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
kinds(kind, rank, words) AS (VALUES {kinds}), worths(rule, worth) AS (VALUES {worth}),
one AS MATERIALIZED (SELECT *, {valid} FROM ({placed([candidates(n, "t", r.plain) for n, r in pii.RULES.items()])})),{left},
two AS (SELECT *, {valid} FROM ({placed([candidates(f"{n}_again", "m", r.plain) for n, r in pii.AGAIN.items()])})),
spans AS (
  SELECT rid, kind, rank, start, kind || ':' || start || ':' || (start + length(v)) AS s, rule = kind AND rank < {len(pii.BASE)} AS base,
         worth + CASE WHEN regexp_matches(near, words) THEN {pii.RAISE} ELSE 0 END
         - CASE WHEN regexp_matches(near, '{pii.nearby(pii.SAMPLE_WORDS)}') THEN {pii.LOWER_BY} ELSE 0 END AS score
  FROM (SELECT * FROM one UNION ALL SELECT * FROM two) JOIN worths USING (rule) JOIN kinds ON kind = split_part(rule, '_', 1)
  WHERE valid)
SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE base AND kind = '{k}') AS n_{k}" for k in pii.BASE)},
       sha256(coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (WHERE base), '')) AS base_sha256,
       coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (WHERE base OR round(score, 2) >= {pii.ACCEPT}), '') AS spans
FROM d LEFT JOIN spans USING (rid) GROUP BY rid, doc_id"""


@query("op11_pii", pii_sql())
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(read(spark, sf_dir, "documents").select("doc_id", "text")))


def centroid_sql() -> str:
    """The rounds one by one: all distances, the nearest centroid, exact floors of the means."""
    size, k = centroids.SIZE, centroids.CLUSTERS
    parts = [f"""
e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings WHERE len(embedding) = {size}),
v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(x, lambda y: floor({centroids.SCALE} * y)::BIGINT) AS v FROM e
  WHERE len(list_filter(x, lambda y: y IS NOT NULL AND isfinite(y))) = {size}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v AS c FROM v
  QUALIFY k < {k})"""]
    for i in range(centroids.ROUNDS + 1):
        parts.append(f"""
d{i} AS (SELECT rid, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{i}),
a{i} AS MATERIALIZED (SELECT rid, arg_min(k, (d, k)) AS k, min(d) AS d FROM d{i} GROUP BY rid)""")
        if i < centroids.ROUNDS:
            parts.append(f"""
m{i} AS (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM (
    SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM (
      SELECT k, unnest(v) AS x, unnest(range(1, {size + 1})) AS j FROM v JOIN a{i} USING (rid)) GROUP BY k, j) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (k))""")
    last = centroids.ROUNDS
    return f"""WITH {",".join(parts)}
SELECT vec_id, k::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
       sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a{last} USING (rid) JOIN c{last} USING (k)"""


@query("op12_centroids", centroid_sql())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read(spark, sf_dir, "embeddings"))


@query("op13_importance")
def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
