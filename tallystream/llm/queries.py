"""The registered queries of this package, each over its whole table, and the SQL that some are checked against."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm import (
    alignment, byte_bpe, chat, collocations, embedding_join, language_id, license_scan, packing, quality, simhash,
    topk_search, url_filter, winnowing)
from tallystream.sources.tables import read_table

#: The vocabulary that op5 encodes with.
VOCABULARY = os.environ.get("BPE_VOCABULARY", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
#: The tokenizers that op12 aligns.
A_FILE = os.environ.get("ALIGN_A_FILE", public_tokenizers.path("byte_bpe_50k.json"))
B_FILE = os.environ.get("ALIGN_B_FILE", public_tokenizers.path("piece_bpe_32k.model"))
#: Decimal places of the ranks that op4 shows; sums of doubles differ by their order behind them.
PLACES = 9


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_join.near_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"), F.col("code_rows").alias("same_fingerprint"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", F.col("quality_score").alias("score"), F.col("quality_kept").alias("kept"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.filter_urls(read_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", F.round("trust", PLACES).alias("trust"),
                        F.round("distrust", PLACES).alias("distrust"))


def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(VOCABULARY)
    encoded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = language_id.judge(read_table(spark, sf_dir, "documents"), declared=F.col("lang"), host=F.col("source"))
    return judged.select(
        "doc_id", F.col("lid_language").alias("language"), F.col("lid_posterior").alias("posterior"),
        F.col("lid_text_language").alias("text_language"), F.col("lid_kept").alias("kept"))


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by all four kinds of evidence: markup language, suffix of the address, host and the hosts beside it."""
    url, html = F.col("url"), F.coalesce("html", F.lit(""))
    host = F.nullif(url_filter.host_of(url), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    pages = read_table(spark, sf_dir, "pages").select("page_id", text.alias("text"), host.alias("host"), F.nullif(
        F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?\s*([A-Za-z-]+)""", 1), F.lit("")).alias("declared"))
    judged = language_id.judge(pages, declared=F.col("declared"), suffix=F.regexp_extract(F.col("host"), r"\.([a-z]+)$", 1), host=F.col("host"))
    return judged.select(
        "page_id", F.col("lid_language").alias("language"), F.col("lid_posterior").alias("posterior"),
        F.col("lid_text_language").alias("text_language"), F.col("lid_kept").alias("kept"))


def chat_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = r"\### Assistant: </turn> ok"
    more = spark.sql("SELECT -7L AS conv_id, stack(2, 0L, 'user', 1L, 'assistant') AS (turn, role)").withColumn("text", F.lit(hard))
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    told = chat.format_trees(chat.chains(rows)).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "learned", chat.learned_text(F.col("formatted"), F.col("loss")))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def best_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_matches(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def phrase_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(read_table(spark, sf_dir, "documents"), A_FILE, B_FILE, with_groups=False)
    return found.drop("groups").withColumnRenamed("id", "doc_id")


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_embedding_near_dedup": embedding_groups,
    "op2_simhash_near_dedup": simhash_groups,
    "op3_quality_classifier": quality_scores,
    "op4_url_filter": url_verdicts,
    "op5_byte_bpe": bpe_digests,
    "op6_license_scan": license_labels,
    "op7_language_id": document_languages,
    "op7_language_id_of_pages": page_languages,
    "op8_chat_format": chat_digests,
    "op9_topk_search": best_matches,
    "op10_best_fit_packing": packed_documents,
    "op11_phrase_collocations": phrase_scores,
    "op12_token_alignment": token_groups,
    "op13_decontamination": benchmark_hits,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_TEMPLATES = ", ".join(
    f"('{label}', '{must}', '{text}', {license_scan.window(text, 0.8)})" for label, must, text in license_scan.TEMPLATES)

ORACLES = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(degree.n, 0)::BIGINT AS n_links, least.m AS component_id, vec_id = least.m AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN degree ON vec_id = degree.a
""",
    "op4_url_filter": f"""
WITH RECURSIVE urls AS MATERIALIZED (
  SELECT page_id, coalesce(html, '') AS html, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_LOWER}) AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS MATERIALIZED (SELECT page_id, html, host, path, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM urls),
owned AS (
  SELECT host, regexp_extract(host, '^[^.]+\\.([^.]+\\..+)$', 1) AS owner FROM (SELECT DISTINCT host FROM urls)),
links AS (
  SELECT host AS src, translate(unnest(list_distinct(regexp_extract_all(
    html, '(?i)(?:href|src)\\s*=\\s*["'']?\\s*(?:https?:)?//([^/?#"''<>\\s]+)', 1))), {_LOWER}) AS dst FROM urls),
weights AS MATERIALIZED (SELECT src, dst, count(*) AS w FROM (
    SELECT src, dst FROM links WHERE src <> '' AND dst <> '' AND src <> dst
    UNION ALL SELECT host, owner FROM owned WHERE owner <> '' UNION ALL SELECT owner, host FROM owned WHERE owner <> '')
  GROUP BY src, dst),
edges AS MATERIALIZED (
  SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS forward, w / sum(w) OVER (PARTITION BY dst) AS backward FROM weights),
seeds AS MATERIALIZED (
  SELECT host, avg(CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 1.0::DOUBLE ELSE 0 END) AS good,
    avg(CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 1.0::DOUBLE ELSE 0 END) AS bad
  FROM ruled WHERE host <> '' GROUP BY host),
base AS MATERIALIZED (
  SELECT host, coalesce(good / coalesce(nullif((SELECT sum(good) FROM seeds), 0), 1), 0) AS good,
    coalesce(bad / coalesce(nullif((SELECT sum(bad) FROM seeds), 0), 1), 0) AS bad
  FROM (SELECT src AS host FROM edges UNION SELECT dst FROM edges UNION SELECT host FROM seeds) LEFT JOIN seeds USING (host)),
terms(k, host, trust, distrust) AS (
  SELECT 0, host, good, bad FROM base
  UNION ALL SELECT k + 1, h, sum(t), sum(d) FROM (
    SELECT k, e.dst AS h, 0.85::DOUBLE * r.trust * e.forward AS t, 0.0::DOUBLE AS d FROM edges e JOIN terms r ON e.src = r.host
    UNION ALL SELECT k, e.src, 0.0::DOUBLE, 0.85::DOUBLE * r.distrust * e.backward FROM edges e JOIN terms r ON e.dst = r.host)
  WHERE k < 200 GROUP BY k, h),
sums AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM terms GROUP BY host),
ranks AS (SELECT host, trust / coalesce(nullif(sum(trust) OVER (), 0), 1) AS trust,
    distrust / coalesce(nullif(sum(distrust) OVER (), 0), 1) AS distrust FROM sums),
judged AS (
  SELECT page_id, p.host, path, rule, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
  FROM ruled p LEFT JOIN ranks ON p.host = ranks.host)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL OR distrust > (1 + 1e-9::DOUBLE) * trust THEN 'block' ELSE 'allow' END AS verdict,
  round(trust, {PLACES}) AS trust, round(distrust, {PLACES}) AS distrust
FROM judged
""",
    "op6_license_scan": f"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
places AS (
  SELECT doc_id, t, w,
    list_filter(range(len(w)), lambda k: w[k + 1] = 'cc' AND w[k + 2] = 'by') AS a,
    list_filter(range(len(w)), lambda k: w[k + 1] = 'general' AND w[k + 2] = 'public' AND w[k + 3] = 'license') AS b,
    list_filter(range(len(w)), lambda k: w[k + 1] = 'all' AND w[k + 2] = 'rights' AND w[k + 3] = 'reserved') AS c FROM words),
templates(label, must, body, wide) AS (VALUES {_TEMPLATES}),
sets AS (
  SELECT row_number() OVER () AS template, label, wide, list_distinct(string_split(body, ' ')) AS s,
    list_filter(string_split(must, ' '), lambda x: x <> '') AS must FROM templates),
held AS MATERIALIZED (
  SELECT doc_id, template, label, wide, s, must, w FROM (SELECT doc_id, w, list_distinct(w) AS l FROM words), sets
  WHERE len(list_intersect(s, l)) >= ceil(0.8 * len(s) - 1e-9) AND len(list_intersect(must, l)) = len(must)),
blocks AS (
  SELECT doc_id, template, label, s, must, w[k + 1:k + wide] AS l FROM (SELECT *, unnest(range(len(w))) AS k FROM held)),
found AS (
  SELECT doc_id, label, len(list_intersect(s, l)) / len(s) AS share FROM blocks
  WHERE len(list_intersect(s, l)) >= ceil(0.8 * len(s) - 1e-9) AND len(list_intersect(must, l)) = len(must)),
best AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS score FROM found GROUP BY doc_id),
own AS (SELECT *, list_concat(a, b, c) AS p, list_sort(list_filter(
    [CASE WHEN len(a) > 0 THEN 'cc-by' END, CASE WHEN len(b) > 0 THEN 'gpl' END, CASE WHEN len(c) > 0 THEN 'reserved' END],
    lambda x: x IS NOT NULL)) AS base FROM places)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word,
  list_max(p)::BIGINT AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM own LEFT JOIN best USING (doc_id)
""",
    "op8_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sizes AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\\'), '### ', '\s'), '</turn>', '\t'), chr(10), '\n'))
    + length(replace(replace(replace(text, '\', '\\'), '### ', '\s'), '</turn>', '\t')) + 13 AS n FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sizes GROUP BY conv_id
""",
    "op9_topk_search": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op11_phrase_collocations": f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, w FROM (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
      translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM documents)),
words AS MATERIALIZED (SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS k FROM pieces),
runs AS MATERIALIZED (
  SELECT lang, w1, lead(w1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3 FROM words WINDOW piece AS (PARTITION BY piece ORDER BY k)),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS cut, x.f AS l, y.f AS r
  FROM f2 c JOIN f1 x ON c.lang = x.lang AND c.w1 = x.w1 JOIN f1 y ON c.lang = y.lang AND c.w2 = y.w1
  WHERE c.f >= 10 AND NOT EXISTS (FROM f3 t WHERE t.lang = c.lang AND 100 * t.f >= 50 * c.f
    AND (t.w1 = c.w1 AND t.w2 = c.w2 OR t.w2 = c.w1 AND t.w3 = c.w2))
  UNION ALL SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM f3 c JOIN f1 x ON c.lang = x.lang AND c.w1 = x.w1 JOIN f2 y ON c.lang = y.lang AND c.w2 = y.w1 AND c.w3 = y.w2
  UNION ALL SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON c.lang = x.lang AND c.w1 = x.w1 AND c.w2 = x.w2 JOIN f1 y ON c.lang = y.lang AND c.w3 = y.w1),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_decontamination": f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
    translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS m FROM items WHERE len(w) > 0),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, m, array_to_string(w[k + 1:k + m], ' ') AS x FROM (
    SELECT item_id, m, w, unnest(range(len(w) - m + 1)) AS k FROM sized)),
spans AS (
  SELECT row, k, m, array_to_string(w[k + 1:k + m], ' ') AS x FROM (
    SELECT row, m, w, unnest(range(greatest(0, len(w) - m + 1))) AS k FROM docs, (SELECT DISTINCT m FROM windows))),
hits AS MATERIALIZED (SELECT row, k, s.m, item_id FROM spans s JOIN windows v ON s.x = v.x AND s.m = v.m),
marked AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(k, k + m)) AS p FROM hits) GROUP BY row),
listed AS (
  SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(marked.n, 0)::BIGINT AS n_hit, coalesce(listed.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(marked.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (row) LEFT JOIN listed USING (row)
""",
}
