"""The registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe_queue, decontaminate, filter_audit, language_id, main_text, mixing, near_copies, personal_data, repeated_passages, token_alignment, toxicity, url_lists, vector_tiles
from millrace.llm.common import table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document, and of the bytes they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_queue.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document are windows of benchmark items, and of which."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id::VARCHAR AS item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, k)),
hw AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
hi AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""


def held_out() -> Column:
    """Whether a document belongs to the fold that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network trained on the other fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(~held_out()))
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def _code(text: Column | str) -> Column:
    """A number from 0 to 65535 by the digest of a text."""
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")


def _dated(patterns: DataFrame, name: str, kind: str, kept: Column, days: list[tuple[str, Column]]) -> DataFrame:
    """The history of those patterns (column ``pattern``) that ``kept`` chooses: (action, day of 2024)."""
    events = F.array(*[F.struct(F.lit(action).alias("action"), day.alias("day")) for action, day in days])
    rows = patterns.where(kept).select("pattern", F.explode(events).alias("e"))
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("e.day") * 86400)
    return rows.select(F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern", F.col("e.action").alias("action"), at.alias("at"))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, as fetched in 2024, against dated lists of its hosts, domains and paths.

    The tables hold neither fetch times nor lists, so both are derived from all pages: the time from
    the page's number, list entries and their dates from digests of the hosts and paths that occur.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pages = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 1000003, F.lit(31536000))))
    host = url_lists.host_of(F.col("url"))
    c = _code("pattern")
    hosts = pages.select(host.alias("pattern")).distinct().where(F.col("pattern") != "")
    domains = hosts.select(url_lists.domain_of(F.col("pattern")).alias("pattern")).distinct()
    first = F.get(url_lists.segments_of(F.col("url")), 0)
    paths = pages.select(F.concat(host, F.lit("/"), first).alias("pattern"), host.alias("host")).where((F.col("host") != "") & F.col("pattern").isNotNull()).select("pattern").distinct()
    entries = _dated(hosts, "malware", "host", c % 3 == 0, [("add", c % 150), ("remove", c % 150 + 60), ("add", c % 150 + 120)])
    entries = entries.unionByName(_dated(hosts, "allow", "host", c % 11 == 5, [("add", c % 300)]))
    entries = entries.unionByName(_dated(domains, "spam", "domain", c % 5 == 1, [("add", c % 200), ("remove", c % 200 + 90)]))
    entries = entries.unionByName(_dated(paths, "adult", "prefix", c % 4 == 2, [("add", c % 250)]))
    judged = url_lists.judge(pages, entries)
    return judged.select("page_id", "url", F.array_join("lists", ",").alias("lists"), "allowed", "blocked")


OP5_SQL = r"""
WITH captures AS (
  SELECT page_id, url, 1704067200 + (page_id * 1000003) % 31536000 AS t,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\[]*)', 1)), '\.$', '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') AS parts
  FROM pages),
coded AS (
  SELECT kind, pattern, ('0x' || substr(md5(pattern), 1, 4))::INT AS c FROM (
    SELECT DISTINCT 'host' AS kind, host AS pattern FROM captures WHERE host <> ''
    UNION SELECT DISTINCT 'domain', array_to_string(string_split(host, '.')[-2:], '.') FROM captures WHERE host <> ''
    UNION SELECT DISTINCT 'prefix', host || '/' || parts[1] FROM captures WHERE host <> '' AND len(parts) > 0)),
entries AS (
  SELECT 'malware' AS list, kind, pattern, 1 AS active, c % 150 AS day FROM coded WHERE kind = 'host' AND c % 3 = 0
  UNION ALL SELECT 'malware', kind, pattern, 0, c % 150 + 60 FROM coded WHERE kind = 'host' AND c % 3 = 0
  UNION ALL SELECT 'malware', kind, pattern, 1, c % 150 + 120 FROM coded WHERE kind = 'host' AND c % 3 = 0
  UNION ALL SELECT 'allow', kind, pattern, 1, c % 300 FROM coded WHERE kind = 'host' AND c % 11 = 5
  UNION ALL SELECT 'spam', kind, pattern, 1, c % 200 FROM coded WHERE kind = 'domain' AND c % 5 = 1
  UNION ALL SELECT 'spam', kind, pattern, 0, c % 200 + 90 FROM coded WHERE kind = 'domain' AND c % 5 = 1
  UNION ALL SELECT 'adult', kind, pattern, 1, c % 250 FROM coded WHERE kind = 'prefix' AND c % 4 = 2),
wanted AS (
  SELECT page_id, t, 'host' AS kind, host AS pattern FROM captures WHERE host <> ''
  UNION ALL SELECT page_id, t, 'domain', array_to_string(string_split(host, '.')[-n:], '.')
    FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS n FROM captures WHERE host <> '')
  UNION ALL SELECT page_id, t, 'prefix', host || '/' || array_to_string(parts[1:n], '/')
    FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS n FROM captures WHERE host <> '')),
latest AS (
  SELECT page_id, list, arg_max(active, day * 2 + active) AS active
  FROM wanted JOIN entries USING (kind, pattern) WHERE 1704067200 + day * 86400 <= t
  GROUP BY page_id, list, kind, pattern),
held AS (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) FILTER (list <> 'allow') AS lists, bool_or(list = 'allow') AS allowed
  FROM latest WHERE active = 1 GROUP BY page_id)
SELECT page_id, url, coalesce(lists, '') AS lists, coalesce(allowed, false) AS allowed,
  coalesce(lists, '') <> '' AND NOT coalesce(allowed, false) AS blocked
FROM captures LEFT JOIN held USING (page_id)
"""


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near copies; the smallest id of a class is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_copies.classes(docs).withColumnRenamed("doc_id", "copy_id")
    label = F.coalesce("class_id", "doc_id")
    named = docs.select("doc_id").join(found, F.col("doc_id") == F.col("copy_id"), "left")
    return named.select("doc_id", label.alias("class_id"), label.eqNullSafe(F.col("doc_id")).alias("kept"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How toxic every document is, by a model trained on the other fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where(~held_out()), labels.where(~held_out()))
    return toxicity.predict(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share, one row for each document that has one and its twin."""
    found = repeated_passages.repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sides = repeated_passages.per_document(found)
    return sides.select(
        F.col("id").alias("doc_id"),
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        F.col("twin").alias("twin_id"),
        F.col("twin_start").alias("twin_start_word"),
        F.col("twin_end").alias("twin_end_word"),
        F.col("equal").alias("n_equal"),
        "first",
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find_spans(docs, personal_data.fit(docs))
    base = F.filter("pii_spans", lambda s: s["base"])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("pii_spans", lambda s: s["base"] & (s["kind"] == k)))
    counts = [of_kind(k).cast("long").alias(f"n_{k}") for k in personal_data.BASE]
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("pii_spans")).alias("spans"))


def op10_vector_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-equal embeddings."""
    return vector_tiles.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, per language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.interactions(docs, table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
     100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
     regexp_matches(text, '[#$%&*|]'), coalesce(first_id < doc_id, false)] AS fails
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
k AS (SELECT unnest(range(1, 6)) AS k),
o AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM k a, k b, k c, k d, k e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, k.k AS step, o[k.k] AS own,
    o[1:k.k - 1] AS before FROM o, k),
j AS (
  SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS failing,
    len(list_filter(before, lambda x: fails[x])) = 0 AS reached, len(list_filter(fails, lambda x: x)) AS n_fails
  FROM s, c),
r AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (reached AND NOT failing), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (reached AND failing), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (failing AND NOT reached), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (failing AND n_fails = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (reached AND failing AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (reached AND failing AND toxic), 0)::BIGINT AS toxic_lost
  FROM j GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers line up in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document go into a mix of sources by weight."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size,
    md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap,
    sum(source_size) OVER () AS all_words
  FROM s),
l AS (
  SELECT *, all_words - coalesce(sum(cap) OVER before, 0) AS words_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM w WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap::HUGEINT * weight_left <= words_left::HUGEINT * weight AS capped FROM l),
t AS (
  SELECT source, rank, source_size, all_words, CASE WHEN capped THEN cap::DOUBLE
    ELSE weight * ((all_words - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) FILTER (capped) OVER (), 0))::DOUBLE) END AS target
  FROM c),
p AS (
  SELECT d.*, rank, source_size, all_words, target, sum(size) OVER (
    PARTITION BY rank ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, unnest([0, 1, 2]) AS copy FROM p),
f AS (SELECT *, CASE WHEN size > 0 THEN (copy * source_size + place)::DOUBLE / target END AS finish FROM q),
o AS (
  SELECT *, sum(CASE WHEN size > 0 THEN size ELSE 0 END) OVER (
    ORDER BY finish NULLS LAST, rank, copy, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent
  FROM f),
x AS (
  SELECT doc_id, key, size, source_size, target, rank, place, count(*) / 3 AS alike,
    (sum(CASE WHEN size > 0 AND spent <= all_words THEN size ELSE 0 END))::BIGINT AS taken
  FROM o GROUP BY ALL)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE taken END AS taken
FROM x, range(CASE WHEN size = 0 THEN alike::BIGINT ELSE 1 END)
"""


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(first, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(first, vec_id)) AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)
  LEFT JOIN (SELECT a AS vec_id, min(b) AS first FROM r GROUP BY a) USING (vec_id)
"""


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_decontaminate": op3_decontaminate,
    "op4_language_id": op4_language_id,
    "op5_url_lists": op5_url_lists,
    "op6_near_copies": op6_near_copies,
    "op7_toxicity": op7_toxicity,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_personal_data": op9_personal_data,
    "op10_vector_tiles": op10_vector_tiles,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_alignment": op12_token_alignment,
    "op13_source_mix": op13_source_mix,
}

#: What DuckDB can say as well.
SQL: dict[str, str] = {
    "op3_decontaminate": OP3_SQL,
    "op5_url_lists": OP5_SQL,
    "op10_vector_tiles": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_source_mix": OP13_SQL,
}
