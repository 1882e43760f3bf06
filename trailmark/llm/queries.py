"""The corpus operators as queries over the given tables, with production parameters, and their SQL where there is any."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, filter_audit, mixing, neighbours, ogg, packing, quality_classifier, quality_rules, secrets, sharding, simhash, substring_dedup, url_filter
from ._shared import table

SHARDS = 40


def tokenizer_path() -> str:
    """The tokenizer file: ``CORPUS_TOKENIZER`` if set, else the word-level one of the installed public files."""
    if path := os.environ.get("CORPUS_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).where(~held_out)
    scored = quality_classifier.score(table(spark, sf_dir, "documents"), labels)
    return scored.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: The rules of the URL query, the words that mark a host as listed, and the words a link that mark it as thin.
URL_RULES = [url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"), url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow")]
LISTED_HOSTS, WORDS_A_LINK = "adult|ads|bets|casino|pills|spam", 40


def listed_addresses(pages: DataFrame) -> DataFrame:
    """(key): the addresses (host and path) of hosts with a listed word between dots and hyphens, and of thin hosts.

    Thin is a host whose pages together show fewer than ``WORDS_A_LINK`` words for each of their links, which no page
    tells alone.
    """
    host, path = url_filter.host_and_path(F.col("url"))
    html = F.coalesce("html", F.lit(""))
    links = F.regexp_count(html, F.lit("<a ")).cast("long")
    words = F.regexp_count(F.regexp_replace(html, "<[^>]*>", " "), F.lit("[A-Za-z]{2,}")).cast("long")
    hosts = pages.select(host.alias("host"), links.alias("links"), words.alias("words")).groupBy("host").agg(F.sum("links").alias("links"), F.sum("words").alias("words"))
    listed = hosts.where(F.col("host").rlike(rf"(^|[.-])({LISTED_HOSTS})([.-]|$)") | ((F.col("host") != "") & (F.col("words") < WORDS_A_LINK * F.col("links")))).select("host")
    return pages.select(host.alias("host"), path.alias("path")).distinct().join(listed, "host").select(F.concat("host", "path").alias("key")).distinct()


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, listed_addresses(pages), URL_RULES).withColumnRenamed("id", "page_id")


OP4_SQL = f"""
WITH u AS (
  SELECT page_id, coalesce(html, '') AS html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host, html,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), h AS (
  SELECT host FROM p GROUP BY host HAVING regexp_matches(host, '(^|[.-])({LISTED_HOSTS})([.-]|$)')
    OR host <> '' AND sum(len(regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[A-Za-z]{{2,}}'))) < {WORDS_A_LINK} * sum(len(regexp_extract_all(html, '<a ')))
), k AS (
  SELECT DISTINCT host || path AS key FROM p WHERE host IN (SELECT host FROM h)
), r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN host || path IN (SELECT key FROM k) THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def op5_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), facts=True)
    few, often = F.col("n_words") < quality_rules.MIN_WORDS, 100 * F.col("n_repeat_words") > quality_rules.REPEAT_PERCENT * F.col("n_words")
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (few | often).alias("base_failed"), "kept",
    )


_Q = quality_rules
OP6_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), i AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS five FROM d, generate_series(1, len(w) - 4) g(i)
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM i), generate_series(0, 4) g(k) WHERE n > 1 GROUP BY doc_id
), f AS (
  SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper
  FROM d LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < {_Q.MIN_WORDS} OR 100 * n_repeat_words > {_Q.REPEAT_PERCENT} * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > {_Q.SYMBOL_PERCENT} * n_words OR 100 * n_dup_lines > {_Q.DUP_LINE_PERCENT} * len(lines) OR 100 * n_upper > {_Q.UPPER_PERCENT} * n_words OR word_chars > {_Q.MAX_WORD} * n_words) AS kept FROM b
"""


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Target shares of tokens. Clean documents keep theirs; the others are thinned out.
MIX = {"clean": 0.90, "low": 0.05, "toxic": 0.05}


def domains(labels: DataFrame) -> DataFrame:
    """(id, domain) from the labels: toxic, else low quality, else clean."""
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")
    return labels.select(F.col("doc_id").alias("id"), kind.alias("domain"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), domains(table(spark, sf_dir, "labels")), MIX, anchor="clean")
    return mixed.select(F.col("id").alias("doc_id"), "n_tokens", "domain", *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(MIX)), "rate", "copies")


def op9_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.digest(ogg.read_media(ogg.to_media(table(spark, sf_dir, "documents"))))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path()))
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.numbered(table(spark, sf_dir, "conversations"))
    found = conversation_trie.nodes(conversation_trie.rebuilt(turns, period=20, most=4))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS source, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
  ), 4294967295::BIGINT) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, pos AS place, 0 AS own, role, text FROM c JOIN t ON t.conv_id = c.source AND pos < h
  UNION ALL SELECT conv_id, pos, 1, role, text FROM c JOIN t USING (conv_id) WHERE pos >= h
), q AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY own, place) FILTER (WHERE text IS NOT NULL), []) AS s FROM c LEFT JOIN r USING (conv_id) GROUP BY 1
), p AS (
  SELECT conv_id, d AS depth, s[:d] AS k, d = len(s) AS ended FROM (SELECT *, unnest(generate_series(0, len(s))) AS d FROM q)
), n AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256,
    (count(*) - 1) * len(regexp_extract_all(coalesce(k[depth].text, ''), '[^\x20\x09-\x0D]+')) AS saved FROM p GROUP BY k, depth
), kids AS (
  SELECT k[: depth - 1] AS k, depth - 1 AS depth, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT k[:d] AS k, d AS depth, sum(saved) AS saved, sum(leaf) AS leaves FROM (
    SELECT n.k, saved, (kids.n IS NULL)::INT AS leaf, unnest(generate_series(0, n.depth)) AS d FROM n LEFT JOIN kids ON kids.k = n.k AND kids.depth = n.depth
  ) GROUP BY ALL
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN below ON below.k = n.k AND below.depth = n.depth LEFT JOIN kids ON kids.k = n.k AND kids.depth = n.depth
LEFT JOIN n up ON n.depth > 0 AND up.k = n.k[: n.depth - 1] AND up.depth = n.depth - 1
"""


#: Which rows of the query ask, and how many neighbours they get.
ASKS_EVERY, NEIGHBOURS = 20, 20


def op12_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % ASKS_EVERY == 0, NEIGHBOURS)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = filter_audit.text_filters(F.coalesce("text", F.lit("")))
    counted = filter_audit.cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), filters)
    return filter_audit.audit(counted, "ABCDE")


_A = filter_audit
OP13_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), f AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    (len(w) < {_A.MIN_WORDS})::INT + 2 * (100 * len(list_distinct(w)) < {_A.DISTINCT_PERCENT} * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {_A.UPPER_PERCENT} * length(t))::INT
    + 8 * regexp_matches(t, '{_A.SYMBOLS}')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM d LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders(o) AS (SELECT '' UNION ALL SELECT o || letter FROM orders JOIN letters ON NOT contains(o, letter)),
prefixes AS (
  SELECT o, letter, bit, (SELECT coalesce(sum(bit), 0) FROM letters WHERE contains(o[: length(o) - 1], letter))::BIGINT AS before
  FROM orders JOIN letters ON letter = o[-1] WHERE o <> ''
), m AS (
  SELECT part, o, letter, sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, prefixes GROUP BY ALL
), s AS (
  SELECT m.part, f.o AS filter_order, length(m.o) AS step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost
  FROM m JOIN orders f ON length(f.o) = 5 AND starts_with(f.o, m.o)
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM s
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_secret_scan, op3_quality_classifier, op4_url_filter, op5_kd_tree_shards, op6_quality_rules, op7_suffix_array_dedup, op8_soft_mixing,
        op9_ogg_media, op10_best_fit_packing, op11_conversation_trie, op12_collision_counting, op13_filter_audit,
    )
}

ORACLES: dict[str, str] = {"op4_url_filter": OP4_SQL, "op6_quality_rules": OP6_SQL, "op11_conversation_trie": OP11_SQL, "op13_filter_audit": OP13_SQL}
