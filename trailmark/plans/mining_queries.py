"""Queries on patterns, meanings, names, embeddings and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import density, embedding, naming, semantics
from ..operators import journeys as J
from ..operators import patterns as P
from ..operators import vocabulary as V
from ..sources import writers
from .journey_queries import JOURNEY_SQL, ROLLUP_SQL, journeys, rolled
from .model_queries import _ROLES, _roles
from .registry import kept, query, table


@query(f"""WITH RECURSIVE s AS ({_ROLES}), a AS (SELECT DISTINCT unnest(s) AS x FROM s), n AS (SELECT count(*) AS n FROM s), p AS (
  SELECT conv_id, s, x AS pattern, 1 AS length, list_position(s, x) AS pos FROM s, a WHERE list_contains(s, x)
  UNION ALL SELECT conv_id, s, pattern || ' -> ' || x, length + 1, pos + list_position(s[pos + 1 :], x) FROM p, a WHERE length < 5 AND list_contains(s[pos + 1 :], x)
), c AS (SELECT pattern, length, count(*) AS k FROM p GROUP BY ALL)
SELECT pattern, length, k AS support_count, round(k / n, 4) AS support FROM c, n WHERE k >= greatest(2, round(0.05 * n))""")
def prefixspan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.mine(_roles(spark, sf_dir), "s", 0.05)
    return found.select(F.array_join("tokens", " -> ").alias("pattern"), "length", "support_count", "support")


#: Patterns of the query: in that share of the journeys that models take, to that length, so many at most.
SUPPORT, LONGEST, PATTERNS = 0.01, 5, 300
PATTERN_SQL = f"""{ROLLUP_SQL}, s AS (
  SELECT platform || '::' || session_id || '::' || journey_no AS journey_id, string_split(sequence, ' -> ') AS s FROM r WHERE n_events_final >= 3
), n AS (SELECT count(*) AS n FROM s), p AS (
  SELECT journey_id, s, [x] AS tokens, list_position(s, x) AS pos FROM (SELECT *, unnest(list_distinct(s)) AS x FROM s)
  UNION ALL
  SELECT journey_id, s, list_append(tokens, x), pos + list_position(s[pos + 1 :], x) FROM (SELECT *, unnest(list_distinct(s[pos + 1 :])) AS x FROM p WHERE len(tokens) < {LONGEST})
), f AS (
  SELECT tokens, len(tokens) AS length, count(*) AS k FROM p GROUP BY tokens HAVING count(*) >= greatest(2, round({SUPPORT} * (SELECT n FROM n)))
), covered AS (
  SELECT DISTINCT list_concat(tokens[: i - 1], tokens[i + 1 :]) AS tokens, k FROM f, generate_series(1, {LONGEST}) g(i) WHERE i <= length AND length > 1
), closed AS (
  SELECT *, array_to_string(tokens, ' -> ') AS name FROM f WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.tokens = f.tokens AND c.k = f.k) AND length >= 2
), quota AS (SELECT ceil({PATTERNS} / count(DISTINCT length)) AS quota FROM closed), few AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY length ORDER BY k DESC, name) AS i FROM closed), quota WHERE i <= quota
), ranked AS (
  SELECT *, printf('P%04d', no) AS pattern_id FROM (SELECT *, row_number() OVER (ORDER BY k DESC, length DESC, name) AS no FROM few) WHERE no <= {PATTERNS}
), held AS (
  SELECT journey_id, pattern_id, length, k FROM p JOIN ranked USING (tokens)
)"""


def _ranked(rows: DataFrame) -> DataFrame:
    return kept(P.rank(P.close(kept(P.mine(rows, "sequence_tokens", SUPPORT, longest=LONGEST))), PATTERNS))


@query(f"""WITH RECURSIVE {PATTERN_SQL}
SELECT s.journey_id, count(pattern_id)::INT AS matched, arg_min(pattern_id, (-length, k, pattern_id)) AS candidate FROM s LEFT JOIN held USING (journey_id) GROUP BY s.journey_id""")
def pattern_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed, ranked patterns of the journeys that models take, and each journey's own."""
    rows = kept(J.eligible(rolled(spark, sf_dir)).where("model_eligible"))
    return P.candidates(rows, "journey_id", "sequence_tokens", _ranked(rows))


@query(f"""WITH RECURSIVE {JOURNEY_SQL} SELECT CASE WHEN seen = 'k0' THEN 'home' WHEN seen IN ('k1', 'k2') THEN 'shop' WHEN seen = 'k3' THEN 'support' ELSE 'unknown' END AS around, event_type, count(*) AS events FROM je WHERE event_type = 'view' GROUP BY ALL""")
def view_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = semantics.annotate(journeys(spark, sf_dir), semantics.EVENT_TABLE).where("event_type = 'view'")
    return rows.groupBy(F.col("business_family").alias("around"), "event_type").agg(F.count("*").alias("events"))


#: The labels of the event table's events under its small taxonomy: of a screen, and of an action on it.
SEMANTIC_SQL = f"""{JOURNEY_SQL}, v(screen, family, module, thing) AS (VALUES ('k0', 'home', 'general', 'unknown'), ('k1', 'shop', 'catalog', 'product'), ('k2', 'shop', 'basket', 'unknown'), ('k3', 'support', 'general', 'unknown')),
a(action, family, module, thing, operation, stage) AS (VALUES ('purchase', 'payment', 'checkout', 'order', 'pay', 'commit'), ('signup', 'account', 'registration', NULL, 'register', 'commit'), ('click', NULL, NULL, NULL, 'select', 'browse'), ('scroll', NULL, NULL, NULL, 'browse', 'browse')),
lab AS (SELECT event_type, coalesce(a.family, v.family, 'unknown') AS family, coalesce(a.module, v.module, 'unknown') AS module,
  CASE WHEN a.family IS NULL AND v.family IS NULL THEN 'unknown' ELSE coalesce(a.thing, v.thing, 'unknown') END AS thing,
  CASE WHEN a.family IS NULL AND v.family IS NULL THEN 'unknown' WHEN event_type = 'view' THEN 'view' ELSE coalesce(a.operation, 'unknown') END AS operation,
  CASE WHEN a.family IS NULL AND v.family IS NULL THEN 'unknown' WHEN event_type = 'view' THEN 'entry' ELSE coalesce(a.stage, 'unknown') END AS stage,
  CASE WHEN a.family IS NULL AND v.family IS NULL THEN 0 ELSE round(
    CASE WHEN a.family IS NOT NULL THEN 0.40 WHEN event_type <> 'view' THEN 0.15 WHEN v.screen = 'k3' THEN 0.20 ELSE 0.40 END
    + CASE WHEN a.family IS NOT NULL THEN 0.20 WHEN event_type <> 'view' THEN 0.08 WHEN v.module = 'general' THEN 0.05 ELSE 0.20 END
    + CASE WHEN a.thing IS NOT NULL OR event_type = 'view' AND v.thing <> 'unknown' THEN 0.15 WHEN event_type <> 'view' AND coalesce(v.thing, 'unknown') <> 'unknown' THEN 0.07 ELSE 0 END
    + CASE WHEN event_type = 'view' THEN 0.10 WHEN a.operation IS NOT NULL THEN 0.25 ELSE 0 END, 3) END AS confidence
  FROM je LEFT JOIN v ON v.screen = je.screen_context LEFT JOIN a ON a.action = je.segment_name AND je.event_type = 'action')"""


@query(f"""WITH RECURSIVE {SEMANTIC_SQL} SELECT family || '/' || module || '/' || thing || '/' || operation AS token_l3, family || '/' || module AS token_l2, family AS token_l1, stage || ':' || operation AS token_operation,
  confidence AS semantic_confidence, count(*) AS events FROM lab GROUP BY ALL""")
def semantic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = semantics.token_ladder(semantics.annotate(journeys(spark, sf_dir), semantics.EVENT_TABLE))
    return rows.groupBy("token_l3", "token_l2", "token_l1", "token_operation", "semantic_confidence").agg(F.count("*").alias("events"))


#: A taxonomy out of the parts: their names with brands (of large parts), their names (of small ones), brands, nouns, types.
PART_OPERATIONS = {"economy": "view", "large": "list", "medium": "select", "promo": "share", "small": "search", "standard": "open"}
PART_PHRASES_SQL = f"""b AS (
  SELECT p_partkey, p_size, lower(p_name) AS name, lower(replace(p_brand, '#', '')) AS brand, lower(p_type) AS kind FROM part
), phrases AS (
  SELECT DISTINCT 'strong' AS section, name || ' ' || brand AS phrase, split_part(name, ' ', 2) AS value, brand AS module FROM b WHERE p_size >= 15
  UNION ALL SELECT DISTINCT 'weak', name, split_part(name, ' ', 2), 'general' FROM b WHERE p_size < 5
  UNION ALL SELECT DISTINCT 'fallback', brand, 'branded', brand FROM b WHERE p_size % 2 = 0
  UNION ALL SELECT DISTINCT 'object', split_part(name, ' ', 2), split_part(name, ' ', 2), NULL FROM b
  UNION ALL SELECT * FROM (VALUES {", ".join(f"('operation', '{k}', '{v}', NULL)" for k, v in PART_OPERATIONS.items())}) o(section, phrase, value, module)
)"""


@query(f"""WITH {PART_PHRASES_SQL}, spans AS (
  SELECT p_partkey, i, j, array_to_string(w[i:j], ' ') AS phrase FROM (SELECT p_partkey, string_split(name || ' ' || brand || ' ' || kind, ' ') AS w FROM b), generate_series(1, 4) x(i), generate_series(1, 4) y(j) WHERE i <= j AND j <= len(w)
), hits AS (
  SELECT *, row_number() OVER (PARTITION BY p_partkey, CASE WHEN section IN ('object', 'operation') THEN section END ORDER BY CASE section WHEN 'strong' THEN 1 WHEN 'weak' THEN 2 ELSE 3 END, module = 'general', j DESC, i) AS r FROM spans JOIN phrases USING (phrase)
), best AS (
  SELECT p_partkey, max(CASE WHEN section NOT IN ('object', 'operation') THEN {{'section': section, 'value': value, 'module': module, 'phrase': replace(phrase, ' ', '_')}} END) AS s,
    max(CASE WHEN section = 'object' THEN value END) AS o, max(CASE WHEN section = 'operation' THEN {{'value': value, 'phrase': phrase}} END) AS p FROM hits WHERE r = 1 GROUP BY p_partkey
)
SELECT b.p_partkey, coalesce(s.value, 'unknown') AS business_family, coalesce(s.module, 'unknown') AS business_module, CASE WHEN s IS NULL THEN 'unknown' ELSE coalesce(o, 'unknown') END AS business_object,
  CASE WHEN s IS NULL THEN 'unknown' ELSE coalesce(p.value, 'view') END AS operation,
  CASE WHEN s IS NULL THEN 'unknown' ELSE CASE coalesce(p.value, 'view') WHEN 'view' THEN 'entry' WHEN 'open' THEN 'entry' WHEN 'share' THEN 'commit' ELSE 'browse' END END AS operation_stage,
  CASE WHEN s IS NULL THEN 0 ELSE round(CASE s.section WHEN 'strong' THEN 0.40 ELSE 0.20 END + CASE s.module WHEN 'general' THEN 0.05 ELSE 0.20 END + CASE WHEN o IS NULL THEN 0 ELSE 0.15 END + CASE WHEN p IS NULL THEN 0.10 ELSE 0.25 END, 3) END AS semantic_confidence,
  CASE WHEN s IS NULL THEN '' ELSE concat_ws(';', 'family=' || s.value || '<-screen:' || s.phrase, 'module=' || s.module || '<-screen:' || s.phrase, 'object=' || o || '<-screen:' || o, coalesce('operation=' || p.value || '<-screen:' || p.phrase, 'operation=view<-screen:event_type')) END AS semantic_evidence
FROM b LEFT JOIN best USING (p_partkey)""")
def part_meanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a view whose path is its name, brand and type, labelled by a taxonomy table of over a thousand phrases."""
    part = table(spark, sf_dir, "part")
    name, brand, noun = F.lower("p_name"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lower(F.substring_index("p_name", " ", -1))
    rows = lambda section, where, phrase, value, module: part.where(where).select(F.lit(section).alias("section"), phrase.alias("phrase"), value.alias("value"), module.alias("module")).distinct()
    phrases = rows("strong", "p_size >= 15", F.concat_ws(" ", name, brand), noun, brand).union(rows("weak", "p_size < 5", name, noun, F.lit("general")))
    phrases = phrases.union(rows("fallback", "p_size % 2 = 0", brand, F.lit("branded"), brand)).union(rows("object", "true", noun, noun, F.lit(None)))
    operations = spark.createDataFrame([("operation", k, v, None) for k, v in PART_OPERATIONS.items()], "section string, phrase string, value string, module string")
    taxonomy = semantics.Taxonomy.from_rows(phrases.union(operations))
    path = F.concat_ws("/", "p_name", F.replace("p_brand", F.lit("#"), F.lit("")), F.concat(F.lower("p_type"), F.lit("VC?x=1")))
    seen = part.select("p_partkey", F.lit("view").alias("event_type"), path.alias("screen_context"), F.lit(None).cast("string").alias("segment_name"))
    return semantics.annotate(seen, taxonomy).select("p_partkey", *semantics.COLUMNS)


_KNOWN = ", ".join(f"round(avg(CAST({a} <> 'unknown' AS INT)), 6) AS known_{b}" for a, b in (("family", "business_family"), ("module", "business_module"), ("thing", "business_object"), ("operation", "operation"), ("stage", "operation_stage")))


@query(f"""WITH RECURSIVE {SEMANTIC_SQL} SELECT count(*) AS events, {_KNOWN}, round(avg(confidence), 6) AS mean_confidence FROM lab""")
def semantic_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantics.coverage(semantics.annotate(journeys(spark, sf_dir), semantics.EVENT_TABLE))


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, t AS (SELECT platform || '::' || session_id || '::' || journey_no AS journey_id, generate_subscripts(string_split(sequence, ' -> '), 1) AS i, unnest(string_split(sequence, ' -> ')) AS token FROM r),
f AS (SELECT *, regexp_extract(token, '@([^#]*)', 1) AS screen, regexp_extract(token, '#(.*)$', 1) AS action FROM t), x AS (SELECT *, CASE screen WHEN 'k0' THEN 'home/general' WHEN 'k1' THEN 'shop/catalog' WHEN 'k2' THEN 'shop/basket' WHEN 'k3' THEN 'support/general' ELSE 'unknown/unknown' END AS around FROM f)
SELECT journey_id, string_agg(CASE action WHEN 'purchase' THEN 'payment/checkout' WHEN 'signup' THEN 'account/registration' ELSE around END, ' ' ORDER BY i) AS coarse,
  string_agg(split_part(CASE action WHEN 'purchase' THEN 'payment/checkout' WHEN 'signup' THEN 'account/registration' ELSE around END, '/', 1), ' ' ORDER BY i) AS family FROM x GROUP BY journey_id""")
def rebuilt_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarser channels of journeys that were kept as exact sequences alone."""
    rows = kept(rolled(spark, sf_dir).select("journey_id", "sequence_tokens"))
    out = semantics.channels_from_sequences(rows, "journey_id", "sequence_tokens", ("coarse", "family"), semantics.EVENT_TABLE)
    return out.select("journey_id", F.array_join("coarse", " ").alias("coarse"), F.array_join("family", " ").alias("family"))


#: Nodes of a small taxonomy for the event table, by the text that speaks for them.
NODES = {"M01.01.01": "k0$", "M02.01.01": "k1$", "M02.02.01": "k2$", "M03.01.01": "purchase", "M04.01.01": "signup", "M05.01.01": "k3$"}


_EVIDENCE = " ".join(f"WHEN {test} THEN '{node}'" for test, node in (("e LIKE '%k0'", "M01.01.01"), ("e LIKE '%k1'", "M02.01.01"), ("e LIKE '%k2'", "M02.02.01"), ("e = 'purchase'", "M03.01.01"), ("e = 'signup'", "M04.01.01"), ("e LIKE '%k3'", "M05.01.01")))


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, k AS (SELECT n_events_final % 5 AS cluster, string_split(sequence, ' -> ') AS s FROM r), g AS (SELECT cluster, unnest(s) AS ngram FROM k UNION ALL SELECT cluster, s[i] || ' ' || s[i + 1] FROM k, generate_series(1, len(s) - 1) t(i)),
c AS (SELECT cluster, ngram, count(*) AS n FROM g GROUP BY ALL), m AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS mass, sum(n) OVER (PARTITION BY ngram) / sum(n) OVER () AS share FROM c), l AS (SELECT *, (mass + 1e-9) / (share + 1e-9) AS lift FROM m),
top AS (SELECT cluster, rank, ngram, round(lift, 6) AS lift, round(mass, 9) AS mass FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(lift, 9) DESC, n DESC, ngram) AS rank FROM l) WHERE rank <= 8),
w AS (SELECT cluster, rank, lift, mass, unnest(list_distinct(string_split(ngram, ' '))) AS token FROM top), e AS (SELECT *, CASE WHEN token LIKE 'view@%' THEN substr(token, 6) ELSE regexp_extract(token, '#(.*)$', 1) END AS e FROM w),
nodes AS (SELECT DISTINCT cluster, rank, lift, mass, CASE {_EVIDENCE} END AS node FROM e WHERE CASE {_EVIDENCE} END IS NOT NULL), x AS (SELECT *, mass * greatest(ln(1 + lift), 0.1) / count(*) OVER (PARTITION BY cluster, rank) AS w FROM nodes),
t AS (SELECT cluster, sum(mass) AS total FROM top GROUP BY cluster), sc AS (SELECT cluster, node, sum(w) AS score, count(*) AS n, sum(mass) / max(total) AS coverage FROM x JOIN t USING (cluster) GROUP BY ALL),
lv AS (SELECT cluster, size, substr(node, 1, size) AS node, sum(score) AS score, sum(n) AS n, sum(coverage) AS coverage FROM sc, (VALUES (9), (6), (3)) z(size) GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, score / sum(score) OVER (PARTITION BY cluster, size) AS part, row_number() OVER (PARTITION BY cluster, size ORDER BY score DESC, node) AS r FROM lv) WHERE r = 1 AND n >= 2 AND coverage >= 0.15 AND part >= 0.60),
pick AS (SELECT cluster, arg_max(node, size) AS node, max(size) AS size, round(arg_max(part, size), 4) AS share FROM best GROUP BY cluster)
SELECT 'all' AS platform, cluster, node, CASE size WHEN 9 THEN 'feature' WHEN 6 THEN 'submodule' WHEN 3 THEN 'module' ELSE 'unclassified' END AS level, share, CASE size WHEN 9 THEN 'high' WHEN 6 THEN 'medium' WHEN 3 THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT DISTINCT cluster FROM top) LEFT JOIN pick USING (cluster)""")
def name_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for groups of journeys from the n-grams that set them apart."""
    rows = rolled(spark, sf_dir).withColumn("cluster", (F.col("n_events_final") % 5).cast("int"))
    lifts = V.ngram_lift(rows, "cluster", "sequence_tokens", 8).withColumn("platform", F.lit("all"))
    tokens = lifts.select(F.explode(F.split("ngram", " ")).alias("token"))
    scores = naming.evidence_scores(lifts, naming.deepest_match(tokens, "token", NODES))
    return naming.cascade(scores, lifts)


_OLD = "CAST(CASE WHEN o_custkey % 20 < 8 THEN 1 + o_custkey % 5 WHEN o_custkey % 20 > 15 AND o_orderkey % 3 > 0 OR o_orderkey % 7 = 0 THEN -1 ELSE o_orderkey % 7 END AS INT)"


@query(f"""WITH p AS (SELECT o_custkey % 20 AS "new", {_OLD} AS old, count(*) AS n FROM orders GROUP BY ALL), c AS (SELECT "new", sum(n) AS sampled, sum(CASE WHEN old > 0 THEN n ELSE 0 END) AS covered, max(CASE WHEN old > 0 THEN n END) AS top FROM p GROUP BY "new")
SELECT "new", round(covered / sampled, 4) AS coverage, CASE WHEN covered / sampled < 0.5 THEN 'new' WHEN top / covered >= 0.7 THEN 'old_cluster' ELSE 'module' END AS step FROM c""")
def carry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new grouping of all orders against an old one: groups within one old cluster, spread over one module, or mostly outside."""
    orders = table(spark, sf_dir, "orders")
    pairs = orders.groupBy((F.col("o_custkey") % 20).alias("new"), F.expr(_OLD).alias("old")).agg(F.count("*").alias("n"))
    names = pairs.select("old").distinct().where("old > 0").select("old", F.concat(F.lit("M01.0"), "old", F.lit(".01")).alias("taxonomy_id"))
    return naming.carry_names(pairs, names).select("new", "coverage", "step")


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, k AS (SELECT platform || '::' || session_id || '::' || journey_no AS journey_id, list_concat(list_concat(['<bos>'], string_split(sequence, ' -> ')), ['<eos>']) AS s FROM r),
g AS (SELECT journey_id, s[i] AS ngram FROM k, generate_series(1, len(s)) t(i) UNION ALL SELECT journey_id, s[i] || ' ' || s[i + 1] FROM k, generate_series(1, len(s) - 1) t(i)), tf AS (SELECT journey_id, ngram, count(*) AS tf FROM g GROUP BY ALL),
d AS (SELECT ngram, ln((1 + (SELECT count(*) FROM k)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY ngram HAVING count(*) >= 5), w AS (SELECT journey_id, (1 + ln(tf)) * idf AS w FROM tf JOIN d USING (ngram))
SELECT journey_id, count(*) AS terms, round(max(w) / sqrt(sum(w * w)), 6) AS heaviest FROM w GROUP BY journey_id""")
def tfidf_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(rolled(spark, sf_dir))
    weights = embedding.fit_tfidf(rows, "journey_id", "sequence_tokens").transform(rows, "journey_id", "sequence_tokens")
    return weights.groupBy("journey_id").agg(F.count("*").alias("terms"), F.round(F.max("w"), 6).alias("heaviest"))


@query()
def svd_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journeys in 64 dimensions of 20,000 n-grams at most: rows, dimension and length of the vectors."""
    rows = kept(rolled(spark, sf_dir))
    model = embedding.fit_tfidf(rows, "journey_id", "sequence_tokens")
    weights = kept(model.by_row(rows, "journey_id", "sequence_tokens"))
    basis = embedding.fit_svd(weights, "journey_id", model.terms.count(), 64)
    v = embedding.project(weights, "journey_id", basis).withColumn("v", embedding.unit(F.col("v")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return v.groupBy(F.size("v").alias("dimensions"), F.round(norm, 4).alias("norm")).agg(F.count("*").alias("rows"))


#: The behaviour block in SQL; back_rate and n_loop_removed are 0 throughout, as no name goes back and cycles stay.
_BLOCK = {c: (c if c in ("action_ratio", "revisit_ratio") else f"ln(1 + greatest({c}, 0))") if c not in ("back_rate", "n_loop_removed") else "0.0" for c in embedding.NUMERIC}
_SCALED = ", ".join(f"(x{i} - avg(x{i}) OVER ()) / coalesce(nullif(stddev_pop(x{i}) OVER (), 0), 1) AS z{i}" for i in range(len(_BLOCK)))
_LENGTH = "sqrt(" + " + ".join(f"z{i} * z{i}" for i in range(len(_BLOCK))) + ")"


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, x AS (
  SELECT platform || '::' || session_id || '::' || journey_no AS journey_id, {", ".join(f"{x} AS x{i}" for i, x in enumerate(_BLOCK.values()))} FROM r JOIN raw USING (platform, session_id, journey_no)
), z AS (SELECT journey_id, {_SCALED} FROM x)
SELECT journey_id, {", ".join(f"round(z{i} / {_LENGTH}, 6) AS {c}" for i, c in enumerate(_BLOCK))} FROM z""")
def numeric_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(rolled(spark, sf_dir))
    v = embedding.fit_numeric(rows).transform()
    return rows.select("journey_id", v.alias("v")).select("journey_id", *(F.round(F.col("v")[i], 6).alias(c) for i, c in enumerate(embedding.NUMERIC)))


@query()
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density clusters of the embeddings, fitted to a sample of the reference's size and given to every row, against their labels."""
    rows = table(spark, sf_dir, "embeddings")
    found = kept(density.label_all(rows, "vec_id", "embedding", min_size=20))
    return rows.join(found, "vec_id").groupBy("label", "cluster", "fitted").agg(F.count("*").alias("rows"))


@query()
def cluster_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.stability(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", min_size=20)


@query(f"""WITH RECURSIVE {PATTERN_SQL}, w AS (SELECT journey_id, count(pattern_id)::INT AS matched FROM s LEFT JOIN held USING (journey_id) GROUP BY journey_id)
SELECT matched, (least(64, (SELECT count(*) FROM ranked)) + {len(embedding.NUMERIC)})::INT AS dimensions, count(*) AS rows FROM w GROUP BY matched""")
def pattern_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journeys as vectors of the closed patterns that they contain: rows by patterns matched and dimension."""
    rows = kept(J.eligible(rolled(spark, sf_dir)).where("model_eligible"))
    v = embedding.pattern_vectors(rows, "journey_id", "sequence_tokens", _ranked(rows), 64, embedding.fit_numeric(rows).transform())
    return v.groupBy("matched", F.size("v").alias("dimensions")).agg(F.count("*").alias("rows"))


@query(f"""WITH RECURSIVE {ROLLUP_SQL} SELECT '2026-01-01_' || platform || '::' || session_id || '::' || journey_no AS journey_id, session_id AS customer_id, n_events_raw, n_events_final, replace(sequence, ' -> ', ',') AS sequence, CASE WHEN n_events_final % 3 = 0 THEN 'UNKNOWN' ELSE 'C:' || n_events_final % 3 END AS effective_cluster_key
FROM r JOIN raw USING (platform, session_id, journey_no)""")
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rolled(spark, sf_dir).withColumn("cluster", F.when(F.col("n_events_final") % 3 == 0, -1).otherwise(F.col("n_events_final") % 3))
    return writers.summary(rows, "2026-01-01", "v1").select("journey_id", "customer_id", "n_events_raw", "n_events_final", "sequence", "effective_cluster_key")


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, sc AS (SELECT *, n_events_final % 3 - 1 AS c FROM r JOIN raw USING (platform, session_id, journey_no))
SELECT '2026-01-01' AS batch_date, 'v1' AS model_version, platform, c AS cluster_id, CASE WHEN c = 1 THEN 'M01.01.01' END AS taxonomy_id, '2026-01-01_' || platform || '::' || session_id || '::' || journey_no AS journey_id,
  session_id, NULL AS device_id, session_id AS customer_id, strftime(start_ts, '%Y-%m-%d %H:%M:%S.%g') AS start_ts, strftime(end_ts, '%Y-%m-%d %H:%M:%S.%g') AS end_ts, boundary_reason, n_events_raw, n_events_final, 0 AS n_loop_removed,
  action_ratio, 0.0 AS back_rate, revisit_ratio, median_gap_s, p90_gap_s, max_gap_s, entry_token, exit_token, replace(sequence, ' -> ', ',') AS sequence, span_seconds / 2 AS distance_to_centroid, NULL AS markov_logprob,
  (c = -1)::INT AS geometric_anomaly, 0 AS generative_anomaly, (n_events_final > 5)::INT AS severe_anomaly, CASE WHEN n_events_final > 5 THEN 'long_span' END AS friction_flags, '2026-01-02 03:04:05.000600' AS scored_at FROM sc""")
def loaded_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up as rows of the summary table; sizes stand for clusters, spans for distances."""
    n = F.col("n_events_final")
    rows = rolled(spark, sf_dir).withColumn("cluster", n % 3 - 1).withColumns({
        "taxonomy_id": F.when(F.col("cluster") == 1, "M01.01.01").when(F.col("cluster") == 0, ""), "distance_to_centroid": F.col("span_seconds") / 2, "geometric_anomaly": F.col("cluster") == -1,
        "severe_anomaly": F.when(n > 5, "True").otherwise("no"), "friction_flags": F.lit("far_from_cluster"), "behavioral_friction_flags": F.when(n > 5, "long_span").otherwise(""),
        "customer_id": F.concat(F.lit(" "), "customer_id", F.lit(".0 ")), "scored_at": F.lit("2026-01-02 03:04:05.0006").cast("timestamp"),
    })
    return writers.loaded(rows, "2026-01-01", "v1")
