"""Queries on vocabularies, transitions and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import STREAM
from ..operators import clusters as C
from ..operators import markov as M
from ..operators import naming, quantiles, scoring
from ..operators import vocabulary as V
from .journey_queries import JOURNEY_SQL, ROLLUP_SQL, journeys, rolled
from .registry import kept, query, table, work_folder


@query(f"""WITH RECURSIVE {JOURNEY_SQL} SELECT event_token, count(*) AS events, count(DISTINCT (platform, session_id)) AS sessions, epoch_us(min(event_time)) AS first_us, epoch_us(max(event_time)) AS last_us,
  row_number() OVER (ORDER BY count(*) DESC, event_token) AS token_id, arg_min(event_type, (event_time, event_type, segment_name, platform)) AS event_type, arg_min(segment_name, (event_time, event_type, segment_name, platform)) AS segment_name,
  arg_min(platform, (event_time, event_type, segment_name, platform)) AS platform, round(avg(journey_pos), 3) AS mean_place FROM je GROUP BY event_token""")
def token_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = ["event_type", "segment_name", "platform"]
    d = V.token_dictionary(journeys(spark, sf_dir), "event_token", list(STREAM), "event_time", first, {"mean_place": "journey_pos"})
    return d.select("event_token", "events", "sessions", F.unix_micros("first_time").alias("first_us"), F.unix_micros("last_time").alias("last_us"), "token_id", *first, "mean_place")


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, k AS (SELECT r.*, n_events_final % 4 - 1 AS cluster FROM r),
m AS (SELECT cluster, platform, count(*) AS n FROM k GROUP BY ALL), x AS (SELECT cluster, string_agg(platform || '=' || printf('%.3f', round(n / s, 3)), ',' ORDER BY n DESC, platform) AS os_mix FROM (SELECT *, sum(n) OVER (PARTITION BY cluster) AS s FROM m) GROUP BY cluster),
a AS (SELECT cluster, entry_token AS t, count(*) AS n FROM k GROUP BY ALL), b AS (SELECT cluster, exit_token AS t, count(*) AS n FROM k GROUP BY ALL)
SELECT k.cluster, CASE WHEN k.cluster = -1 THEN 'noise' ELSE 'cluster' END AS kind, count(*) AS size, round(count(*) / (SELECT count(*) FROM k), 4) AS share, count(DISTINCT session_id) AS n_sessions, 0 AS n_devices, any_value(os_mix) AS os_mix,
  quantile_cont(n_events_final, 0.5) AS median_length, round(quantile_cont(span_seconds, 0.5), 6) AS median_span_s, round(avg(action_ratio), 4) AS mean_action_ratio, 0.0 AS mean_back_rate, round(avg(revisit_ratio), 4) AS mean_revisit_ratio, 0.0 AS loop_journey_share,
  (SELECT arg_min(t, (-n, t)) FROM a WHERE a.cluster = k.cluster) AS top_entry_token, (SELECT arg_min(t, (-n, t)) FROM b WHERE b.cluster = k.cluster) AS top_exit_token FROM k JOIN x ON x.cluster = k.cluster GROUP BY k.cluster""")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How groups of journeys behave; the number of their events stands for a cluster."""
    rows = kept(rolled(spark, sf_dir).withColumn("cluster", F.col("n_events_final") % 4 - 1))
    out = C.profile(rows, "cluster")
    return out.withColumn("os_mix", F.array_join(F.transform("os_mix", lambda x: F.concat(x["platform"], F.lit("="), F.format_number(x["share"], 3))), ","))


@query(f"""WITH RECURSIVE {JOURNEY_SQL}, s AS (SELECT 'event_token' AS channel, event_token AS token FROM je UNION ALL SELECT 'segment_name', segment_name FROM je UNION ALL SELECT 'event_type', event_type FROM je),
c AS (SELECT channel, token, count(*) AS n FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY n DESC, token) AS r FROM c)
SELECT channel, count(*) AS vocabulary, count_if(n = 1) AS singletons, round(sum(CASE WHEN r <= 5 THEN n ELSE 0 END) / sum(n), 6) AS top_coverage FROM r GROUP BY channel""")
def vocab_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.vocabulary_report(journeys(spark, sf_dir), ["event_token", "segment_name", "event_type"], 5)


@query(f"""WITH RECURSIVE {JOURNEY_SQL}, runs AS (SELECT *, lag(event_token) OVER w IS NOT DISTINCT FROM event_token AS again FROM je WINDOW w AS (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos)), t AS (SELECT platform, session_id, journey_no, journey_pos, event_token AS t, split_part(event_token, '#', 1) AS c FROM runs WHERE NOT again),
a AS (SELECT t, count(DISTINCT (platform, session_id, journey_no)) AS df_t FROM t GROUP BY t), b AS (SELECT c, count(DISTINCT (platform, session_id, journey_no)) AS df_c FROM t GROUP BY c)
SELECT platform || '::' || session_id || '::' || journey_no AS journey_id, string_agg(CASE WHEN df_t >= 300 THEN t WHEN df_c >= 300 THEN c ELSE '<rare>' END, ' ' ORDER BY journey_pos) AS folded, count_if(df_t < 300 AND df_c >= 300) AS n_backed_off,
  count_if(df_t < 300 AND df_c < 300) AS n_rare FROM t JOIN a USING (t) JOIN b USING (c) GROUP BY ALL""")
def rare_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(rolled(spark, sf_dir)).withColumn("coarse", F.transform("sequence_tokens", lambda t: F.substring_index(t, "#", 1)))
    return V.fold_rare(rows, "journey_id", "sequence_tokens", "coarse", 300).withColumn("folded", F.array_join("folded", " "))


_ROLES = "SELECT conv_id, list(role ORDER BY turn) AS s FROM conversations GROUP BY conv_id"


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return rows.select("conv_id", F.col("t.role").alias("s"), (F.col("conv_id") % 4).cast("int").alias("cluster"))


@query(f"""WITH r AS (SELECT conv_id, list_concat(list_concat(['<bos>'], s), ['<eos>']) AS s FROM ({_ROLES})), g AS (SELECT conv_id, s[i] AS ngram FROM r, generate_series(1, len(s)) t(i) UNION ALL SELECT conv_id, s[i] || ' ' || s[i + 1] FROM r, generate_series(1, len(s) - 1) t(i))
SELECT ngram, count(DISTINCT conv_id) AS df, count(*) AS n FROM g GROUP BY ngram""")
def ngram_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ngram_counts(_roles(spark, sf_dir), "s")


LIFT_SQL = f"""WITH r AS (SELECT conv_id % 4 AS cluster, s FROM ({_ROLES})), g AS (SELECT cluster, s[i] AS ngram FROM r, generate_series(1, len(s)) t(i) UNION ALL SELECT cluster, s[i] || ' ' || s[i + 1] FROM r, generate_series(1, len(s) - 1) t(i)),
c AS (SELECT cluster, ngram, count(*) AS n FROM g GROUP BY ALL), m AS (SELECT *, n / sum(n) OVER (PARTITION BY cluster) AS mass, sum(n) OVER (PARTITION BY ngram) / sum(n) OVER () AS share FROM c), l AS (SELECT *, (mass + 1e-9) / (share + 1e-9) AS lift FROM m)
SELECT cluster, rank, ngram, round(lift, 6) AS lift, round(mass, 9) AS mass FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(lift, 9) DESC, n DESC, ngram) AS rank FROM l) WHERE rank <= 8"""


@query(LIFT_SQL)
def ngram_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ngram_lift(_roles(spark, sf_dir), "cluster", "s")


_CLUSTERED = f"""{ROLLUP_SQL}, k AS (SELECT *, n_events_final % 3 AS cluster, platform || '::' || session_id || '::' || journey_no AS journey_id, string_split(sequence, ' -> ') AS s FROM r),
p AS (SELECT journey_id, cluster, s[i] AS src, s[i + 1] AS dst FROM k, generate_series(1, len(s) - 1) t(i)), e AS (SELECT cluster, src, dst, count(*) AS n FROM p GROUP BY ALL UNION ALL SELECT -999, src, dst, count(*) FROM p GROUP BY ALL)"""


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept(rolled(spark, sf_dir).withColumn("cluster", F.col("n_events_final") % 3))


@query(f"WITH RECURSIVE {_CLUSTERED} SELECT * FROM e")
def markov_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.fit(_clustered(spark, sf_dir), "cluster", "sequence_tokens")


@query(f"""WITH RECURSIVE {_CLUSTERED}, v AS (SELECT count(DISTINCT t) AS v FROM (SELECT src AS t FROM p UNION ALL SELECT dst FROM p)), t AS (SELECT cluster, src, sum(n) AS total FROM e GROUP BY ALL),
l AS (SELECT journey_id, avg(ln((n + 0.1) / (total + 0.1 * v))) AS m FROM p JOIN e USING (cluster, src, dst) JOIN t USING (cluster, src), v GROUP BY journey_id)
SELECT journey_id, round(m, 6) AS markov_logprob FROM k LEFT JOIN l USING (journey_id)""")
def markov_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _clustered(spark, sf_dir)
    out = M.score(rows, "journey_id", "cluster", "sequence_tokens", kept(M.fit(rows, "cluster", "sequence_tokens")))
    return out.select("journey_id", F.round("markov_logprob", 6).alias("markov_logprob"))


@query(f"""WITH RECURSIVE {_CLUSTERED}, v AS (SELECT count(DISTINCT t) AS v FROM (SELECT src AS t FROM p UNION ALL SELECT dst FROM p)),
x AS (SELECT *, sum(n) OVER (PARTITION BY cluster, src) AS total, row_number() OVER (PARTITION BY cluster, src ORDER BY n DESC, dst) AS rank FROM e)
SELECT cluster, src, rank, dst, round((n + 0.1) / (total + 0.1 * v), 6) AS probability, round(n / total, 6) AS share FROM x, v WHERE rank <= 3""")
def next_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.next_tokens(kept(M.fit(_clustered(spark, sf_dir), "cluster", "sequence_tokens")))
    return out.withColumns({c: F.round(c, 6) for c in ("probability", "share")})


_VECTORS = """x AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, generate_series(1, 64) t(i)), c AS (SELECT label AS cluster, i, avg(x) AS m, count(*) AS n FROM x GROUP BY ALL),
cc AS (SELECT cluster, max(n) AS size, list(m ORDER BY i) AS centroid FROM c GROUP BY cluster)"""


def _centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding")


@query(f"WITH {_VECTORS} SELECT cluster, size, round(list_sum(centroid), 6) AS total, round(sqrt(list_sum(list_transform(centroid, lambda m: m * m))), 6) AS norm FROM cc")
def cluster_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    add = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    return _centers(spark, sf_dir).select("cluster", "size", F.round(add(F.col("centroid")), 6).alias("total"), F.round(F.sqrt(add(F.transform("centroid", lambda v: v * v))), 6).alias("norm"))


_NEAREST = f"""{_VECTORS}, d AS (SELECT vec_id, cluster, sqrt(list_sum(list_transform(list_zip(embedding::DOUBLE[], centroid), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM embeddings, cc),
nn AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS r FROM d)"""


@query(f"WITH {_NEAREST} SELECT vec_id, cluster AS cluster_1, round(d, 6) AS distance_1 FROM nn WHERE r = 1")
def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _centers(spark, sf_dir)).select("vec_id", "cluster_1", F.round("distance_1", 6).alias("distance_1"))


@query(f"WITH {_NEAREST} SELECT a.vec_id, a.cluster AS cluster_1, round(a.d, 6) AS distance_1, b.cluster AS cluster_2, round(b.d, 6) AS distance_2, round((b.d - a.d) / b.d, 6) AS margin FROM nn a JOIN nn b ON a.vec_id = b.vec_id AND a.r = 1 AND b.r = 2")
def nearest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _centers(spark, sf_dir))
    margin = (F.col("distance_2") - F.col("distance_1")) / F.col("distance_2")
    return out.select("vec_id", "cluster_1", F.round("distance_1", 6).alias("distance_1"), "cluster_2", F.round("distance_2", 6).alias("distance_2"), F.round(margin, 6).alias("margin"))


@query(f"""WITH {_NEAREST}, m AS (SELECT label AS cluster, vec_id, vec_id % 97 AS value, vec_id % 5 AS kind, d FROM embeddings JOIN d USING (vec_id) WHERE d.cluster = label),
k AS (SELECT cluster, kind, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, kind) AS r FROM m GROUP BY cluster, kind)
SELECT m.cluster, count(*) AS size, round(count(*) / (SELECT count(*) FROM m), 6) AS share, round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean, max(k.kind) AS top_kind, arg_min(vec_id, (round(d, 9), vec_id)) AS medoid
FROM m JOIN k ON k.cluster = m.cluster AND k.r = 1 GROUP BY m.cluster""")
def cluster_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumns({"value": F.col("vec_id") % 97, "kind": F.col("vec_id") % 5})
    return C.catalog(rows, "label", "vec_id", "embedding", _centers(spark, sf_dir), "value", "kind")


@query(f"WITH {_NEAREST} SELECT cluster, round(quantile_cont(d, 0.95), 6) AS \"limit\" FROM nn WHERE r = 1 GROUP BY cluster")
def cluster_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = C.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _centers(spark, sf_dir))
    return C.cluster_quantiles(near.select(F.col("cluster_1").alias("cluster"), "distance_1"), "cluster", "distance_1", 0.95).withColumn("limit", F.round("limit", 6))


@query(f"""WITH {_NEAREST}, p AS (SELECT vec_id, label, cluster AS found FROM embeddings JOIN nn USING (vec_id) WHERE r = 1), t AS (SELECT label, found, count(*) AS n FROM p GROUP BY ALL),
s AS (SELECT sum(n * (n - 1) / 2) AS s, sum(n) AS t FROM t), a AS (SELECT sum(n * (n - 1) / 2) AS a FROM (SELECT sum(n) AS n FROM t GROUP BY label)), b AS (SELECT sum(n * (n - 1) / 2) AS b FROM (SELECT sum(n) AS n FROM t GROUP BY found))
SELECT round((s - a * b / (t * (t - 1) / 2)) / ((a + b) / 2 - a * b / (t * (t - 1) / 2)), 6) AS ari FROM s, a, b""")
def adjusted_rand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    near = C.nearest(rows, "vec_id", "embedding", _centers(spark, sf_dir)).select("vec_id", F.col("cluster_1").alias("found"))
    return C.adjusted_rand(rows.join(near, "vec_id"), "label", "found").select(F.round("ari", 6).alias("ari"))


@query(f"""WITH {_VECTORS}, d AS (SELECT label, sqrt(list_sum(list_transform(list_zip(embedding::DOUBLE[], centroid), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM embeddings JOIN cc ON cluster = label),
w AS (SELECT label, avg(d) AS s, sum(d * d) AS within FROM d GROUP BY label), k AS (SELECT cc.*, s, within FROM cc JOIN w ON label = cluster),
r AS (SELECT a.cluster, max((a.s + b.s) / sqrt(list_sum(list_transform(list_zip(a.centroid, b.centroid), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))) AS r FROM k a JOIN k b ON a.cluster <> b.cluster GROUP BY a.cluster),
g AS (SELECT list(m ORDER BY i) AS center FROM (SELECT i, avg(x) AS m FROM x GROUP BY i)), q AS (SELECT sum(size * list_sum(list_transform(list_zip(centroid, center), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS between_, sum(within) AS within, count(*) AS k, sum(size) AS n FROM k, g)
SELECT k AS clusters, round((SELECT avg(r) FROM r), 6) AS davies_bouldin, round((between_ / (k - 1)) / (within / (n - k)), 6) AS calinski_harabasz FROM q""")
def cluster_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = C.quality(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return q.select("clusters", F.round("davies_bouldin", 6).alias("davies_bouldin"), F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@query()
def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sweep_kmeans(table(spark, sf_dir, "embeddings"), "embedding", "vec_id")


@query("""WITH d AS (SELECT a.vec_id, a.label AS own, b.label AS c, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS d, count(*) AS n FROM embeddings a, embeddings b GROUP BY ALL),
s AS (SELECT vec_id, max(CASE WHEN own = c AND n > 1 THEN d / (n - 1) END) AS a, min(CASE WHEN own <> c THEN d / n END) AS b, CAST(sum(n) AS BIGINT) AS rows FROM d GROUP BY vec_id)
SELECT max(rows) AS rows, count(*) AS queries, round(avg(CASE WHEN b IS NOT NULL THEN coalesce((b - a) / greatest(a, b), 0) END), 6) AS silhouette FROM s""")
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = C.silhouette(table(spark, sf_dir, "embeddings"), "label", "embedding", "vec_id")
    return s.withColumn("silhouette", F.round("silhouette", 6))


_LIMITS = {"back_p90": ("back_rate", 0.9), "loops_p90": ("n_loop_removed", 0.9), "revisit_p90": ("revisit_ratio", 0.9), "span_p95": ("span_seconds", 0.95)}


@query(f"""WITH RECURSIVE {ROLLUP_SQL}, t AS (SELECT quantile_cont(revisit_ratio, 0.9) AS rv, quantile_cont(span_seconds, 0.95) AS sp FROM r)
SELECT platform, concat_ws('|', CASE WHEN revisit_ratio > rv THEN 'revisits' END, CASE WHEN span_seconds > sp THEN 'long_span' END) AS flags, count(*) AS n FROM r, t GROUP BY ALL""")
def friction_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(rolled(spark, sf_dir))
    limits = C.thresholds(rows, _LIMITS).first().asDict()
    return rows.groupBy("platform", C.friction_flags(limits).alias("flags")).agg(F.count("*").alias("n"))


_SECOND = "d <= lim * 1.02 AND (d2 - d) / greatest(d, 1e-12) >= 0.01 AND -d2 >= lim2"


@query(f"""WITH {_NEAREST}, p AS (SELECT a.vec_id, a.cluster, a.d, b.d AS d2 FROM nn a JOIN nn b ON a.vec_id = b.vec_id AND a.r = 1 AND b.r = 2), q AS (SELECT cluster, quantile_cont(d, 0.5) AS lim, quantile_cont(-d2, 0.25) AS lim2 FROM p GROUP BY cluster)
SELECT vec_id, CASE WHEN d <= lim THEN 'C_primary' WHEN {_SECOND} THEN 'B_secondary_inference' ELSE 'unassigned_novel' END AS assignment_type,
  CASE WHEN d <= lim THEN 'C:' || p.cluster WHEN {_SECOND} THEN 'B:' || p.cluster ELSE 'UNKNOWN' END AS effective_key FROM p JOIN q ON q.cluster = p.cluster""")
def hierarchy_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tiers over one set of centroids; the negative second distance stands in for the transitions' likelihood."""
    near = C.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", _centers(spark, sf_dir)).withColumn("markov", -F.col("distance_2"))
    near = kept(near)
    limits = quantiles.beside(near.select("cluster_1").distinct(), near, ["cluster_1"], {"l": ("distance_1", (0.5,)), "m": ("markov", (0.25,))})
    limits = limits.select("cluster_1", F.col("l")[0].alias("limit"), F.col("m")[0].alias("markov_limit"))
    rows = near.join(F.broadcast(limits), "cluster_1").select(  # one limit a cluster
        "vec_id", F.col("cluster_1").alias("c_cluster"), F.col("distance_1").alias("c_distance"), F.col("limit").alias("c_limit"), F.col("cluster_1").alias("b_cluster"), F.col("distance_1").alias("b_distance"),
        (F.col("limit") * 1.02).alias("b_limit"), F.col("distance_2").alias("b_second"), F.col("markov").alias("b_markov"), F.col("markov_limit").alias("b_markov_limit"),
    )
    return C.hierarchy(rows, margin=0.01).select("vec_id", "assignment_type", "effective_key")


@query(f"""WITH RECURSIVE {_CLUSTERED}, v AS (SELECT count(DISTINCT t) AS v FROM (SELECT src AS t FROM p UNION ALL SELECT dst FROM p)), t AS (SELECT cluster, src, sum(n) AS total FROM e GROUP BY ALL),
l AS (SELECT journey_id, avg(ln((n + 0.1) / (total + 0.1 * v))) AS m FROM p JOIN e USING (cluster, src, dst) JOIN t USING (cluster, src), v GROUP BY journey_id), z AS (SELECT k.*, m FROM k LEFT JOIN l USING (journey_id)),
q AS (SELECT quantile_cont(m, 0.05) AS q5, quantile_cont(m, 0.01) AS q1, quantile_cont(span_seconds, 0.95) AS sp FROM z)
SELECT CASE WHEN span_seconds > sp THEN -1 ELSE cluster END AS cluster, coalesce(m < q5, false) AS generative_anomaly, coalesce(m < q1, false) OR (span_seconds > sp AND coalesce(m < q5, false)) AS severe_anomaly, count(*) AS n FROM z, q GROUP BY ALL""")
def frozen_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring against frozen thresholds; a journey's span stands in for its distance to a centroid."""
    rows = _clustered(spark, sf_dir).withColumnsRenamed({"cluster": "nearest_cluster"}).withColumn("distance", F.col("span_seconds"))
    edges = kept(M.fit(rows, "nearest_cluster", "sequence_tokens"))
    rows = kept(rows.join(M.score(rows, "journey_id", "nearest_cluster", "sequence_tokens", edges), "journey_id"))
    at = _LIMITS | {"markov_p05": ("markov_logprob", 0.05), "markov_p01": ("markov_logprob", 0.01), "distance_p95": ("distance", 0.95)}
    limits = C.thresholds(rows, at).first().asDict()
    return C.judge(rows, limits).groupBy("cluster", "generative_anomaly", "severe_anomaly").agg(F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {JOURNEY_SQL}, d AS (SELECT event_token, row_number() OVER (ORDER BY count(*) DESC, event_token) AS token_id FROM je GROUP BY event_token) SELECT event_id, token_id FROM je JOIN d USING (event_token)""")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(journeys(spark, sf_dir).select("event_token", "source_row_number", *STREAM, "event_time"))
    d = V.token_dictionary(rows, "event_token", list(STREAM), "event_time").withColumnRenamed("event_token", "token")
    return V.add_token_ids(rows, "event_token", d).select(F.col("source_row_number").alias("event_id"), "token_id")


@query("""WITH n AS (SELECT label AS cluster, 'cluster ' || label AS name FROM embeddings GROUP BY label UNION ALL SELECT 1000, 'unused'), c AS (SELECT label AS cluster, count(*) AS size FROM embeddings GROUP BY label)
SELECT cluster, name, coalesce(size, 0) AS size, round(coalesce(size, 0) / (SELECT count(*) FROM embeddings), 8) AS share, 'all' AS platform FROM n LEFT JOIN c USING (cluster)""")
def named_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    names = rows.select(F.col("label").alias("cluster")).distinct().union(spark.range(1).select(F.lit(1000)))
    names = names.withColumn("name", F.when(F.col("cluster") == 1000, "unused").otherwise(F.concat(F.lit("cluster "), "cluster")))
    return naming.named_catalog(names, rows, "label", "all")


@query()
def scored_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load and score: vectors, centroids, transitions, thresholds, flags and next actions, end to end."""
    rows = kept(rolled(spark, sf_dir))
    root = work_folder(spark)
    scoring.fit(rows, "journey_id", "sequence_tokens").save(f"{root}/model")
    scored = scoring.load(spark, f"{root}/model").score(rows, "journey_id", "sequence_tokens")
    return scored.groupBy("cluster", "severe_anomaly", "friction_flags", "next_action").agg(F.count("*").alias("journeys"), F.round(F.avg("distance"), 4).alias("mean_distance"))
