"""Queries that look at raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import exploration as X
from ..operators import review
from ..operators import vocabulary as V
from .journey_queries import EVENTS_SQL, stream
from .model_queries import LIFT_SQL, _roles
from .registry import query, table


@query("""WITH v AS (SELECT ts, epoch_us(ts) // 1000 AS x FROM events), u AS (SELECT unnest(['s', 'ms', 'us']) AS unit, unnest([1000000, 1000, 1]) AS k)
SELECT unit, count(*) AS valid, round(quantile_cont(abs(CAST(x AS HUGEINT) * k - epoch_us(ts)) / 86400000000.0, 0.5), 6) AS median_days FROM v, u GROUP BY unit""")
def epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("x", F.expr("unix_micros(cast(ts as timestamp)) div 1000"))
    return X.epoch_unit(rows, "x", "ts")


@query("""SELECT 'event_id' AS clock, count(event_id) AS valid, count(DISTINCT event_id) AS "distinct" FROM events UNION ALL SELECT 'ts', count(ts), count(DISTINCT ts) FROM events UNION ALL SELECT 'value', count(value), count(DISTINCT value) FROM events""")
def clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.primary_clock(table(spark, sf_dir, "events"), ["event_id", "ts", "value"])


@query("""WITH d AS (SELECT l_returnflag, l_extendedprice - 20000 AS x FROM lineitem), t AS (SELECT quantile_cont(x, 0.99) AS top FROM d WHERE x > 0)
SELECT l_returnflag, count_if(x < 0) AS negative, count_if(x = 0) AS zero, count_if(x > top) AS outliers, round(sum(CASE WHEN x > 0 THEN ln(1 + x) END), 4) AS logs FROM d, t GROUP BY l_returnflag""")
def duration_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.duration_flags(table(spark, sf_dir, "lineitem").withColumn("x", F.col("l_extendedprice") - 20000), "x")
    return rows.groupBy("l_returnflag").agg(F.count_if("is_negative").alias("negative"), F.count_if("is_zero").alias("zero"), F.count_if("is_outlier").alias("outliers"), F.round(F.sum("log_value"), 4).alias("logs"))


@query("""SELECT unnest(['o_orderstatus', 'o_custkey', 'o_totalprice']) AS "column", unnest([count_if(o_orderstatus IS NULL), count_if(o_custkey IS NULL), count_if(o_totalprice IS NULL)]) AS missing, unnest([count_if(trim(o_orderstatus) = ''), 0, 0]) AS blank,
unnest([count(DISTINCT o_orderstatus), count(DISTINCT o_custkey), count(DISTINCT o_totalprice)]) AS "distinct" FROM orders""")
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.missing_counts(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_custkey", "o_totalprice"])


@query("""SELECT o_orderstatus, CAST(CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 400000 THEN 21 ELSE floor(o_totalprice / 20000) + 1 END AS BIGINT) AS bin, count(*) AS n FROM orders GROUP BY ALL""")
def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.histogram(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice", 0, 400000, 20)


@query("""WITH n AS (SELECT url AS name, count(*) AS n FROM pages GROUP BY url) SELECT count(*) AS names, count_if(n = 1) AS once, round(avg(CAST(regexp_matches(name, '://') AS INT)), 6) AS with_url, round(avg(CAST(regexp_matches(lower(name), '[0-9a-f]{8}-[0-9a-f]{4}-') AS INT)), 6) AS with_uuid,
round(avg(CAST(regexp_matches(name, '[0-9]{3,}') AS INT)), 6) AS with_number, round(avg(CAST(regexp_matches(name, '\\?') AS INT)), 6) AS with_query FROM n""")
def vocabulary_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.vocabulary_signals(table(spark, sf_dir, "pages"), "url")


_METRICS = f"""{EVENTS_SQL}, a AS (SELECT *, coalesce(lag(segment_name) OVER (PARTITION BY session_id ORDER BY event_time, event_id) = segment_name, false) AS again FROM ev),
m AS (SELECT session_id, count(*) AS events, count_if(event_type = 'view') AS views, count_if(event_type <> 'view') AS actions, count_if(NOT again) AS compressed, count_if(again) AS repeats, round(count_if(again) / count(*), 6) AS repeat_share FROM a GROUP BY session_id)"""


@query(f"WITH {_METRICS} SELECT * FROM m")
def sequence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.sequence_metrics(stream(spark, sf_dir), "session_id", ["event_time", "source_row_number"], "segment_name", "event_type")


@query(f"""WITH {_METRICS}, q AS (SELECT quantile_cont(events, 0.5) AS mid FROM m) SELECT 'shortest' AS reason, arg_min(session_id, (events, session_id)) AS key FROM m UNION ALL SELECT 'median', arg_min(session_id, (abs(events - mid), session_id)) FROM m, q
UNION ALL SELECT 'longest', arg_min(session_id, (-events, session_id)) FROM m UNION ALL SELECT 'most_repeats', arg_min(session_id, (-repeats, session_id)) FROM m""")
def representative_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.representatives(sequence_metrics(spark, sf_dir), "session_id", "events", "repeats")


@query("""WITH g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS gap FROM events)
SELECT user_id, count(*) AS events, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS span_s, round(max(gap), 3) AS max_gap_s, count(DISTINCT event_type) AS n_event_type FROM g GROUP BY user_id""")
def session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.session_summary(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "ts", ["event_type"])


@query("""WITH a AS (SELECT o_custkey, count(*) AS a FROM orders WHERE year(o_orderdate) < 1996 GROUP BY ALL), b AS (SELECT o_custkey, count(*) AS b FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY ALL)
SELECT count(a) AS before, count(b) AS after, count_if(b IS NULL) AS lost, count_if(a IS NULL) AS gained, count_if(a > 1 OR b > 1) AS repeated FROM a FULL JOIN b USING (o_custkey)""")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return X.reconcile(o.where(F.year("o_orderdate") < 1996), o.where(F.year("o_orderdate") >= 1996), "o_custkey")


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_orderkey % 3 END AS cluster, o_orderpriority || o_orderstatus AS s FROM orders), n AS (SELECT s, count(*) AS n FROM r WHERE cluster = -1 GROUP BY s)
SELECT cluster, s, max(CASE WHEN cluster = -1 THEN n ELSE 0 END) AS noise_support FROM r LEFT JOIN n USING (s) GROUP BY cluster, s""")
def noise_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_orderkey") % 3).alias("cluster"), F.concat("o_orderpriority", "o_orderstatus").alias("s"))
    return X.sequence_support(rows, "cluster", "s").groupBy("cluster", "s").agg(F.max("noise_support").alias("noise_support"))


@query("""SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand)), 'a')""")
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.search(table(spark, sf_dir, "part"), ["p_name", "p_brand"], "A", [F.col("p_name"), F.col("p_partkey")]).select("p_partkey", "p_name")


@query("""SELECT label, least(count(*), 20) AS n FROM embeddings GROUP BY label""")
def capped_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.capped_sample(table(spark, sf_dir, "embeddings"), "label", "vec_id", 20).groupBy("label").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT n_nationkey AS cluster, CASE WHEN n_nationkey % 4 = 0 THEN upper(n_name) END AS human, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS rule, CASE WHEN n_nationkey % 3 = 0 THEN lower(n_name) END AS ngram FROM nation)
SELECT cluster, coalesce(human, rule, ngram, 'unclassified') AS name, CASE WHEN human IS NOT NULL THEN 'human' WHEN rule IS NOT NULL THEN 'rule' WHEN ngram IS NOT NULL THEN 'ngram' ELSE 'default' END AS source FROM c""")
def final_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").withColumn("cluster", F.col("n_nationkey"))
    of = lambda k, f: n.where(F.col("n_nationkey") % k == 0).select("cluster", f("n_name").alias("name"))
    return X.final_names(n, of(4, F.upper), of(2, F.col), of(3, F.lower))


@query("""SELECT l_returnflag AS scope, n_name FROM (SELECT DISTINCT l_returnflag, s_nationkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey UNION ALL SELECT DISTINCT CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END, s_nationkey FROM supplier) JOIN nation ON n_nationkey = s_nationkey""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources of unlike columns united by name, then named by a dimension."""
    supplier = table(spark, sf_dir, "supplier")
    lines = table(spark, sf_dir, "lineitem").join(supplier, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("l_returnflag").alias("scope"), "s_nationkey").distinct()
    own = supplier.select("s_nationkey", F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit").alias("scope")).distinct()
    return lines.unionByName(own).join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("scope", "n_name")


@query(LIFT_SQL)
def nested_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-gram evidence nested by cluster and taken apart again."""
    rows = V.ngram_lift(_roles(spark, sf_dir), "cluster", "s")
    return X.unnest(X.nest(rows, ["cluster"]), ["cluster"])


@query()
def table_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in ("orders", "customer", "events"):
        one = X.fingerprint(table(spark, sf_dir, name)).select(F.lit(name).alias("table"), "rows", "checksum")
        out = one if out is None else out.union(one)
    return out


@query("""WITH p AS (SELECT label AS c, CASE WHEN vec_id % 10 = 0 THEN -1 ELSE label // 2 END AS b, vec_id FROM embeddings) SELECT b AS b_cluster, count(*) AS rows, count_if(vec_id % 3 = 0) AS flagged, count(DISTINCT c) AS c_clusters, 'cluster ' || b AS name FROM p WHERE b <> -1 GROUP BY b""")
def secondary_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").alias("c_cluster"), F.expr("case when vec_id % 10 = 0 then -1 else cast(label div 2 as int) end").alias("b_cluster"), (F.col("vec_id") % 3 == 0).alias("odd"))
    names = rows.select("b_cluster").distinct().withColumn("name", F.concat(F.lit("cluster "), "b_cluster"))
    return X.secondary_catalog(rows, names, "odd")


@query("""WITH c AS (SELECT r_name AS family, n_name AS submodule, min('M' || n_nationkey) AS first_id, count(*) AS leaves FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name, n_name)
SELECT *, row_number() OVER (ORDER BY first_id, family, submodule) AS position FROM c""")
def taxonomy_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.choices(_places(spark, sf_dir), ["family", "submodule"])


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return n.select(F.concat(F.lit("M"), "n_nationkey").alias("taxonomy_id"), F.col("r_name").alias("family"), F.col("n_name").alias("submodule"))


@query("""WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NOWHERE' ELSE r_name END AS family, CASE WHEN c_custkey % 7 = 0 THEN 'NOTHING' ELSE n_name END AS submodule FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT c_custkey, CASE WHEN family = 'NOWHERE' THEN 'unknown_family' WHEN submodule = 'NOTHING' THEN 'unknown_submodule' ELSE 'valid' END AS status FROM a""")
def assignment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    rows = table(spark, sf_dir, "customer").join(n, F.col("n_nationkey") == F.col("c_nationkey")).select(
        "c_custkey", F.when(F.col("c_custkey") % 5 == 0, "NOWHERE").otherwise(F.col("r_name")).alias("family"), F.when(F.col("c_custkey") % 7 == 0, "NOTHING").otherwise(F.col("n_name")).alias("submodule")
    )
    return X.assignment_status(rows, _places(spark, sf_dir), ["family", "submodule"]).select("c_custkey", "status")


@query("""WITH n AS (SELECT label, vec_id % 4 AS old, count(*) AS n FROM embeddings GROUP BY ALL) SELECT label, old, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS share FROM n""")
def cluster_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.crosstab(table(spark, sf_dir, "embeddings").withColumn("old", F.col("vec_id") % 4), "label", "old")


@query("""WITH c AS (SELECT c_custkey AS id, c_nationkey AS v FROM customer), s AS (SELECT s_suppkey AS id, s_nationkey + 100 AS v FROM supplier) SELECT id, v FROM s UNION ALL SELECT id, v FROM c WHERE id NOT IN (SELECT id FROM s)""")
def upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one table put in the place of those of another with equal keys."""
    current = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("v"))
    changes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_nationkey") + 100).alias("v"))
    return review.upsert(current, changes, ["id"])
