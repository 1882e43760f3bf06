"""Queries for reports: coverage, distributions, shares, shifts, funnels, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, naming
from ..operators import serving as S
from .journey_queries import EVENTS_SQL, stream
from .registry import kept, query, table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM")).withColumn("year", F.year("o_orderdate"))


@query(f"""WITH {EVENTS_SQL} SELECT strftime(event_time, '%Y-%m') AS month, platform, count(*) AS rows, count(DISTINCT session_id) AS n_session_id, count(DISTINCT segment_name) AS n_segment_name,
  round(100 * avg(CAST(event_type = 'view' AS INT)), 4) AS pct_view FROM ev GROUP BY ALL""")
def coverage_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir).withColumn("month", F.date_format("event_time", "yyyy-MM"))
    return S.coverage(rows, ["month", "platform"], ["session_id", "segment_name"], {"view": F.col("event_type") == "view"})


@query(f"""WITH {EVENTS_SQL} SELECT platform, session_id, count(*) AS events, count_if(event_type = 'view') AS views, count_if(event_type = 'action') AS actions, count(DISTINCT CASE WHEN event_type = 'view' THEN segment_name END) AS screens,
  round((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6, 3) AS span_s, round((epoch_us(max(event_time) FILTER (WHERE event_type = 'view')) - epoch_us(min(event_time) FILTER (WHERE event_type = 'view'))) / 1e6, 3) AS view_span_s FROM ev GROUP BY ALL""")
def session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    view, us = F.col("event_type") == "view", F.unix_micros("event_time")
    span = lambda x: F.round((F.max(x) - F.min(x)) / F.lit(1e6), 3)
    return stream(spark, sf_dir).groupBy("platform", "session_id").agg(
        F.count("*").alias("events"), F.count_if(view).alias("views"), F.count_if(F.col("event_type") == "action").alias("actions"), F.count_distinct(F.when(view, F.col("segment_name"))).alias("screens"),
        span(us).alias("span_s"), span(F.when(view, us)).alias("view_span_s"),
    )


@query(f"""SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean, {', '.join(f'round(quantile_cont(l_extendedprice, {q}), 6) AS p{round(100 * q)}' for q in (.25, .5, .75, .9, .95, .99))},
  max(l_extendedprice) AS max FROM lineitem GROUP BY ALL""")
def quantile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.quantile_table(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query("""SELECT l_returnflag, l_quantity, n, round(sum(n) OVER (PARTITION BY l_returnflag ORDER BY l_quantity) / sum(n) OVER (PARTITION BY l_returnflag), 9) AS ecdf
FROM (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL)""")
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.ecdf(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity")


@query("""SELECT o_orderpriority, round(100 * avg(CAST(n < 3 AS INT)), 4) AS pct_short, count(*) AS orders FROM (SELECT o_orderkey, o_orderpriority, count(l_linenumber) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY ALL""")
def short_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of short groups: orders of fewer than three lines stand for short sessions."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderpriority", F.coalesce("n", F.lit(0)).alias("n"))
    return orders.groupBy("o_orderpriority").agg(F.round(100 * F.avg((F.col("n") < 3).cast("int")), 4).alias("pct_short"), F.count("*").alias("orders"))


@query("""SELECT c_nationkey, count(*) AS customers, CAST(sum(orders) AS BIGINT) AS orders, round(avg(orders), 6) AS mean_orders, max(orders) AS most_orders
FROM (SELECT c_custkey, c_nationkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) GROUP BY ALL""")
def device_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level roll-up: orders by customer, then customers by nation."""
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    each = table(spark, sf_dir, "customer").join(per, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_nationkey", F.coalesce("orders", F.lit(0)).alias("orders"))
    return each.groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.round(F.avg("orders"), 6).alias("mean_orders"), F.max("orders").alias("most_orders"))


@query(f"""WITH {EVENTS_SQL}, c AS (SELECT platform, segment_name, count(*) AS n FROM ev GROUP BY ALL) SELECT platform, segment_name, n, round(100 * n / sum(n) OVER (PARTITION BY platform), 6) AS pct FROM c""")
def key_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.group_share(stream(spark, sf_dir), ["platform"], "segment_name")


@query("""WITH t AS (SELECT event_type, ts + INTERVAL 7 HOUR AS t FROM events), d AS (SELECT event_type, CAST(t AS DATE) AS day, hour(t) AS hour, count(*) AS n FROM t GROUP BY ALL), w AS (SELECT event_type, CAST(t AS DATE) AS day, isodow(t) AS dow, count(*) AS n FROM t GROUP BY ALL)
SELECT event_type, 'hour' AS unit, hour AS at, round(avg(n), 6) AS mean_rows, count(*) AS days FROM d GROUP BY ALL UNION ALL SELECT event_type, 'dow', dow, round(avg(n), 6), count(*) FROM w GROUP BY ALL""")
def hour_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours, days = S.hourly(table(spark, sf_dir, "events"), ["event_type"], "ts")
    return hours.select("event_type", F.lit("hour").alias("unit"), F.col("hour").alias("at"), "mean_rows", "days").union(days.select("event_type", F.lit("dow"), "dow", "mean_rows", "days"))


@query(f"""WITH {EVENTS_SQL}, c AS (SELECT platform, segment_name, count(*) AS n FROM ev WHERE event_type = 'view' GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY n DESC, segment_name) AS rank FROM c) WHERE rank <= 3""")
def top_screens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stream(spark, sf_dir).where("event_type = 'view'").groupBy("platform", "segment_name").agg(F.count("*").alias("n"))
    return S.top_n(counts, ["platform"], [F.col("n").desc(), F.col("segment_name")], 3)


@query("""WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1995), b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996)
SELECT o_custkey, 'new' AS change FROM (FROM b EXCEPT FROM a) UNION ALL SELECT o_custkey, 'dropped' FROM (FROM a EXCEPT FROM b)""")
def vocab_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return S.drift(o.where("year = 1995"), o.where("year = 1996"), ["o_custkey"])


@query("""WITH c AS (SELECT year(o_orderdate) AS year, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), s AS (SELECT *, round(100 * n / sum(n) OVER (PARTITION BY year), 6) AS pct FROM c),
e AS (SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS z FROM orders), b AS (SELECT o_orderpriority, round(sum(CASE WHEN year = a THEN pct ELSE 0 END), 6) AS first_pct, round(sum(CASE WHEN year = z THEN pct ELSE 0 END), 6) AS last_pct FROM s, e GROUP BY ALL)
SELECT *, round(last_pct - first_pct, 6) AS delta FROM b ORDER BY abs(round(last_pct - first_pct, 6)) DESC, o_orderpriority LIMIT 10""")
def share_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.share_shift(_orders(spark, sf_dir), "year", "o_orderpriority", 10)


@query("""SELECT o_orderpriority, count_if(o_orderstatus = 'F') AS "F", count_if(o_orderstatus = 'O') AS "O", count_if(o_orderstatus = 'P') AS "P" FROM orders GROUP BY ALL""")
def pivot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("""WITH c AS (SELECT year(o_orderdate) AS year, c_nationkey, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 300000 GROUP BY ALL)
SELECT y.year, k.c_nationkey, coalesce(n, 0) AS n FROM (SELECT DISTINCT year FROM c) y CROSS JOIN (SELECT DISTINCT c_nationkey FROM c) k LEFT JOIN c ON c.year = y.year AND c.c_nationkey = k.c_nationkey""")
def grid_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).where("o_totalprice > 300000").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return S.grid_fill(rows.groupBy("year", "c_nationkey").agg(F.count("*").alias("n")), ["year", "c_nationkey"], "n")


@query(f"""WITH {EVENTS_SQL}, e AS (SELECT ev.*, value FROM ev JOIN events USING (event_id)) SELECT CASE WHEN grouping(platform) = 1 THEN 'all' ELSE platform END AS scope, count(*) AS rows, round(sum(value), 4) AS value, count(DISTINCT session_id) AS n_session_id FROM e GROUP BY GROUPING SETS ((platform), ())""")
def kpi_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "events").select(F.col("event_id").alias("source_row_number"), "value")
    return S.kpi(stream(spark, sf_dir).join(values, "source_row_number"), "platform", {"value": "value"}, ["session_id"])


@query("""SELECT l_shipmode_year AS year, CAST(sum(l_quantity) AS DOUBLE) AS l_quantity, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 6) AS l_discount, round(sum(l_tax * l_quantity) / nullif(sum(l_quantity), 0), 6) AS l_tax
FROM (SELECT *, year(l_shipdate) AS l_shipmode_year FROM lineitem) GROUP BY ALL""")
def weighted_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.weighted_rates(table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate")), ["year"], "l_quantity", ["l_discount", "l_tax"])


@query("""SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(concat_ws('|', CASE WHEN l_discount > 0.08 THEN 'discount' END, CASE WHEN l_tax > 0.06 THEN 'tax' END, CASE WHEN l_quantity > 45 THEN 'quantity' END), '|')) AS flag FROM lineitem) WHERE flag <> '' GROUP BY flag""")
def flag_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.concat_ws("|", *(F.when(F.col(c) > x, n) for n, c, x in (("discount", "l_discount", 0.08), ("tax", "l_tax", 0.06), ("quantity", "l_quantity", 45))))
    return S.explode_flags(table(spark, sf_dir, "lineitem").select(flags.alias("flags")), "flags")


@query("""WITH g AS (SELECT user_id, ts, event_type, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1e6 / 3600 AS h FROM events)
SELECT user_id, count(*) AS rows, count(DISTINCT event_type) AS kinds, count(DISTINCT date_trunc('month', ts)) AS months, round(quantile_cont(h, 0.5), 4) AS median_gap_h, round(count(*) / count(DISTINCT date_trunc('month', ts)), 4) AS per_month FROM g GROUP BY user_id""")
def customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.customer_metrics(table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


@query("""WITH a AS (SELECT user_id, min(ts) AS anchor FROM events WHERE event_type = 'signup' GROUP BY user_id), j AS (SELECT e.user_id, event_type, (epoch_us(ts) - epoch_us(anchor)) / 1e6 / 3600 AS h FROM events e JOIN a USING (user_id)),
b AS (SELECT *, CASE WHEN h <= 24 THEN 0 WHEN h <= 72 THEN 1 WHEN h <= 168 THEN 2 END AS bucket FROM j WHERE h > 0)
SELECT event_type, bucket, count(*) AS rows, count(DISTINCT user_id) AS keys, round(100 * count(DISTINCT user_id) / (SELECT count(*) FROM a), 6) AS pct_cohort FROM b WHERE bucket IS NOT NULL GROUP BY ALL""")
def post_anchor_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.post_anchor(table(spark, sf_dir, "events"), "user_id", "ts", "event_type", F.col("event_type") == "signup", [24, 72, 168])


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""WITH s AS (SELECT user_id, min(ts) AS t FROM events GROUP BY user_id), n AS (SELECT count(*) AS n FROM s), h AS (SELECT user_id, row_number() OVER (ORDER BY t DESC, user_id DESC) AS r FROM s)
SELECT event_id, CASE WHEN r <= least(greatest(1, ceil(n * 0.2)), n - 1) THEN 'test' ELSE 'train' END AS split FROM events JOIN h USING (user_id), n""")
def chrono_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.chronological_holdout(table(spark, sf_dir, "events"), "user_id", "ts", 0.2).select("event_id", "split")


@query("""WITH z AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT count(*) AS k, sum(n) AS total FROM z), e AS (SELECT *, (500 - k) * (n - 1) / (total - k) AS x FROM z, t),
f AS (SELECT *, floor(x) AS base, row_number() OVER (ORDER BY x - floor(x) DESC, o_orderpriority) AS r FROM e) SELECT o_orderpriority, CAST(1 + base + CASE WHEN r <= 500 - k - (SELECT sum(base) FROM f) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM f""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the sample takes from each stratum; which ones they are is a matter of hashes."""
    return S.stratified_sample(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey", 500).groupBy("o_orderpriority").agg(F.count("*").alias("taken"))


@query("""WITH a AS (SELECT o_orderpriority, count(*) AS a FROM orders WHERE year(o_orderdate) <= 1995 GROUP BY ALL), b AS (SELECT o_orderpriority, count(*) AS b FROM orders WHERE year(o_orderdate) > 1995 GROUP BY ALL),
s AS (SELECT o_orderpriority, greatest(coalesce(a, 0) / sum(a) OVER (), 1e-6) AS p, greatest(coalesce(b, 0) / sum(b) OVER (), 1e-6) AS q FROM a FULL JOIN b USING (o_orderpriority))
SELECT o_orderpriority, round(p, 9) AS p, round(q, 9) AS q, round((q - p) * ln(q / p), 9) AS psi FROM s""")
def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return S.stability_index(o.where("year <= 1995"), o.where("year > 1995"), "o_orderpriority").select("o_orderpriority", *(F.round(c, 9).alias(c) for c in ("p", "q", "psi")))


@query("""SELECT r_name, n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS revenue FROM region JOIN nation ON n_regionkey = r_regionkey
LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def dimension_stitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small dimensions stitched to facts that are summed by key before they are joined."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("revenue"))
    customers = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    places = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    return places.join(customers, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("r_name", "n_name", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("customers", "orders")), F.round(F.coalesce("revenue", F.lit(0.0)), 2).alias("revenue"))


@query("""SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id""")
def ordered_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation's turns in order; a conversation is bounded by its own length."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"), F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"))
    return rows.select("conv_id", F.array_join("t.role", ">").alias("roles"), "turns", "chars")


@query("""SELECT o_orderstatus, count(*) AS orders FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1994-03-01' AND DATE '1996-02-29' GROUP BY o_orderstatus""")
def date_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.between(table(spark, sf_dir, "orders"), "o_orderdate", "1994-03-01", "1996-02-29").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query("""WITH t AS (SELECT n_regionkey AS cluster, printf('M%02d.%02d.%02d', CASE WHEN n_regionkey = 4 THEN n_nationkey % 3 ELSE n_regionkey END, CASE WHEN n_regionkey = 1 THEN n_nationkey % 2 ELSE 7 END, n_nationkey % (1 + n_regionkey)) AS node FROM nation),
l AS (SELECT cluster, count(*) AS agreed, count(DISTINCT node) AS f, count(DISTINCT substr(node, 1, 6)) AS s, count(DISTINCT substr(node, 1, 3)) AS m, min(node) AS node FROM t GROUP BY cluster)
SELECT cluster, CASE WHEN f = 1 THEN node WHEN s = 1 THEN substr(node, 1, 6) WHEN m = 1 THEN substr(node, 1, 3) END AS node,
  CASE WHEN f = 1 THEN 'feature' WHEN s = 1 THEN 'submodule' WHEN m = 1 THEN 'module' ELSE 'unclassified' END AS level, agreed FROM l""")
def shared_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deepest level that all nations of a region share, each nation given a node of a taxonomy."""
    region, n = F.col("n_regionkey"), F.col("n_nationkey")
    node = F.format_string("M%02d.%02d.%02d", F.when(region == 4, n % 3).otherwise(region), F.when(region == 1, n % 2).otherwise(7), n % (1 + region))
    return naming.shared_level(table(spark, sf_dir, "nation").select(region.alias("cluster"), node.alias("node")), "cluster", "node")


@query("""WITH o AS (SELECT year(o_orderdate) AS y, CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE (o_custkey + year(o_orderdate) // 1999) % 4 END AS c, o_totalprice AS d, 'k' || (o_custkey % (year(o_orderdate) - 1985)) AS t FROM orders),
b AS (SELECT * FROM o WHERE y <= 1996), yc AS (SELECT y, c, count(*) AS n FROM o WHERE y > 1996 GROUP BY ALL), bc AS (SELECT c, count(*) AS n FROM b GROUP BY c),
p AS (SELECT y, coalesce(greatest(n / sum(n) OVER (PARTITION BY y), 1e-6), 1e-6) AS q, (SELECT greatest(bc.n / (SELECT count(*) FROM b), 1e-6) FROM bc WHERE bc.c = yc.c) AS p FROM yc)
SELECT y AS day, 'psi' AS signal, round(sum((q - p) * ln(q / p)), 6) AS value FROM p GROUP BY y
UNION ALL SELECT y, 'unassigned_rate', round(avg((c = -1)::INT), 6) FROM o WHERE y > 1996 GROUP BY y
UNION ALL SELECT y, 'new_token_rate', round(count(DISTINCT t) FILTER (WHERE t NOT IN (SELECT t FROM b)) / count(DISTINCT t), 6) FROM o WHERE y > 1996 GROUP BY y""")
def drift_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of orders as days of scored journeys against the first years; few tokens, which the sketch counts without error."""
    year = F.year("o_orderdate")
    cluster = F.when(F.col("o_orderkey") % 11 == 0, -1).otherwise((F.col("o_custkey") + F.floor(year / 1999)) % 4)
    token = F.concat(F.lit("k"), (F.col("o_custkey") % (year - 1985)).cast("string"))
    rows = table(spark, sf_dir, "orders").select(year.alias("day"), F.array(token).alias("s"), F.col("o_totalprice").alias("d"), cluster.cast("int").alias("c"))
    days = kept(drift.sketches(rows, "day", "s", "d", "c"))
    found = drift.signals(drift.united(days.where("day <= 1996")), days.where("day > 1996"))
    return found.where("signal <> 'median_distance_change'").select("day", "signal", F.round("value", 6).alias("value"))
