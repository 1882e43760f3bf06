"""Queries on streams and journeys, over the ``events`` table as a click stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import BACK_MARKERS, BOOT_SCREENS, CHROME_SCREENS, STREAM, CleanRules, SegmentRules
from ..functions import names as N
from ..operators import events as E
from ..operators import journeys as J
from ..operators import quantiles
from ..streaming import journey_stream
from .registry import kept, query, table, work_folder

#: Triggers that the event table is read in as a stream, and rows of a file of it.
TRIGGERS, FILE_ROWS = 3, 100_000
#: The table's users pause for hours, so journeys end after half a day.
RULES = SegmentRules(idle_seconds=43200.0, roots=("k0",), auth_markers=("signup",))
CLEAN = CleanRules(cycles=False, drop_chrome=False, drop_boot=False)

EVENTS_SQL = """ev AS (
  SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS session_id, CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END AS platform, ts AS event_time,
    CASE WHEN event_type = 'view' THEN 'view' ELSE 'action' END AS event_type,
    CASE WHEN event_type = 'view' THEN 'k' || CAST(CAST(json_extract_string(props, '$.k') AS INT) // 20 AS VARCHAR) ELSE event_type END AS segment_name FROM events
)"""
SEGMENT_SQL = f"""{EVENTS_SQL}, o AS (
  SELECT *, row_number() OVER w AS rn, (epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1e6 AS gap,
    event_type = 'view' AND segment_name = 'k0' AND lag(segment_name) OVER w <> 'k0' AS root,
    event_type = 'action' AND segment_name LIKE '%signup%' AND NOT (lag(event_type) OVER w = 'action' AND lag(segment_name) OVER w LIKE '%signup%') AS auth
  FROM ev WINDOW w AS (PARTITION BY platform, session_id ORDER BY event_time, event_id)
), seg AS (
  SELECT platform, session_id, rn, event_id, 1 AS journey_no, 0 AS journey_pos, 'session_start' AS boundary_reason FROM o WHERE rn = 1
  UNION ALL
  SELECT platform, session_id, rn, event_id, journey_no + CAST(reason <> '' AS INT), CASE WHEN reason <> '' THEN 0 ELSE since END, reason FROM (
    SELECT o.platform, o.session_id, o.rn, o.event_id, s.journey_no, s.journey_pos + 1 AS since, CASE WHEN o.gap > 43200 THEN 'idle_gap' WHEN s.journey_pos + 1 >= 80 THEN 'length_cap'
      WHEN o.root AND s.journey_pos + 1 >= 6 THEN 'root_return' WHEN o.auth THEN 'auth_change' ELSE '' END AS reason
    FROM seg s JOIN o ON o.platform = s.platform AND o.session_id = s.session_id AND o.rn = s.rn + 1)
)"""
JOURNEY_SQL = f"""{SEGMENT_SQL}, j AS (
  SELECT ev.*, seg.journey_no, seg.journey_pos, seg.boundary_reason, last_value(CASE WHEN ev.event_type = 'view' THEN ev.segment_name END IGNORE NULLS) OVER (
    PARTITION BY ev.platform, ev.session_id, journey_no ORDER BY journey_pos ROWS UNBOUNDED PRECEDING) AS seen
  FROM seg JOIN ev USING (platform, session_id, event_id)
), je AS (
  SELECT *, coalesce(seen, '<missing>') AS screen_context, event_type || '@' || coalesce(seen, '<missing>') || CASE WHEN event_type = 'view' THEN '' ELSE '#' || segment_name END AS event_token FROM j
)"""
ROLLUP_SQL = f"""{JOURNEY_SQL}, runs AS (
  SELECT *, lag(event_token) OVER (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos) IS NOT DISTINCT FROM event_token AS again FROM je
), kept AS (
  SELECT *, (epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos))) / 1e6 AS gap FROM runs WHERE NOT again
), r AS (
  SELECT platform, session_id, journey_no, min(event_time) AS start_ts, max(event_time) AS end_ts, count(*) AS n_events_final, count(DISTINCT event_token) AS n_unique_tokens,
    round(avg(CAST(event_type = 'action' AS INT)), 4) AS action_ratio, round(1 - count(DISTINCT event_token) / count(*), 4) AS revisit_ratio,
    round((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6, 3) AS span_seconds, round(coalesce(quantile_cont(gap, 0.5), 0), 3) AS median_gap_s,
    round(coalesce(quantile_cont(gap, 0.9), 0), 3) AS p90_gap_s, round(coalesce(max(gap), 0), 3) AS max_gap_s, arg_min(event_token, journey_pos) AS entry_token, arg_max(event_token, journey_pos) AS exit_token,
    string_agg(event_token, ' -> ' ORDER BY journey_pos) AS sequence
  FROM kept GROUP BY ALL
), raw AS (
  SELECT platform, session_id, journey_no, count(*) AS n_events_raw, sum(CAST(again AS INT)) AS n_dedup_removed, max(CASE WHEN journey_pos = 0 THEN boundary_reason END) AS boundary_reason FROM runs GROUP BY ALL
)"""


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.from_event_table(table(spark, sf_dir, "events"))


def journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.with_screens(J.segment(stream(spark, sf_dir), RULES))


def rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.roll_up(journeys(spark, sf_dir), CLEAN).withColumn("sequence", F.array_join("sequence_tokens", " -> "))


@query(f"""WITH RECURSIVE {ROLLUP_SQL}
SELECT boundary_reason, count(*) AS journeys, sum(n_events_raw) AS events, round(avg(n_events_final), 4) AS mean_length, round(avg(action_ratio), 4) AS action_ratio, max(n_unique_tokens) AS most_tokens,
  round(sum(span_seconds), 2) AS span_seconds, round(quantile_cont(median_gap_s, 0.5), 3) AS median_gap_s FROM r JOIN raw USING (platform, session_id, journey_no) GROUP BY boundary_reason""")
def journey_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: streams to journeys to one summary a boundary reason."""
    facts = ["boundary_reason", "n_events_raw", "n_events_final", "action_ratio", "n_unique_tokens", "span_seconds", "median_gap_s"]
    rows = kept(rolled(spark, sf_dir).select(*facts))
    out = rows.groupBy("boundary_reason").agg(
        F.count("*").alias("journeys"), F.sum("n_events_raw").alias("events"), F.round(F.avg("n_events_final"), 4).alias("mean_length"), F.round(F.avg("action_ratio"), 4).alias("action_ratio"),
        F.max("n_unique_tokens").alias("most_tokens"), F.round(F.sum("span_seconds"), 2).alias("span_seconds"),
    )
    out = quantiles.beside(out, rows, ["boundary_reason"], {"_q": ("median_gap_s", (0.5,))})
    return out.withColumn("median_gap_s", F.round(F.col("_q")[0], 3)).drop("_q")


@query(f"""WITH RECURSIVE {ROLLUP_SQL}
SELECT platform, session_id, journey_no, boundary_reason, n_events_raw, n_events_final, n_unique_tokens, n_dedup_removed, action_ratio, revisit_ratio, span_seconds, median_gap_s, p90_gap_s, max_gap_s,
  entry_token, exit_token, sequence FROM r JOIN raw USING (platform, session_id, journey_no)""")
def journey_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolled(spark, sf_dir).select(
        *STREAM, "journey_no", "boundary_reason", "n_events_raw", "n_events_final", "n_unique_tokens", "n_dedup_removed", "action_ratio", "revisit_ratio", "span_seconds", "median_gap_s", "p90_gap_s",
        "max_gap_s", "entry_token", "exit_token", "sequence",
    )


@query(f"WITH RECURSIVE {JOURNEY_SQL} SELECT event_id, journey_no, journey_pos, boundary_reason, screen_context, event_token FROM je")
def segment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journeys(spark, sf_dir).select(F.col("source_row_number").alias("event_id"), "journey_no", "journey_pos", "boundary_reason", "screen_context", "event_token")


#: Names under which the table's screens and one of its actions stand for a container, a start and a way back.
STAND_INS = {"k4": "WebViewActivity", "k3": "SplashVC", "error": "btn_back"}
_NAMED = EVENTS_SQL.replace("ev AS (", "plain AS (", 1) + f""", ev AS (
  SELECT * REPLACE (CASE segment_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STAND_INS.items())} ELSE segment_name END AS segment_name) FROM plain
)"""
_AGAIN = "len(list_filter(range(0, len(u)), lambda k: list_aggregate(list_transform(range(0, k + 1), lambda m: u[pos + 1 + m * {p} : pos + (m + 1) * {p}] = u[pos + 1 : pos + {p}]), 'bool_and')))"
#: From je on: containers and starts dropped, runs collapsed, then cycles of two to four tokens, the shortest first.
_COLLAPSE = f""", d AS (
  SELECT *, screen_context IN ({", ".join(f"'{n}'" for n in (*CHROME_SCREENS, *BOOT_SCREENS))}) AS dropped, regexp_matches(lower(segment_name), '{"|".join(BACK_MARKERS)}') AS back FROM je
), e AS (
  SELECT platform, session_id, journey_no, count(*) AS n_events_raw, count_if(dropped) AS n_dropped_screens, min(event_time) AS first, max(event_time) AS last,
    coalesce(list({{'t': event_token, 'a': event_type = 'action', 'b': back, 'ts': event_time}} ORDER BY journey_pos) FILTER (WHERE NOT dropped), []) AS s FROM d GROUP BY ALL
), runs AS (
  SELECT *, list_filter(range(1, len(s) + 1), lambda i: i = 1 OR s[i].t <> s[i - 1].t) AS places FROM e
), f AS (
  SELECT platform, session_id, journey_no, list_transform(places, lambda i: s[i].t) AS u, 0 AS pos, []::BIGINT[] AS kept FROM runs
  UNION ALL
  SELECT platform, session_id, journey_no, u, pos + CASE WHEN r2 > 1 THEN 2 * r2 WHEN r3 > 1 THEN 3 * r3 WHEN r4 > 1 THEN 4 * r4 ELSE 1 END,
    list_concat(kept, range(pos + 1, pos + 1 + CASE WHEN r2 > 1 THEN 2 WHEN r3 > 1 THEN 3 WHEN r4 > 1 THEN 4 ELSE 1 END))
  FROM (SELECT *, {", ".join(f"CASE WHEN pos + {2 * p} <= len(u) THEN {_AGAIN.format(p=p)} ELSE 0 END AS r{p}" for p in (2, 3, 4))} FROM f WHERE pos < len(u))
), k AS (
  SELECT runs.*, list_transform(f.kept, lambda i: s[places[i]]) AS k FROM runs JOIN f USING (platform, session_id, journey_no) WHERE f.pos >= len(f.u)
)"""


@query(f"""WITH RECURSIVE {JOURNEY_SQL.replace(EVENTS_SQL, _NAMED)}{_COLLAPSE}
SELECT platform, session_id, journey_no, n_events_raw, len(k) AS n_events_final, len(list_distinct(list_transform(k, lambda x: x.t))) AS n_unique_tokens, n_dropped_screens,
  len(s) - len(places) AS n_dedup_removed, len(places) - len(k) AS n_loop_removed, CASE WHEN len(k) > 0 THEN round(len(list_filter(k, lambda x: x.a)) / len(k), 4) ELSE 0 END AS action_ratio,
  CASE WHEN len(k) > 0 THEN round(len(list_filter(k, lambda x: x.b)) / len(k), 4) ELSE 0 END AS back_rate,
  CASE WHEN len(k) > 0 THEN round(1 - len(list_distinct(list_transform(k, lambda x: x.t))) / len(k), 4) ELSE 0 END AS revisit_ratio,
  round((epoch_us(coalesce(k[-1].ts, last)) - epoch_us(coalesce(k[1].ts, first))) / 1e6, 3) AS span_seconds, array_to_string(list_transform(k, lambda x: x.t), ' -> ') AS sequence FROM k""")
def cleaned_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up with all of the default cleaning: containers and starts dropped, runs and cycles collapsed."""
    named = F.col("segment_name")
    for k, v in STAND_INS.items():
        named = F.when(F.col("segment_name") == k, v).otherwise(named)
    cut = J.with_screens(J.segment(stream(spark, sf_dir).withColumn("segment_name", named), RULES))
    rows = J.roll_up(cut, CleanRules())
    return rows.select(
        *STREAM, "journey_no", "n_events_raw", "n_events_final", "n_unique_tokens", "n_dropped_screens", "n_dedup_removed", "n_loop_removed", "action_ratio", "back_rate", "revisit_ratio",
        "span_seconds", F.array_join("sequence_tokens", " -> ").alias("sequence"),
    )


@query(f"""WITH RECURSIVE {SEGMENT_SQL}, z AS (SELECT platform, session_id, journey_no, count(*) AS n FROM seg GROUP BY ALL)
SELECT unnest(['sessions', 'journeys', 'events', 'mean_journey_length', 'median_journey_length', 'p90_journey_length', 'max_journey_length', 'journeys_below_min_length']) AS metric,
  unnest([count(DISTINCT session_id)::DOUBLE, count(*)::DOUBLE, sum(n)::DOUBLE, round(avg(n), 2), quantile_cont(n, 0.5), quantile_cont(n, 0.9), max(n)::DOUBLE, count_if(n < 3)::DOUBLE]) AS value FROM z
UNION ALL SELECT 'cut_reason::' || boundary_reason, count(*)::DOUBLE FROM seg WHERE boundary_reason <> '' GROUP BY 1""")
def segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.segmentation_report(J.segment(stream(spark, sf_dir), RULES))


#: The seven thresholds, from an hour to three days: the table's users pause for hours.
_SWEEP = [3600.0, 10800.0, 21600.0, 43200.0, 86400.0, 129600.0, 259200.0]


@query(f"""WITH {EVENTS_SQL}, g AS (SELECT *, coalesce((epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1e6, 0) AS gap, row_number() OVER w AS rn FROM ev WINDOW w AS (PARTITION BY platform, session_id ORDER BY event_time, event_id)),
t AS (SELECT unnest([3600.0, 10800.0, 21600.0, 43200.0, 86400.0, 129600.0, 259200.0])::DOUBLE AS tau), s AS (SELECT tau, platform, session_id, sum(CAST(rn = 1 OR gap > tau AS INT)) OVER (PARTITION BY tau, platform, session_id ORDER BY rn) AS no FROM g, t),
z AS (SELECT tau, platform, session_id, no, count(*) AS n FROM s GROUP BY ALL)
SELECT tau AS idle_gap_seconds, count(*) AS journeys, round(avg(n), 2) AS mean_length, quantile_cont(n, 0.5) AS median_length, round(avg(CAST(n < 3 AS INT)), 4) AS share_len_lt_3, round(avg(CAST(n > 50 AS INT)), 4) AS share_len_gt_50 FROM z GROUP BY tau""")
def idle_gap_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Idle gaps alone, so that the cap and the other rules don't hide their effect."""
    return J.sweep_idle_gap(stream(spark, sf_dir), _SWEEP, SegmentRules(longest=1 << 30, cut_on_root=False, cut_on_auth=False))


@query(f"""WITH {EVENTS_SQL}, g AS (SELECT event_id, (epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1e6 AS gap_prev_seconds, (epoch_us(lead(event_time) OVER w) - epoch_us(event_time)) / 1e6 AS gap_next_seconds
FROM ev WINDOW w AS (PARTITION BY platform, session_id ORDER BY event_time, event_id)) SELECT * FROM g""")
def event_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, sf_dir).select(F.col("source_row_number").alias("event_id"), "gap_prev_seconds", "gap_next_seconds")


@query("""SELECT event_type, count(*) AS rows, count_if(late) AS out_of_order FROM (SELECT event_type, value < lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS late FROM events) GROUP BY event_type""")
def out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source order against another order: the values of each type of event stand in for times."""
    events = table(spark, sf_dir, "events")
    late = E.out_of_order(events.withColumn("t", F.col("value")), "event_type", "event_id", "t").groupBy("event_type").agg(F.count("*").alias("late"))
    rows = events.groupBy("event_type").agg(F.count("*").alias("rows"))
    return rows.join(late, "event_type", "left").select("event_type", "rows", F.coalesce("late", F.lit(0)).alias("out_of_order"))


@query(f"""WITH {EVENTS_SQL} SELECT event_id, CAST(CAST(concat('0x', substr(sha1(concat(platform, chr(31), session_id)), 1, 16)) AS UBIGINT) % 64 AS INT) AS bucket FROM ev""")
def session_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream(spark, sf_dir).select(F.col("source_row_number").alias("event_id"), N.session_bucket(F.col("platform"), F.col("session_id"), 64).alias("bucket"))


@query(f"""WITH {EVENTS_SQL} SELECT event_id, sha1(concat_ws(chr(31), platform, session_id, event_type, segment_name, CAST(event_id AS VARCHAR))) AS stable_id FROM ev""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = map(F.col, ("platform", "session_id", "event_type", "segment_name", "source_row_number"))
    return stream(spark, sf_dir).select(F.col("source_row_number").alias("event_id"), N.stable_id(*parts).alias("stable_id"))


@query(f"""WITH RECURSIVE {JOURNEY_SQL}, m AS (SELECT *, event_token <> lag(event_token, 1, '') OVER w AS fresh FROM je WINDOW w AS (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos)),
i AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos) AS run, row_number() OVER (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos) AS p FROM m)
SELECT platform, session_id, journey_no, run, min(event_token) AS token, count(*) AS n, min(p) AS first_pos, max(p) AS last_pos FROM i GROUP BY platform, session_id, journey_no, run""")
def run_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.run_lengths(journeys(spark, sf_dir), ["platform", "session_id", "journey_no"], ["journey_pos"], "event_token")


@query(f"""WITH RECURSIVE {JOURNEY_SQL}{_COLLAPSE}
SELECT platform, session_id, journey_no, n_events_raw, len(k) AS n_events_final, len(s) - len(places) AS n_dedup_removed, len(places) - len(k) AS n_loop_removed,
  array_to_string(list_transform(k, lambda x: x.t), ' -> ') AS sequence FROM k""")
def cycle_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journeys with runs and cycles collapsed."""
    rules = CleanRules(drop_chrome=False, drop_boot=False)
    return J.roll_up(journeys(spark, sf_dir), rules).select(*STREAM, "journey_no", "n_events_raw", "n_events_final", "n_dedup_removed", "n_loop_removed", F.array_join("sequence_tokens", " -> ").alias("sequence"))


@query(f"""WITH RECURSIVE {JOURNEY_SQL}, c AS (SELECT event_token AS t3, lag(event_token, 1) OVER w AS t2, lag(event_token, 2) OVER w AS t1, lead(event_token) OVER w AS nxt FROM je WINDOW w AS (PARTITION BY platform, session_id, journey_no ORDER BY journey_pos)),
x AS (SELECT t3 AS context, nxt FROM c UNION ALL SELECT t2 || '|' || t3, nxt FROM c WHERE t2 IS NOT NULL UNION ALL SELECT t1 || '|' || t2 || '|' || t3, nxt FROM c WHERE t1 IS NOT NULL),
k AS (SELECT context, nxt, count(*) AS n FROM x WHERE nxt IS NOT NULL GROUP BY ALL)
SELECT context, CAST(sum(n) AS BIGINT) AS n, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) AS entropy FROM k GROUP BY context HAVING sum(n) >= 3""")
def branching_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.branching_entropy(journeys(spark, sf_dir)).select(F.array_join("context", "|").alias("context"), "n", F.round("entropy", 6).alias("entropy"))


@query()
def entropy_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = J.refine_with_entropy(journeys(spark, sf_dir))
    return out.select(F.col("source_row_number").alias("event_id"), "journey_id", F.round("entropy_score", 6).alias("entropy_score"))


@query(f"""WITH {EVENTS_SQL} SELECT a.event_id, b.segment_name AS previous_view, (epoch_us(a.event_time) - epoch_us(b.event_time)) / 1e6 AS seconds_since_view
FROM ev a ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type = 'view') b ON a.platform = b.platform AND a.session_id = b.session_id AND a.event_time > b.event_time""")
def asof_prev_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.previous_view(stream(spark, sf_dir)).select(F.col("source_row_number").alias("event_id"), "previous_view", "seconds_since_view")


@query("""WITH g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS gap, event_type IS DISTINCT FROM lag(event_type) OVER w AND lag(event_type) OVER w IS NOT NULL AS changed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, concat_ws(';', CASE WHEN gap > 43200 THEN 'inactivity' END, CASE WHEN changed THEN 'event_type_change' END) AS split_reasons FROM g)
SELECT event_id, split_reasons, user_id || '#' || sum(CAST(split_reasons <> '' AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS clean_session FROM r""")
def clean_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.clean_sessions(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "ts", 720, ["event_type"])
    return out.select("event_id", "split_reasons", "clean_session")


@query(f"""WITH {EVENTS_SQL}, g AS (SELECT platform, (epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY platform, session_id ORDER BY event_time, event_id))) / 1e6 AS gap FROM ev)
SELECT platform, count(gap) AS gaps, count_if(gap > 21600) AS over_6h, count_if(gap > 43200) AS over_12h, count_if(gap > 86400) AS over_24h FROM g GROUP BY platform""")
def threshold_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = lambda h: F.count_if(F.col("gap_prev_seconds") > h * 3600).alias(f"over_{h}h")
    return stream(spark, sf_dir).groupBy("platform").agg(F.count("gap_prev_seconds").alias("gaps"), over(6), over(12), over(24))


@query("""WITH p AS (SELECT page_id, regexp_extract(url, '^[^:/?#]*://([^#]*)', 1) AS rest FROM pages),
q AS (SELECT page_id, regexp_extract(rest, '^([^?]*)', 1) AS place, regexp_extract(rest, '\\?(.*)$', 1) AS query FROM p),
s AS (SELECT page_id, regexp_extract(place, '^([^/]*)', 1) AS host, list_transform(string_split(regexp_extract(place, '^[^/]*(.*)$', 1), '/'), lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN '{id}'
  WHEN regexp_full_match(lower(x), '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9a-f]{16,}') THEN '{uuid}' WHEN regexp_full_match(x, '[A-Z0-9]{6,}') AND regexp_matches(x, '[0-9]') THEN '{code}' ELSE x END) AS segs,
  list_sort(list_filter(list_transform(string_split(query, '&'), lambda x: lower(regexp_extract(x, '^([^=]*)=', 1)) || '=' || regexp_extract(x, '^[^=]*=(.*)$', 1)), lambda x: regexp_matches(x, '^(tab|cat_id|categoryid|ordertype|type|step|mode|view|status)=.'))) AS kept FROM q),
c AS (SELECT page_id, host || CASE WHEN regexp_replace(array_to_string(segs, '/'), '/+$', '') = '' THEN '/' ELSE regexp_replace(array_to_string(segs, '/'), '/+$', '') END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM s)
SELECT page_id, canonical FROM c""")
def canon_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", N.canonical_url(F.col("url")).alias("canonical"))


@query("""SELECT page_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: regexp_extract(x, '^([^=]*)', 1)), lambda x: x <> ''))), ',') AS keys FROM pages""")
def url_query_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(N.query_keys(F.col("url")), ",").alias("keys"))


@query("""SELECT event_id, event_type || CASE WHEN event_id % 3 = 0 THEN '_close' ELSE '' END AS target, event_id % 3 = 0 AS is_back, CASE WHEN length(CAST(event_id * 1000003 AS VARCHAR)) <= 8 THEN repeat('*', length(CAST(event_id * 1000003 AS VARCHAR)))
  ELSE substr(CAST(event_id * 1000003 AS VARCHAR), 1, 4) || '...' || right(CAST(event_id * 1000003 AS VARCHAR), 4) END AS masked FROM events""")
def name_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.concat("event_type", F.when(F.col("event_id") % 3 == 0, "_close").otherwise(""))
    return table(spark, sf_dir, "events").select("event_id", target.alias("target"), N.is_back(target).alias("is_back"), N.mask_identifier(F.col("event_id") * 1000003).alias("masked"))


@query("""SELECT event_id, epoch_us(ts) // 1000 AS from_millis, epoch_us(ts) // 1000000 * 1000 AS from_seconds FROM events""")
def client_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as milliseconds and as seconds, parsed back."""
    millis, secs = (F.expr(f"unix_micros(cast(ts as timestamp)) div {n}").cast("string") for n in (1000, 1000000))
    return table(spark, sf_dir, "events").select("event_id", F.unix_millis(N.client_time(millis)).alias("from_millis"), F.unix_millis(N.client_time_by_shape(secs)).alias("from_seconds"))


def arriving(rows: DataFrame, time: str, folder: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """``rows`` as a stream of ``TRIGGERS`` triggers, by equal spans of ``time``, out of files that are written below ``folder``.

    A trigger takes a number of files, so each span is dealt over that many, and all of them must have rows: a task deals its
    rows in turn, so a span needs that many rows for each task that reads it.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = rows.agg(F.min(micros), F.max(micros)).first()
    if first is None:
        first = last = 0
    at = F.floor((micros - first) * TRIGGERS / max(1, last - first + 1))
    sizes = {r["at"]: r["count"] for r in rows.groupBy(at.alias("at")).count().collect()}  # a row a trigger
    sizes = [sizes.get(i, 0) for i in range(TRIGGERS)]
    files = max(1, min(max(sizes) // file_rows, min(sizes) // max(1, rows.rdd.getNumPartitions())))
    for i in range(TRIGGERS):  # files that are written one after the other are read so
        rows.where(at == i).repartition(files).write.mode("append").parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query(f"""WITH RECURSIVE {SEGMENT_SQL}, z AS (
  SELECT platform, session_id, journey_no, count(*) AS n_events, max(CASE WHEN journey_pos = 0 THEN boundary_reason END) AS start_reason, epoch_us(max(ts)) // 1000 AS end_ms
  FROM seg JOIN events USING (event_id) GROUP BY platform, session_id, journey_no
), l AS (SELECT *, max(journey_no) OVER (PARTITION BY platform, session_id) AS newest FROM z), w AS (SELECT epoch_us(max(ts)) // 1000 - 2000 AS mark FROM events)
SELECT platform, session_id, journey_no, n_events, start_reason, CASE WHEN journey_no < newest OR end_ms + 43200001 <= mark THEN 'closed' ELSE 'open' END AS state FROM l, w""")
def stream_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of ``TRIGGERS`` triggers in the order of time: journeys closed by then, and the open tails."""
    folder = work_folder(spark)
    raw = arriving(table(spark, sf_dir, "events"), "ts", f"{folder}/in")
    closed = journey_stream.closed_journeys(E.from_event_table(raw, gaps=False), folder, RULES).where("kind = 'journey'")
    tails = journey_stream.open_tails(spark, folder)
    columns = ["platform", "session_id", "journey_no", F.col("n_events").cast("long").alias("n_events"), "start_reason"]
    return closed.select(*columns, F.lit("closed").alias("state")).union(tails.select(*columns, F.lit("open").alias("state")))


@query(f"""WITH RECURSIVE {ROLLUP_SQL} SELECT platform, n_events_final >= 3 AS model_eligible, count(*) AS journeys FROM r GROUP BY ALL""")
def eligible_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.eligible(rolled(spark, sf_dir)).groupBy("platform", "model_eligible").agg(F.count("*").alias("journeys"))


@query(f"""WITH {EVENTS_SQL} SELECT event_id, '["' || event_type || '","' || segment_name || '","' || CASE WHEN event_type = 'view' THEN segment_name ELSE '<missing>' END || '"]' AS exact_token FROM ev""")
def exact_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir).withColumn("screen_name", F.when(F.col("event_type") == "view", F.col("segment_name")))
    return E.exact_tokens(rows).select(F.col("source_row_number").alias("event_id"), "exact_token")
