"""The stream processors against batch, and their rules for late and broken events."""

import json
import random

from pyspark.sql import functions as F

from trailmark.contracts import SegmentRules
from trailmark.operators import events as E
from trailmark.operators import journeys as J
from trailmark.plans import journey_queries as Q
from trailmark.streaming import journey_stream as S

RULES = SegmentRules(idle_seconds=90, longest=5, root_after=2, roots=("home",), auth_markers=("login",))


def test_session_rules():
    s = S.Session(RULES)
    assert s.append((None, 0, "view", "home"))[0]["error"] == "invalid_client_time"
    assert s.append((100_000, 1, "view", "home")) == []
    assert s.append((97_000, 2, "view", "x"))[0]["error"] == "event_too_late"
    assert s.append((99_000, 3, "view", "x")) == [] and [e[1] for e in s.events] == [3, 1]  # sorted in, no boundary
    assert s.snapshot(3)["kind"] == "collecting"
    (row,) = s.append((200_000, 4, "action", "tap"))
    assert (row["close_reason"], row["start_reason"], row["n_events"]) == ("idle_gap", "session_start", 2)
    assert s.reason == "idle_gap" and s.close("flush")["tokens"] == ["action@<missing>#tap"] and s.close("flush") is None


def test_buffer_cap():
    s = S.Session(SegmentRules(longest=10_000), buffer=3)
    rows = [r for i in range(1, 6) for r in s.append((i * 10, i, "action", "a"))]
    assert [r["close_reason"] for r in rows] == ["buffer_cap"]


def test_stream_equals_batch(spark, tmp_path):
    names = [("view", "home"), ("action", "tap"), ("view", "shop"), ("action", "login"), ("view", "home"), ("action", "tap")]
    rows = [{"session_id": f"s{s}", "platform": "ios", "key": k, "segmentation_name": n, "client_time": str(1_000_000 + 1000 * (i + 100 * (i > 3 and s == 1))), "source_row_number": i} for s in range(3) for i, (k, n) in enumerate(names * 2)]
    rows.append({"session_id": "s0", "platform": "ios", "key": "view", "segmentation_name": "end", "client_time": "900000000", "source_row_number": 99})
    source = tmp_path / "in"
    source.mkdir()
    for part, keep in (("a", rows[:-1]), ("b", rows[-1:]), ("c", [rows[-1] | {"client_time": "1900000000", "source_row_number": 100}])):
        (source / f"{part}.json").write_text("\n".join(map(json.dumps, keep)))
    schema = "session_id string, platform string, key string, segmentation_name string, client_time string, source_row_number long"
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    canonical = raw.select("session_id", "platform", F.col("key").alias("event_type"), F.col("segmentation_name").alias("segment_name"), F.timestamp_millis(F.col("client_time").cast("long")).alias("event_time"), "source_row_number")
    closed = S.finished(S.journeys(canonical, RULES), str(tmp_path))
    got = {(r.session_id, r.journey_no): (r.n_events, r.start_reason) for r in closed.collect() if r.kind == "journey"}
    batch = J.segment(E.canonicalize(spark.createDataFrame(rows[:-1], schema)), RULES)
    want = {(r.session_id, r.journey_no): (r.n, r.reason) for r in batch.groupBy("session_id", "journey_no").agg(F.count("*").alias("n"), F.max("boundary_reason").alias("reason")).collect()}
    assert {k: v for k, v in got.items() if k in want} == want


SCHEMA = "platform string, session_id string, event_time timestamp, event_type string, segment_name string, source_row_number long"


def ticks(spark, folder, triggers):
    """A stream whose triggers read the given lists of (session, ms, type, name), one after the other."""
    number = 0
    for i, rows in enumerate(triggers):
        part = []
        for session, ms, kind, name in rows:
            number += 1
            part.append(("ios", session, ms, kind, name, number))
        df = spark.createDataFrame(part, "platform string, session_id string, ms long, event_type string, segment_name string, source_row_number long")
        df = df.withColumn("event_time", F.timestamp_millis("ms")).select(*(c.split()[0] for c in SCHEMA.split(", ")))
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_triggers_with_timeouts_equal_batch(spark, tmp_path):
    rnd, now, triggers = random.Random(5), 1_000_000, []
    for i in range(6):
        rows = []
        for _ in range(25):
            now += rnd.choice([1, 500, 5_000, 40_000])
            rows.append((f"s{(i + rnd.randrange(2)) % 4}", now, *rnd.choice([("view", "home"), ("view", "shop"), ("action", "tap"), ("action", "login")])))
        now += rnd.choice([0, 95_000, 200_000])  # longer than the idle time: timers fire between triggers
        triggers.append(rows)
    events = ticks(spark, tmp_path / "in", triggers)
    closed = S.finished(S.journeys(events, RULES), str(tmp_path)).where("kind = 'journey'")
    tails = S.open_tails(spark, str(tmp_path))
    got = sorted((r.session_id, r.journey_no, r.start_reason, r.n_events, r.start_ms, r.end_ms) for df in (closed, tails) for r in df.collect())
    raw = [{"session_id": s, "platform": "ios", "key": k, "segmentation_name": n, "client_time": str(ms), "source_row_number": i} for i, (s, ms, k, n) in enumerate(sum(triggers, []), 1)]
    cut = J.segment(E.canonicalize(spark.createDataFrame(raw, "session_id string, platform string, key string, segmentation_name string, client_time string, source_row_number long")), RULES)
    ms = F.unix_millis("event_time")
    want = cut.groupBy("session_id", "journey_no").agg(F.max("boundary_reason").alias("r"), F.count("*").alias("n"), F.min(ms).alias("a"), F.max(ms).alias("b"))
    assert got == sorted(tuple(r) for r in want.select("session_id", "journey_no", "r", "n", "a", "b").collect())
    assert closed.where("close_reason = 'idle_timeout'").count() > 0 and tails.count() > 0
    ids = [r[:2] for r in got]
    assert len(set(ids)) == len(ids)


def test_flush_reset_and_errors(spark, tmp_path):
    events = ticks(spark, tmp_path / "in", [
        [("a", 10_000, "view", "home"), ("b", 10_000, "view", "home"), ("", 10_000, "view", "x"), ("a", None, "view", "x"), (None, 10_500, "view", "x")],
        [("a", 11_000, "control", "flush"), ("b", 11_000, "control", "reset"), ("a", 12_000, "action", "tap"), ("b", 12_000, "action", "tap")],
        [("a", 13_000, "control", "flush"), ("b", 13_000, "control", "flush"), ("c", 13_000, "control", "reset"), ("c", 13_001, "control", "flush")],
    ])
    rows = S.finished(S.journeys(events, RULES), str(tmp_path)).collect()
    closed = sorted((r.session_id, r.journey_no, r.start_reason, r.close_reason, r.n_events) for r in rows if r.kind == "journey")
    assert closed == [("a", 1, "session_start", "flush", 1), ("a", 2, "flush", "flush", 1), ("b", 1, "session_start", "flush", 1)]
    assert sorted(r.error for r in rows if r.kind == "error") == ["invalid_client_time", "missing_session_id", "missing_session_id"]
    assert S.open_tails(spark, str(tmp_path)).count() == 0


def test_flush_all(spark, tmp_path):
    folder = tmp_path / "in"
    events = ticks(spark, folder, [[("a", 10_000, "view", "home"), ("b", 11_000, "view", "home"), ("b", 11_500, "action", "tap")]])
    assert S.finished(S.journeys(events, RULES), str(tmp_path)).where("kind = 'journey'").count() == 0
    control = S.flush_rows(S.open_tails(spark, str(tmp_path)))
    control.select(*(c.split()[0] for c in SCHEMA.split(", "))).write.mode("append").parquet(str(folder))
    rows = S.finished(S.journeys(events, RULES), str(tmp_path)).where("kind = 'journey'").collect()  # the same stream goes on
    assert sorted((r.session_id, r.n_events, r.close_reason) for r in rows) == [("a", 1, "flush"), ("b", 2, "flush")]


def test_forgotten_after_a_while(spark, tmp_path):
    far = 10_000_000
    events = ticks(spark, tmp_path / "in", [[("a", 10_000, "view", "home")], [("z", 200_000, "view", "x")], [("z", 210_000, "view", "x")], [("z", far, "view", "x")], [("z", far + 10, "view", "x")], [("a", far + 20, "view", "x")], [("z", 3 * far, "view", "x")], [("z", 3 * far + 1, "view", "x")]])
    rows = S.finished(S.journeys(events, RULES, remember_seconds=1000), str(tmp_path)).where("session_id = 'a'").collect()
    assert [(r.journey_no, r.start_reason, r.close_reason) for r in sorted(rows, key=lambda r: r.start_ms)] == [(1, "session_start", "idle_timeout")] * 2


def test_fixed_durations(spark, tmp_path):
    events = ticks(spark, tmp_path / "in", [[("a", 1_000, "view", "x"), ("a", 30_999, "view", "x"), ("b", 5, "view", "x")], [("a", 31_000, "view", "x"), ("a", None, "view", "x")], [("a", 62_000, "view", "x"), ("b", 30_004, "view", "x")]])
    rows = S.finished(S.fixed_durations(events), str(tmp_path), S.WINDOWS).collect()
    assert sorted(tuple(r)[1:] for r in rows) == [("a", 1, 1_000, 31_000, 2, 3), ("a", 2, 31_000, 62_000, 1, 1)]


def test_sessions_share_a_value_of_state(spark, tmp_path):
    rows = [(f"s{i}", 10_000 + i, "view", "home") for i in range(60)]
    later = [(f"s{i}", 500_000, "action", "tap") for i in range(30)] + [(None, 500_000, "view", "x")]
    events = ticks(spark, tmp_path / "in", [rows, later, [("z", 500_001, "view", "x")], [("z", 500_002, "view", "x")]])
    out = S.finished(S.journeys(events, RULES, groups=3), str(tmp_path)).collect()
    closed = sorted((r.session_id, r.journey_no, r.n_events, r.start_ms) for r in out if r.kind == "journey")
    assert closed == sorted((f"s{i}", 1, 1, 10_000 + i) for i in range(60))
    assert [(r.session_id, r.error) for r in out if r.kind == "error"] == [(None, "missing_session_id")]
    tails = {(r.session_id, r.journey_no, r.start_reason, r.n_events) for r in S.open_tails(spark, str(tmp_path)).collect()}
    assert tails == {(f"s{i}", 2, "idle_gap", 1) for i in range(30)} | {("z", 1, "session_start", 2)}
    assert spark.read.format("statestore").option("path", f"{tmp_path}/state").option("stateVarName", "group").load().count() <= 3


def test_triggers_of_several_files(spark, tmp_path):
    late = F.when(F.col("id") < 50, F.col("id") * 100).otherwise(F.col("id") + 5_000)  # 50 rows in the first half, 950 in the last sixth
    rows = spark.range(0, 1000, 1, 4).select("id", F.timestamp_seconds(late).alias("ts"))
    stream = Q.arriving(rows, "ts", f"{tmp_path}/in", file_rows=100)
    sizes = rows.groupBy(F.floor(F.unix_seconds("ts") * Q.TRIGGERS / 6000).alias("at")).count().orderBy("at").collect()
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    files = len(spark.read.parquet(f"{tmp_path}/in").inputFiles())
    assert files > Q.TRIGGERS and files % Q.TRIGGERS == 0
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [r["count"] for r in sizes]
