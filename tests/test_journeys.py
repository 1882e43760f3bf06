"""Streams and journeys on small fixtures."""

import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trailmark.contracts import CleanRules, SegmentRules
from trailmark.operators import events as E
from trailmark.operators import journeys as J

BASE = 1775001600000


def raw(spark, rows, columns="session_id string, platform string, key string, segmentation_name string, screen_id string, client_time string, source_row_number long"):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], columns)


def cut(spark, rows, rules=SegmentRules()):
    return J.with_screens(J.segment(E.canonicalize(raw(spark, rows)), rules)).orderBy("platform", "session_id", "event_time", "source_row_number").collect()


def test_basic_tokens_gaps_and_reasons(spark):
    out = cut(spark, [("s1", "Android", "view", "home", None, str(BASE)), ("s1", "Android", "action", "click_submit", None, str(BASE + 3000)), ("s1", "Android", "view", "payment", None, str(BASE + 100001))])
    assert [r.event_token for r in out] == ["view@home", "action@home#click_submit", "view@payment"]
    assert [r.boundary_reason for r in out] == ["session_start", "", "idle_gap"]
    assert [(r.gap_prev_seconds, r.gap_next_seconds) for r in out] == [(None, 3.0), (3.0, 97.001), (97.001, None)]


def test_context_is_carried_and_explicit_screens_do_not_move_it(spark):
    out = cut(spark, [
        ("a", "ios", "action", "before_view", None, "1000"), ("a", "ios", "view", "home", None, "2000"), ("a", "ios", "action", "explicit", "payment", "3000"),
        ("a", "ios", "action", "inferred", None, "4000"), ("b", "ios", "action", "other_session", None, "5000"), ("a", "android", "action", "other_platform", None, "6000"),
    ])
    assert {r.event_token for r in out} == {
        "action@<missing>#before_view", "view@home", "action@payment#explicit", "action@home#inferred", "action@<missing>#other_session", "action@<missing>#other_platform",
    }


def test_context_resets_at_boundaries(spark):
    out = cut(spark, [("s", "ios", k, n, None, str(t * 1000)) for k, n, t in (("view", "home", 1), ("action", "x", 2), ("action", "y", 100), ("action", "continue_login", 101), ("action", "z", 102))])
    assert [r.screen_context for r in out] == ["home", "home", "<missing>", "<missing>", "<missing>"]
    assert [r.boundary_reason for r in out] == ["session_start", "", "idle_gap", "auth_change", ""]


def test_limits_are_strict_and_caps_exact(spark):
    rows = [("s", "ios", "action", f"a{i}", None, str(90_000 * (i + 1))) for i in range(7)]
    assert [r.journey_no for r in cut(spark, rows)] == [1] * 7  # a gap of exactly the threshold does not cut
    assert [r.journey_pos for r in cut(spark, rows, SegmentRules(longest=3))] == [0, 1, 2, 0, 1, 2, 0]


def test_aliases_and_invalid_rows(spark):
    df = spark.createDataFrame([("r1", "s", "[CLY]_view", "iOS", "HomeVC", "1775001600000"), ("r2", " ", "[CLY]_view", "iOS", "HomeVC", "1775001600000"), ("r3", "s", "x", "iOS", "HomeVC", "soon")], "`_id.$oid` string, session_id string, key string, `segmentation.segment` string, `segmentation.name` string, timestamp string")
    (row,) = E.canonicalize(df).collect()
    assert (row.record_id, row.platform, row.event_type, row.segment_name) == ("r1", "ios", "view", "HomeVC")
    report = E.intake_report(df).first()
    assert (report.rows_input, report.rows_output, report.invalid_client_time, report.invalid_session_id) == (3, 1, 1, 1)
    with pytest.raises(ValueError, match="lacks columns"):
        E.canonicalize(df.drop("key"))


def test_fold_equals_event_by_event_rules(spark):
    rng = random.Random(4)
    rules = SegmentRules(idle_seconds=50, longest=9, root_after=3, roots=("home",), auth_markers=("login",))
    rows, want = [], []
    for s in range(12):
        t, last, since, no = 0, None, 0, 0
        for _ in range(rng.randint(1, 120)):
            gap = rng.choice([1, 5, 50, 51, 80]) if rng.random() < 0.4 else 1
            t += gap
            kind, name = rng.choice([("view", "home"), ("view", "shop"), ("action", "login"), ("action", "tap")])
            reason = ""
            if last is None:
                reason = "session_start"
            elif gap > 50:
                reason = "idle_gap"
            elif since >= 9:
                reason = "length_cap"
            elif (kind, name) == ("view", "home") and last[1] != "home" and since >= 3:
                reason = "root_return"
            elif name == "login" and last[1] != "login":
                reason = "auth_change"
            since, no = (0, no + 1) if reason else (since, no)
            rows.append((f"s{s:02}", "ios", kind, name, None, str(BASE + t * 1000)))
            want.append((no, since, reason))
            since, last = since + 1, (kind, name)
    assert [(r.journey_no, r.journey_pos, r.boundary_reason) for r in cut(spark, rows, rules)] == want


def test_cycles_by_definition():
    def slow(tokens, longest, repeats):
        out, at = [], 0
        while at < len(tokens):
            for p in range(2, longest + 1):
                n = 1
                while tokens[at + n * p : at + (n + 1) * p] == tokens[at : at + p] and len(tokens) >= at + (n + 1) * p:
                    n += 1
                if n >= repeats and len(tokens) >= at + p * repeats:
                    out += range(at, at + p)
                    at += n * p
                    break
            else:
                out.append(at)
                at += 1
        return out

    for tokens in itertools.product("ab", repeat=7):
        assert J.kept_after_cycles(list(tokens)) == slow(list(tokens), 4, 2)
    assert J.kept_after_cycles(list("ABABAB")) == [0, 1]
    assert J.kept_after_runs(list("AABBA")) == [0, 2, 4]


def test_roll_up_with_everything_dropped_and_nothing_dropped(spark):
    rows = [("s", "android", k, n, None, str(1000 * i)) for i, (k, n) in enumerate([("view", "SplashActivity"), ("view", "MainAppActivity"), ("view", "HomeVC"), ("action", "tap"), ("view", "HiWebViewActivity"), ("view", "payment")], 1)]
    segmented = J.with_screens(J.segment(E.canonicalize(raw(spark, rows))))
    row = J.roll_up(segmented).first()
    assert (row.n_dropped_screens, row.n_events_raw, row.n_events_final) == (3, 6, 3)
    assert row.sequence_tokens == ["view@HomeVC", "action@HomeVC#tap", "view@payment"]
    only = J.roll_up(segmented.where("journey_pos < 2")).first()
    assert (only.n_events_final, only.entry_token, only.revisit_ratio, only.max_gap_s) == (0, None, 0.0, 0.0)
    assert J.roll_up(segmented, CleanRules(cycles=False, drop_boot=False, drop_chrome=False)).first().n_events_final == 6
    assert J.roll_up(segmented.where("false")).count() == 0


def test_entropy_cuts_keep_journeys_apart(spark):
    rows = [("s", "ios", "action", rng, None, str(1000 * i)) for i, rng in enumerate("abcabdabeabfabcabd", 1)]
    out = J.refine_with_entropy(J.with_screens(J.segment(E.canonicalize(raw(spark, rows)))), percentile=0.5)
    sizes = out.groupBy("journey_id").agg(F.count("*").alias("n")).toPandas()
    assert sizes.n.sum() == 18 and len(sizes) > 1
    assert isinstance(sizes, pd.DataFrame)


def test_giving_up_is_told_by_the_stage_where_events_are_labelled(spark):
    rows = [{"session_id": "s", "platform": "ios", "key": "action", "segmentation_name": n, "client_time": str(1_000_000 + 1000 * i), "source_row_number": i} for i, n in enumerate(["btn_back", "pay", "tap"])]
    raw = spark.createDataFrame(rows, "session_id string, platform string, key string, segmentation_name string, client_time string, source_row_number long")
    cut = J.with_screens(J.segment(E.canonicalize(raw)))
    assert J.roll_up(cut).first().back_rate == pytest.approx(0.3333)
    staged = cut.withColumn("operation_stage", F.when(F.col("segment_name") != "btn_back", "abort"))
    assert J.roll_up(staged).first().back_rate == pytest.approx(0.6667)
