"""Exact quantiles and order over whole tables against numpy and plain windows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trailmark.contracts import SegmentRules
from trailmark.operators import clusters as C
from trailmark.operators import events as E
from trailmark.operators import journeys as J
from trailmark.operators import quantiles as Q
from trailmark.operators import ranges as R

AT = (0.0, 0.25, 0.5, 0.9, 0.99, 1.0)


def drawn(kind, n, rng):
    return {
        "even": rng.uniform(-5, 5, n), "heavy": np.exp(rng.normal(0, 40, n)) * rng.choice([-1, 1], n), "ties": rng.integers(0, 4, n).astype(float),
        "one": np.full(n, 0.1), "outlier": np.append(rng.normal(0, 1e-9, n - 2), [1e308, -1e308]), "tiny": rng.uniform(0, 1e-300, n),
    }[kind]


@pytest.mark.parametrize("few", [65_536, 5])
def test_quantiles_equal_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW", few)
    monkeypatch.setattr(Q, "BINS", 16 if few == 5 else 1024)
    rng = np.random.default_rng(few)
    groups = {k: drawn(k, 400, rng) for k in ("even", "heavy", "ties", "one", "outlier", "tiny")} | {None: np.array([3.0]), "two": np.array([1.0, 2.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("even", None), ("even", float("nan")), ("even", float("inf")), ("none", None)]
    got = {r.k: r for r in Q.exact(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", AT).collect()}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        if k == "outlier":
            vs = np.sort(vs)
            assert got[k].q[0] == -1e308 and got[k].q[-1] == 1e308 and got[k].q[2] == pytest.approx((vs[199] + vs[200]) / 2, rel=1e-12)
        else:
            assert got[k].q == pytest.approx(np.quantile(vs, AT).tolist(), rel=1e-12) and got[k].n == len(vs)


def test_quantiles_without_groups_and_rows(spark):
    rows = spark.createDataFrame([(i, i % 7) for i in range(100)], "a int, b int")
    assert Q.one(rows, [], "a", 0.5, "m").collect()[0].m == 49.5
    assert Q.exact(rows.where("a < 0"), [], "a", (0.5,)).collect() == [] and Q.exact(rows.where("a < 0"), ["b"], "a", (0.5,)).collect() == []
    assert C.thresholds(rows, {"x": ("a", 0.9), "y": ("b", 0.5), "z": ("a", 0.1)}).first().asDict() == pytest.approx({"x": 89.1, "y": 3.0, "z": 9.9})
    two = rows.groupBy("b").agg(F.count("*").alias("n"))
    assert {r.b: r.q[0] for r in Q.beside(two, rows.where("b < 3"), ["b"], {"q": ("a", (1.0,))}).collect() if r.q} == {0: 98.0, 1: 99.0, 2: 93.0}


def test_numbers_and_rows_before_equal_windows(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "a", "a", "a", "b", None]), i, rnd.randrange(1000)) for i in range(3000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    order = [F.col("v").desc(), F.col("i")]
    for by in ([], ["k"]):
        w = Window.partitionBy(*by, F.lit(0)).orderBy(*order)
        want = df.withColumn("n", F.row_number().over(w)).withColumn("p", F.lag("v").over(w))
        numbers = R.number(df, order, "n", by)
        assert sorted((r.i, r.n) for r in numbers.collect()) == sorted((r.i, r.n) for r in want.collect())
        assert sorted((r.i, r.p or -1) for r in R.lag(df, order, {"p": "v"}, by).collect()) == sorted((r.i, r.p or -1) for r in want.collect())
        assert R.number(df.where("i < 0"), order, "n", by).count() == 0 and R.lag(df.where("i < 0"), order, {"p": "v"}, by).count() == 0


def test_sweep_equals_a_segmentation_for_each_threshold(spark):
    rnd, rows, t = random.Random(9), [], 1_000_000
    for i in range(600):
        t += rnd.choice([1, 20, 70, 100, 400])
        rows.append((f"s{i // 90}", "ios", rnd.choice(["view", "action"]), rnd.choice(["home", "shop", "login"]), str(1000 * t), i))
    raw = spark.createDataFrame(rows, "session_id string, platform string, key string, segmentation_name string, client_time string, source_row_number long")
    events, grid = E.canonicalize(raw), [30.0, 60.0, 90.0, 120.0, 300.0, 900.0, 1800.0]
    rules = SegmentRules(longest=9, root_after=3, roots=("home",), auth_markers=("login",))
    got = {r.idle_gap_seconds: r for r in J.sweep_idle_gap(events, grid, rules).collect()}
    for tau in grid:
        sizes = [r.n for r in J.segment(events, SegmentRules(**{**rules.__dict__, "idle_seconds": tau})).groupBy("session_id", "journey_no").agg(F.count("*").alias("n")).collect()]
        r = got[tau]
        assert (r.journeys, r.mean_length, r.median_length) == (len(sizes), pytest.approx(np.mean(sizes), abs=0.0051), np.median(sizes))
        assert (r.share_len_lt_3, r.share_len_gt_50) == (pytest.approx(np.mean(np.array(sizes) < 3), abs=1e-4), 0.0)
    assert J.sweep_idle_gap(events.where("false"), grid, rules).count() == 0


@pytest.mark.parametrize("shape", [(7, 3), (1400, 48)])
def test_nearest_centroids_have_one_form_at_every_size(spark, shape):
    rng = np.random.default_rng(1)
    c = rng.integers(0, 3, shape) * 1e4 + 1e8  # ties and cancellation
    x = c[rng.integers(0, len(c), 300)] + rng.integers(0, 2, (300, shape[1]))
    order, d = C._two_nearest(x, c)
    want = np.sqrt(((x[:, None, :] - c[None]) ** 2).sum(-1))
    best = np.argsort(want, axis=1, kind="stable")[:, :2]
    assert (order == best).all() and (d == np.take_along_axis(want, best, 1)).all()
