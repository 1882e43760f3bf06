"""Vocabularies, transitions, clusters, patterns, meanings and names on small fixtures."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import clusters as C
from trailmark.operators import density, embedding, markov, naming, patterns, semantics, serving
from trailmark.operators import vocabulary as V


def test_rare_folding(spark):
    rows = spark.createDataFrame([(0, ["a", "rare_once"], ["A", "COARSE"]), (1, ["a", "b"], ["A", "B"]), (2, ["a", "b"], ["A", "B"])], "k int, s array<string>, c array<string>")
    out = {r.k: r for r in V.fold_rare(rows, "k", "s", "c", 3).collect()}
    assert (out[0].folded, out[0].n_backed_off, out[0].n_rare) == (["a", "<rare>"], 0, 1)
    same = rows.withColumn("c", F.array(F.lit("A"), F.lit("A")))
    assert {r.k: (r.folded, r.n_backed_off) for r in V.fold_rare(same, "k", "s", "c", 3).collect()} == {0: (["a", "A"], 1), 1: (["a", "A"], 1), 2: (["a", "A"], 1)}


def test_markov_skips_unknown_tokens_and_falls_back(spark):
    train = spark.createDataFrame([(1, 0, ["a", "b", "a"]), (2, 0, ["a", "b"])], "k int, c int, s array<string>")
    edges = markov.fit(train, "c", "s")
    rows = spark.createDataFrame([(1, 0, ["a", "b"]), (2, 9, ["a", "b"]), (3, 0, ["a", "new"]), (4, 0, ["a"]), (5, 0, [])], "k int, c int, s array<string>")
    got = {r.k: r.markov_logprob for r in markov.score(rows, "k", "c", "s", edges).collect()}
    assert got[1] == pytest.approx(math.log(2.1 / 2.2)) and got[2] == pytest.approx(got[1])
    assert got[3] is None and got[4] is None and got[5] is None


def test_nearest_two_and_ties(spark):
    centers = spark.createDataFrame([(4, [0.0, 0.0]), (8, [10.0, 0.0])], "cluster int, centroid array<double>")
    rows = spark.createDataFrame([(0, [0.1, 0.0]), (1, [9.0, 0.0]), (2, [5.0, 0.0])], "k int, v array<double>")
    got = {r.k: (r.cluster_1, round(r.distance_1, 6), r.cluster_2, round(r.distance_2, 6)) for r in C.nearest(rows, "k", "v", centers).collect()}
    assert got == {0: (4, 0.1, 8, 9.9), 1: (8, 1.0, 4, 9.0), 2: (4, 5.0, 8, 5.0)}


def test_judge_flags(spark):
    limits = {"distance_p95": 1.0, "markov_p05": -4.0, "markov_p01": -5.0, "back_p90": 0.2, "loops_p90": 0, "revisit_p90": 0.5, "span_p95": 100}
    rows = spark.createDataFrame([(1, 3, 0.5, -1.0, 0.1, 0, 0.1, 5.0), (2, 3, 2.0, -4.5, 0.5, 1, 0.1, 5.0), (3, 3, 0.5, None, 0.1, 0, 0.6, 500.0)], "k int, nearest_cluster int, distance double, markov_logprob double, back_rate double, n_loop_removed int, revisit_ratio double, span_seconds double")
    got = {r.k: (r.cluster, r.severe_anomaly, r.friction_flags) for r in C.judge(rows, limits).collect()}
    assert got == {1: (3, False, ""), 2: (-1, True, "back_heavy|loops|far_from_cluster|unlikely_path"), 3: (3, False, "revisits|long_span")}


def test_patterns_against_enumeration(spark):
    rng = random.Random(2)
    seqs = [[rng.choice("abcd") for _ in range(rng.randint(0, 6))] for _ in range(30)]
    rows = spark.createDataFrame(list(enumerate(seqs)), "k int, s array<string>")

    def holds(p, s):
        it = iter(s)
        return all(t in it for t in p)

    want = {p: n for size in (1, 2, 3) for p in itertools.product("abcd", repeat=size) if (n := sum(holds(p, s) for s in seqs)) >= 6}
    found = patterns.mine(rows, "s", 0.2, longest=3)
    assert {tuple(r.tokens): r.support_count for r in found.collect()} == want
    closed = {p: n for p, n in want.items() if not any(len(q) > len(p) and m == n and holds(p, q) for q, m in want.items())}
    assert {tuple(r.tokens): r.support_count for r in patterns.close(found).collect()} == closed
    ranked = patterns.rank(patterns.close(found), 10)
    own = {r.k: r for r in patterns.candidates(rows, "k", "s", ranked).collect()}
    listed = {r.pattern_id: r for r in ranked.collect()}
    for k, s in enumerate(seqs):
        inside = [r for r in listed.values() if holds(r.tokens, s)]
        best = min(inside, key=lambda r: (-r.length, r.support_count, r.pattern_id)).pattern_id if inside else None
        assert (own[k].matched, own[k].candidate) == (len(inside), best)


def test_embedding_blocks_are_unit_vectors(spark):
    rows = spark.createDataFrame([(i, [random.Random(i).choice("abc") for _ in range(5)], float(i)) for i in range(30)], "k int, s array<string>, n_events_final double")
    model = embedding.fit_tfidf(rows, "k", "s", least=2, most=50)
    weights = model.transform(rows, "k", "s")
    norms = weights.groupBy("k").agg(F.sum(F.col("w") * F.col("w")).alias("n")).toPandas().n
    assert np.allclose(norms, 1)
    terms = model.terms.count()
    dense = np.zeros((30, terms))
    for r in weights.collect():
        dense[r.k, r.term] = r.w
    basis = embedding.fit_svd(weights, "k", terms, 3)
    assert np.allclose(np.sort(np.linalg.norm(dense @ basis, axis=0))[::-1], np.linalg.svd(dense)[1][:3], rtol=0.02)
    parts = embedding.join_channels({"primary": F.array(F.lit(1.0), F.lit(0.0)), "coarse": F.array(F.lit(0.0), F.lit(1.0))})
    assert rows.select(parts.alias("v")).first().v == [1.0, 0.0, 0.0, 0.45]
    points = spark.createDataFrame([(i, [float(i), float(i % 3), 1.0]) for i in range(20)], "k int, v array<double>")
    assert all(abs(np.linalg.norm(r.v) - 1) < 1e-6 for r in embedding.reduce(points, "v", 2).collect())


def test_planted_clusters_are_found():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, (60, 2)) for c in ((0, 0), (5, 0), (0, 5))] + [rng.uniform(-3, 8, (25, 2))])
    labels = density.hdbscan(x, 20, 5)
    parts = [labels[i * 60 : (i + 1) * 60] for i in range(3)]
    assert all((np.bincount(p[p >= 0]).max() > 50) for p in parts) and len(set(labels) - {-1}) == 3
    assert (density.hdbscan(x[:10], 20) == -1).all()


T = semantics.Taxonomy(
    strong={"modem": ("internet", "modem"), "internet": ("internet", "general"), "payment": ("payment", "general"), "device": ("internet", "device")}, fallback={"home": ("home", "general")},
    objects={"modem": "modem"}, operations={"back": "back", "manage": "manage", "click": "select"}, stages={"back": "abort", "manage": "configure", "view": "entry", "select": "browse"},
    aliases={"nav payement": "payment"}, infrastructure=frozenset({"screen", "vc", "btn"}), generic=frozenset({"back", "select"}),
)


def test_automaton_finds_every_phrase():
    rnd = random.Random(3)
    phrases = {" ".join(rnd.choices("abc", k=rnd.randint(1, 4))) for _ in range(60)}
    t = semantics.Taxonomy(strong={p: (p, "m") for p in phrases})
    m = semantics.Matcher(t)
    for _ in range(200):
        words = tuple(rnd.choices("abcd", k=rnd.randint(0, 12)))
        want = sorted((" ".join(words[a:b]), b - a, b) for b in range(len(words) + 1) for a in range(b) if " ".join(words[a:b]) in phrases)
        assert sorted((h[3], h[4], h[5]) for h in m.hits(words)) == want


def test_words_and_labels(spark):
    for path in ("manage_modem", "ManageModemVC", "manage/modem", "hi.example/manage_modem?x=1"):
        assert semantics.words_of(path, T)[-2:] == ("manage", "modem")
    assert semantics.words_of("action_wifi_5GHz", T) == ("action", "wifi", "5ghz")
    assert semantics.words_of("a/{id}/v920/12345", T) == ("a",)
    assert all(semantics.words_of(p, T) == () for p in ("<missing>", "", None, "nan"))
    asked = [("view", "ManageModemVC", None), ("action", "ManageModemVC", "btn_back"), ("action", "HomeVC", "Home/Nav_payement"), ("action", "<missing>", "zzz_unmapped"), ("view", "<missing>", None), ("view", "btn/12345", None), (None, "modem", "x")]
    rows = spark.createDataFrame(asked, "event_type string, screen_context string, segment_name string")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in semantics.annotate(rows, T).collect()}
    modem = "family=internet<-{0}:modem;module=modem<-{0}:modem;object=modem<-{0}:modem".format("screen")
    assert got[asked[0]] == ("internet", "modem", "modem", "manage", "configure", 1.0, f"{modem};operation=manage<-screen:manage")
    around = "family=internet<-context:screen_context;module=modem<-context:screen_context;object=modem<-context:screen_context"
    assert got[asked[1]] == ("internet", "modem", "modem", "back", "abort", 0.55, f"{around};operation=back<-target:back")
    assert got[asked[2]] == ("payment", "general", "unknown", "unknown", "unknown", 0.45, "family=payment<-target:payment;module=general<-target:payment")
    assert got[asked[3]] == got[asked[4]] == ("unknown",) * 5 + (0.0, "")
    assert got[asked[5]] == ("chrome", "container", "unknown", "view", "entry", 0.5, "family=chrome<-screen:container_only;module=container<-screen:container_only;operation=view<-screen:event_type")
    assert got[asked[6]][:5] == ("internet", "modem", "modem", "unknown", "unknown")
    assert T.problems() == [] and semantics.Taxonomy(strong={"screen x": ("a", "b")}, infrastructure=frozenset({"screen"})).problems()
    rows = spark.createDataFrame([("view", "ManageModemVC", "x"), ("view", None, None), ("action", "ManageModemVC", "btn_back")] * 3, "event_type string, screen_context string, segment_name string")
    assert semantics.annotate(rows, T).count() == 9
    assert semantics.coverage(semantics.annotate(rows, T)).first().known_business_family == pytest.approx(6 / 9, abs=1e-6)


def test_carried_names(spark):
    counts = {1: {1: 80, 3: 20}, 2: {1: 40, 2: 40, 3: 20}, 3: {1: 45, 4: 45, 5: 10}, 4: {1: 50, 5: 50}, 5: {-1: 70, 1: 30}}
    names = spark.createDataFrame([(1, "M01.01.01"), (2, "M01.01.01"), (3, "M02.01.01"), (4, "M01.01.02"), (5, "M03.01.01")], "old int, taxonomy_id string")
    pairs = spark.createDataFrame([(n, o, c) for n, m in counts.items() for o, c in m.items()], "new int, old int, n int")
    got = {r.new: (r.step, r.taxonomy_id) for r in naming.carry_names(pairs, names).collect()}
    assert got[1] == ("old_cluster", "M01.01.01") and got[2] == ("taxonomy_id", "M01.01.01") and got[3] == ("submodule", "M01.01")
    assert got[4][0] == "review" and got[5][0] == "new"


def test_names_fall_back_to_noise(spark):
    rows = spark.createDataFrame([(7,), (999,), (-1,)], "cluster int")
    names = spark.createDataFrame([(7, "Internet"), (-1, "Mixed")], "cluster int, cluster_name string")
    assert {r.cluster: r.cluster_name for r in naming.apply_names(rows, "cluster", names).collect()} == {7: "Internet", 999: "Mixed", -1: "Mixed"}
    with pytest.raises(ValueError, match="999"):
        naming.apply_names(rows, "cluster", names, strict=True)


def test_taxonomy_edits(spark):
    schema = "taxonomy_id string, family string, submodule string, detail string"
    leaves = spark.createDataFrame([("M01.01.01", "a", "b", "c"), ("M01.01.02", "a", "b", "d")], schema)
    edits = spark.createDataFrame([("M01.01.01", "a", "b", "new", False), ("M01.01.02", "a", "b", "d", True), ("USR.000001", "x", "y", "z", False)], schema + ", deleted boolean")
    named = spark.createDataFrame([(1, "M01.01.01", "a", "b", "c"), (2, "M01.01.02", "a", "b", "d")], "cluster int, " + schema)
    after, clusters, audit = naming.edit_taxonomy(leaves, edits, named)
    assert {r.taxonomy_id: r.detail for r in after.collect()} == {"M01.01.01": "new", "USR.000001": "z"}
    assert {r.cluster: (r.detail, r.needs_review) for r in clusters.collect()} == {1: ("new", False), 2: ("d", True)}
    assert {r.taxonomy_id: r.change for r in audit.collect()} == {"M01.01.01": "update", "M01.01.02": "delete", "USR.000001": "insert"}
    assert naming.edit_taxonomy(after, edits.where("not deleted"), named)[2].count() == 0  # a rerun changes nothing
    assert {r.problem for r in naming.validate_taxonomy(leaves.union(leaves)).collect()} == {"duplicate_id", "duplicate_path"}


def test_samples_and_holdouts(spark):
    rows = spark.createDataFrame([(i, "large" if i < 8 else "medium" if i < 11 else "small") for i in range(12)], "k int, c string")
    got = {r.c: r["count"] for r in serving.stratified_sample(rows, "c", "k", 6).groupBy("c").count().collect()}
    assert got == {"large": 3, "medium": 2, "small": 1}
    with pytest.raises(ValueError, match="strata"):
        serving.stratified_sample(rows, "c", "k", 2)
    events = spark.createDataFrame([(f"s{d}", d) for d, n in ((1, 2), (2, 3), (3, 2), (4, 4)) for _ in range(n)], "s string, t int")
    split = serving.chronological_holdout(events, "s", "t", 0.25)
    assert {r.s for r in split.where("split = 'test'").collect()} == {"s4"}
    with pytest.raises(ValueError, match="two sessions"):
        serving.chronological_holdout(events.where("s = 's1'"), "s", "t", 0.25)


def test_singular_values_equal_numpy(spark, monkeypatch):
    monkeypatch.setattr(embedding, "_TERMS", 7)
    rng = np.random.default_rng(4)
    x = (rng.random((150, 60)) < 0.1) * rng.standard_normal((150, 60)) * np.exp(-np.arange(60) / 8)
    rows = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], "k int, term int, w double").repartition(5)
    basis, values = embedding.svd(rows, "k", 60, 8)
    _, s, vt = np.linalg.svd(x)
    assert values == pytest.approx(s[:8], rel=1e-6) and np.abs(np.abs((basis * vt[:8].T).sum(axis=0)) - 1).max() < 1e-5
    got = {r.k: r.v for r in embedding.project(rows, "k", basis).collect()}
    assert got.keys() == {i for i in range(150) if x[i].any()} and all(v == pytest.approx(x[i] @ basis, abs=1e-12) for i, v in got.items())
    assert embedding.svd(rows, "k", 60, 100)[0].shape == (60, 60)
