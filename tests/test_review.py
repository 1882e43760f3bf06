"""Review store, taxonomies as tables, evidence, exports, payloads and scopes on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import density, drift, events, naming, review, scoring, semantics, serving
from trailmark.operators import vocabulary as V
from trailmark.sources import readers

LEAVES = [("M01.01.01",), ("M02.01.01",)]


def test_models_are_swapped_and_edits_are_audited(spark, tmp_path):
    leaves = spark.createDataFrame(LEAVES, "taxonomy_id string")
    old = spark.createDataFrame([("ios", 1, "M01.01.01"), ("ios", 2, "M02.01.01")], "platform string, cluster int, taxonomy_id string")
    new = spark.createDataFrame([("android", 7, "M02.01.01"), ("ios", 7, None)], old.schema)
    named, audit = review.swap_model(old, new, leaves, "v1", "v2", "2026-01-02 03:04:05")
    row = audit.first()
    assert named.collect() == new.collect() and (row.change, row.subject) == ("cluster_refresh", "v2")
    assert row.old == '{"model_version":"v1","clusters":2,"platforms":["ios"]}' and '"platforms":["android","ios"]' in row.new
    with pytest.raises(ValueError, match="M09"):
        review.swap_model(old, new.withColumn("taxonomy_id", F.lit("M09.01.01")), leaves, "v1", "v2", "2026-01-02 03:04:05")
    after, change = review.edit_assignment(old, "ios", 2, "M01.01.01", leaves, "2026-01-03 00:00:00")
    assert {r.taxonomy_id for r in after.collect()} == {"M01.01.01"} and change.count() == 1
    assert review.edit_assignment(old, "ios", 2, "M02.01.01", leaves, "2026-01-03 00:00:00")[1].count() == 0
    for wrong in (("ios", 9, "M01.01.01"), ("ios", 1, "M07.01.01")):
        with pytest.raises(ValueError):
            review.edit_assignment(old, *wrong, leaves, "2026-01-03 00:00:00")
    assert [r.change for r in review.recent(audit.union(change), 1).collect()] == ["assignment"]
    assert {r.platform: r.clusters for r in review.platform_counts(new).collect()} == {"android": 1, "ios": 1}
    root = str(tmp_path / "store")
    for version, rows in (("v1", old), ("v2", new)):
        review.publish(rows, root, version)
        assert review.current(spark, root)[0] == version and review.current(spark, root)[1].count() == 2
    assert {(r.platform, r.cluster) for r in review.delete_stale(old, old.where("cluster = 2"), ["cluster"]).collect()} == {("ios", 2)}
    assert review.upsert(old, old.where("cluster = 2").withColumn("taxonomy_id", F.lit("x")), ["platform", "cluster"]).where("taxonomy_id = 'x'").count() == 1


def test_taxonomy_from_a_table(spark):
    rows = [("strong", "payment_method", "payment", "method"), ("strong", "payment", "payment", None), ("weak", "home", "home", None), ("object", "card", "card", None), ("operation", "pay", "pay", None),
            ("operation", "choose", "select", None), ("alias", "payement", "payment", None), ("alias", "go to", "goto", None), ("infrastructure", "screen", None, None), ("generic", "back", None, None)]
    t = semantics.Taxonomy.from_rows(spark.createDataFrame(rows, "section string, phrase string, value string, module string"))
    asked = [("view", "android/home/payementMethod/cardScreen", None), ("action", "payment", "btn/back"), ("action", "home", "choose_card")]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in semantics.annotate(spark.createDataFrame(asked, "event_type string, screen_context string, segment_name string"), t).collect()}
    assert got[asked[0]][:5] == ("payment", "method", "card", "view", "entry")
    assert got[asked[1]][:2] == ("payment", "general") and got[asked[2]][3:5] == ("select", "browse")
    for bad in (("strong", "payment", "other", None), ("weak", "payment", "home", None), ("object", "screen", "screen", None), ("alias", "x", "payement", None), ("alias", "y", "y", None), ("operation", "fly", "fly", None)):
        with pytest.raises(ValueError):
            semantics.Taxonomy.from_rows(spark.createDataFrame([*rows, bad], "section string, phrase string, value string, module string"))
    drop = ["{id}", "-1", "1671", "DEADBEEF01", "v920", "nil", "None", "NaN"]
    assert semantics.words_of("/".join(["a", *drop, "B12"]), t) == ("a", "b12") or semantics.words_of("/".join(["a", *drop]), t) == ("a",)
    assert semantics.level_column("l3") == "token_l3" and semantics.channel_column("Intent") == "token_l3" and semantics.channel_column("primary", "L2") == "token_l2"
    for wrong in (lambda: semantics.level_column("L9"), lambda: semantics.channel_column("x")):
        with pytest.raises(ValueError, match="expected one of"):
            wrong()


def test_channels_from_sequences_keep_other_tokens(spark):
    rows = spark.createDataFrame([(1, ["view@k1", "<rare>", "action@k1#purchase", "view@k1"]), (2, [])], "k int, s array<string>")
    got = {r.k: r.family for r in semantics.channels_from_sequences(rows, "k", "s", ("family",), semantics.EVENT_TABLE).collect()}
    assert got == {1: ["shop", "<rare>", "payment", "shop"], 2: []}
    d = spark.createDataFrame([("a", 1)], "token string, token_id int")
    assert {(r.t, r.token_id) for r in V.add_token_ids(spark.createDataFrame([("a",), ("b",)], "t string"), "t", d).collect()} == {("a", 1), ("b", None)}


def test_evidence_of_tokens(spark):
    want = {
        "view@home/x": "home/x", "view@<missing>": "", "action@s#click_buy_now": "click_buy_now", "action@s#selectPackage": "selectPackage", "action@s#menu/close": "s", "action@s#NAV_HOME": "s", "action@s#show": "s",
        "action@s#btn_buy": "btn_buy", "action@<missing>#tab": "", "<bos>": "", "<eos>": "", "other": "other", "action@s": "s", "action@s#a#back": "a#back",
    }
    got = {r.t: r.e for r in spark.createDataFrame([(t,) for t in want], "t string").select("t", naming.evidence_text(F.col("t")).alias("e")).collect()}
    assert got == want


def test_exports_payloads_and_bundles(spark, tmp_path):
    raw = spark.createDataFrame([("1", "[CLY]_view", "iOS", "x"), ("2", "other", "Android", "y")], "`_id.$oid` string, key string, `segmentation.segment` string, `segmentation.visit` string")
    clean = readers.clean_export(raw)
    assert clean.columns == ["record_id", "key", "segmentation.segment"] and [r.key for r in clean.orderBy("record_id").collect()] == ["View", None]
    assert [x.count() for x in readers.split_by(clean, "segmentation.segment")] == [1, 1]
    text = '[{"session_id": "a", "client_time": "1700000000"}, {"session_id": "b", "client_time": "1700000000123"}]'
    rows = spark.createDataFrame([(text,), ('{"session_id": "c"}',)], "v string")
    assert [(r.session_id, r.client_time) for r in readers.parse_events(rows, "v").orderBy("session_id").collect()] == [("a", "1700000000000"), ("b", "1700000000123"), ("c", None)]
    lines = spark.createDataFrame([('s1,ios,k,"a ""b"", c",scr,1700000000\r\ns2,android,k,n,scr,1700000000001\n',)], "v string")
    assert [(r.session_id, r.segmentation_name, r.client_time) for r in readers.parse_events(lines, "v", "csv").collect()] == [("s1", 'a "b", c', "1700000000000"), ("s2", "n", "1700000000001")]
    root = str(tmp_path / "runs")
    for part in ("2026_07/ios", "2026_07/android", "all_runs/summary", "2026_08/ios"):
        spark.range(1).write.parquet(f"{root}/{part}")
    assert [tuple(r) for r in readers.bundles(spark, root).collect()] == [("all_runs", "all runs", [], True), ("2026_07", "2026 07", ["android", "ios"], False), ("2026_08", "2026 08", ["ios"], False)]


def test_exact_tokens_scopes_and_labels(spark):
    rows = spark.createDataFrame([("view", 'a "quoted", name', None), ("action", "b", "s")], "event_type string, segment_name string, screen_name string")
    made = events.exact_tokens(rows)
    assert made.select(*events.read_exact_tokens(F.col("exact_token"))).exceptAll(rows).count() == 0
    with pytest.raises(ValueError, match="segment_name"):
        events.exact_tokens(rows.withColumn("segment_name", F.lit("<missing>")))
    assert events.platforms_present(spark.createDataFrame([("ios",), ("web",)], "platform string")) == ["ios"]
    days = spark.createDataFrame([("2026-01-01",), ("2026-01-02",), ("bad",)], "date string")
    assert [serving.between(days, "date", *x).count() for x in (("2026-01-02", None), ("2026-01-01", "2026-01-01"), (None, None))] == [1, 1, 3] and serving.between(days, "other", "2026-01-01", None).count() == 3
    named = naming.label_columns(spark.createDataFrame([("t", None, "f", "my_family"), ("t", "en", "f", None)], "journey_type string, journey_type_en string, business_family string, business_family_code string"))
    assert [(r.type_label, r.family_label) for r in named.collect()] == [("t", "My Family"), ("en", "F")]
    assert [(r.type_label, r.family_label) for r in naming.label_columns(spark.range(1)).collect()] == [("-", "-")]


def test_density_labels_every_row_and_is_stable(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.2, (60, 2)) for c in (0, 5)] + [[[50.0, 50.0]]])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, v array<double>")
    got = {r.k: r for r in density.label_all(rows, "k", "v", sample=80, min_size=15).collect()}
    assert len(got) == 121 and sum(r.fitted for r in got.values()) == 80 and got[120].cluster == -1
    of = [{got[i].cluster for i in range(a, a + 60)} - {-1} for a in (0, 60)]
    assert len(of[0]) == len(of[1]) == 1 and of[0] != of[1]
    runs = density.stability(rows, "k", "v", min_size=15).collect()
    assert sorted(r.run for r in runs) == list(range(5)) and all(r.n_clusters == 2 and r.ari_vs_full > 0.9 for r in runs)
    assert density.rand_index(np.array([0, 0, 1, 1]), np.array([1, 1, 0, 0])) == 1.0


def test_scoring_end_to_end_against_numpy(spark, tmp_path):
    rng = np.random.default_rng(4)
    make = lambda i: (["a", "b", "c"] if i % 2 else ["x", "y", "z"]) * int(rng.integers(1, 4)) + (["q"] if rng.random() < 0.3 else [])
    rows = [(f"j{i}", s := make(i), len(s), 0.1 * (i % 5), float(i), 0.0, 0, 0.2) for i in range(60)] + [("new", ["never", "seen"], 2, 0.0, 1.0, 0.0, 0, 0.0), ("empty", [], 0, 0.0, 0.0, 0.0, 0, 0.0)]
    df = spark.createDataFrame(rows, "k string, s array<string>, n_events_final int, action_ratio double, span_seconds double, back_rate double, n_loop_removed int, revisit_ratio double")
    fitted = scoring.fit(df.where("k like 'j%'"), "k", "s", k=2, dimensions=4, columns=("n_events_final", "action_ratio"))
    fitted.save(str(tmp_path / "m"))
    model = scoring.load(spark, str(tmp_path / "m"))
    got = {r.k: r for r in model.score(df, "k", "s").collect()}
    assert set(got) == {r[0] for r in rows}
    terms = {r.ngram: (r.term, r.idf) for r in model.terms.collect()}
    centers = {r.cluster: np.array(r.centroid) for r in model.centers.collect()}
    counts = {}
    for k, s, *_ in rows[:60]:
        for a, b in zip(s, s[1:]):
            counts.setdefault((got[k].nearest_cluster, a), {}).setdefault(b, 0)
            counts[got[k].nearest_cluster, a][b] += 1
    for k, s, n, action, *_ in rows:
        grams = {}
        padded = ["<bos>", *s, "<eos>"]
        for g in padded + [" ".join(p) for p in zip(padded, padded[1:])]:
            grams[g] = grams.get(g, 0) + 1
        w = np.zeros(len(terms))
        for g, c in grams.items():
            if g in terms:
                w[terms[g][0]] = (1 + np.log(c)) * terms[g][1]
        v = (w / (np.linalg.norm(w) or 1)) @ model.basis
        z = (np.array([np.log1p(n), action]) - model.numeric.means) / model.numeric.scales
        v = np.concatenate([v / (np.linalg.norm(v) or 1), 0.35 * z / (np.linalg.norm(z) or 1)])
        d = {c: np.linalg.norm(v - x) for c, x in centers.items()}
        assert abs(d[got[k].nearest_cluster] - min(d.values())) < 1e-6 and abs(got[k].distance - min(d.values())) < 1e-6
        assert got[k].cluster == (-1 if got[k].distance > model.limits["distance_p95"] else got[k].nearest_cluster)
        after = counts.get((got[k].nearest_cluster, s[-1] if s else None))
        if after:
            assert got[k].next_action == min(after, key=lambda t: (-after[t], t))
    assert got["new"].next_action is None and got["empty"].next_action is None
    assert len({got[f"j{i}"].nearest_cluster for i in range(0, 60, 2)}) == 1


def test_drift_signals_against_exact_counts(spark):
    rng = np.random.default_rng(6)
    rows = []
    for day in range(5):
        for _ in range(400):
            tokens = [f"t{x}" for x in rng.integers(0, 900 + 300 * (day == 4), 12)]
            rows.append((day, tokens, float(rng.exponential(1 + 0.5 * (day == 4))), int(rng.choice([-1, 0, 1, 2], p=[0.05, 0.5, 0.3, 0.15] if day < 4 else [0.2, 0.2, 0.3, 0.3]))))
    rows += [(4, ["t1"], None, None)]
    days = drift.sketches(spark.createDataFrame(rows, "d int, s array<string>, x double, c int"), "d", "s", "x", "c")
    got = {(r.day, r.signal): r for r in drift.signals(drift.united(days.where("day < 3")), days.where("day >= 3")).collect()}
    old, seen = [r for r in rows if r[0] < 3], {t for r in rows if r[0] < 3 for t in r[1]}
    for day in (3, 4):
        own = [r for r in rows if r[0] == day]
        tokens = {t for r in own for t in r[1]}
        assert got[day, "new_token_rate"].value == pytest.approx(len(tokens - seen) / len(tokens), abs=0.03)
        assert got[day, "unassigned_rate"].value == pytest.approx(np.mean([r[3] in (-1, None) for r in own]))
        change = np.median([r[2] for r in own if r[2] is not None]) / np.median([r[2] for r in old]) - 1
        assert got[day, "median_distance_change"].value == pytest.approx(change, abs=0.06)
        share = lambda part, c: max(1e-6, np.mean([(r[3] if r[3] is not None else -1) == c for r in part]))
        assert got[day, "psi"].value == pytest.approx(sum((share(own, c) - share(old, c)) * np.log(share(own, c) / share(old, c)) for c in (-1, 0, 1, 2)))
    assert {s for (d, s), r in got.items() if d == 4 and r.alarm} == set(drift.LIMITS) and not any(r.alarm for (d, _), r in got.items() if d == 3)


def test_shared_levels_and_reviewed_rules(spark):
    rows = [(1, "M01.01.01"), (1, "M01.01.01"), (2, "M01.01.01"), (2, "M01.01.02"), (3, "M01.01.01"), (3, "M01.02"), (4, "M01.01.01"), (4, "M02.01.01"), (5, None), (6, "M03"), (6, None), (7, "M01.01"), (7, "M01.01.05")]
    got = {r.cluster: (r.node, r.level, r.agreed) for r in naming.shared_level(spark.createDataFrame(rows, "c int, n string"), "c", "n").collect()}
    assert got == {1: ("M01.01.01", "feature", 2), 2: ("M01.01", "submodule", 2), 3: ("M01", "module", 2), 4: (None, "unclassified", 2), 5: (None, "unclassified", 0), 6: ("M03", "module", 1), 7: ("M01.01", "submodule", 2)}
    tokens = spark.createDataFrame([(1, "home"), (1, "pay"), (2, "home"), (2, "home"), (3, "pay"), (3, "bill"), (4, "else")], "cluster int, token string")
    rules = spark.createDataFrame([("home", "M09.01.01"), ("pay", "M01.01.01"), ("bill", "M01.01.02")], "token string, node string")
    got = {r.cluster: (r.node, r.level, r.source) for r in naming.reviewed(tokens, rules, ("home",)).collect()}
    assert got == {1: ("M01.01.01", "feature", "rule"), 2: ("M09.01.01", "feature", "hub"), 3: ("M01.01", "submodule", "rule"), 4: (None, "unclassified", "none")}
