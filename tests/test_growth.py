"""What must hold on larger tables: whole results, and work that grows no faster than they do."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import clusters as C
from trailmark.operators import journeys as J
from trailmark.operators import embedding, ranges, scoring
from trailmark.operators import patterns as P
from trailmark.operators import vocabulary as V


def test_silhouette_asks_every_row(spark):
    rows = spark.range(10_050).select("id", (F.col("id") % 3).cast("int").alias("c"), F.array(F.rand(1) + F.col("id") % 3, F.rand(2)).alias("v"))
    got = C.silhouette(rows, "c", "v", "id").first()
    assert (got.rows, got.queries) == (10_050, 10_050)
    assert C.silhouette(rows, "c", "v", "id", 100).first().queries == 100


def test_silhouette_of_copies_far_from_the_origin(spark):
    x = np.repeat(np.random.default_rng(1).normal(size=(30, 4)) * 1e-3 + 1e4, 3, axis=0)
    starts = np.array([0, 7, 60])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert C._distance_sums(x, x, starts) == pytest.approx(np.add.reduceat(d, starts, axis=1), rel=1e-9, abs=1e-12)


def _indices(x, labels):
    """Inertia, silhouette, Davies-Bouldin and Calinski-Harabasz by brute force."""
    kinds, own = np.unique(labels, return_inverse=True)
    member = np.eye(len(kinds))[own]
    size = member.sum(0)
    each = np.arange(len(x))
    d = np.concatenate([np.sqrt(sum((x[a : a + 500, None, i] - x[None, :, i]) ** 2 for i in range(x.shape[1]))) @ member for a in range(0, len(x), 500)])
    a, b = d[each, own] / np.maximum(size[own] - 1, 1), d / size
    b[each, own] = np.inf
    value = np.where(size[own] > 1, (b.min(1) - a) / np.maximum(a, b.min(1)), 0)
    c = np.array([x[own == k].mean(0) for k in range(len(kinds))])
    s = np.array([np.linalg.norm(x[own == k] - c[k], axis=1).mean() for k in range(len(kinds))])
    within, between = ((x - c[own]) ** 2).sum(), size @ ((c - x.mean(0)) ** 2).sum(1)
    worst = [max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(kinds)) if j != i) for i in range(len(kinds))]
    return within, value.mean(), np.mean(worst), between / (len(kinds) - 1) / (within / (len(x) - len(kinds)))


def test_sweep_asks_every_row(spark):
    rng = np.random.default_rng(5)
    blob = np.arange(10_050) % 3
    x = np.column_stack([np.array([0.0, 12.0, 100.0])[blob], np.zeros(len(blob))]) + rng.normal(size=(len(blob), 2))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, v array<double>").repartition(6)
    got = {r.k: tuple(r)[1:] for r in C.sweep_kmeans(rows, "v", "id", (2, 3)).collect()}
    assert got == {2: pytest.approx(_indices(x, blob == 2), rel=1e-9), 3: pytest.approx(_indices(x, blob), rel=1e-9)}


def test_sweep_with_copies_single_rows_and_few_rows(spark):
    x = np.array([[0.0, 0.0]] * 5 + [[0.0, 1.0]] * 4 + [[50.0, 0.0], [0.0, 80.0]])
    rows = spark.createDataFrame([(7, v) for v in x.tolist()], "id long, v array<float>")  # one key
    got = {r.k: tuple(r)[1:] for r in C.sweep_kmeans(rows, "v", "id", (3, 4, 11, 12)).collect()}
    assert got.keys() == {3, 4}
    assert got[3] == pytest.approx(_indices(x, [0] * 9 + [1, 2]), rel=1e-9)
    none = C.sweep_kmeans(rows, "v", "id", (11,))
    assert none.columns == ["k", "inertia", "silhouette", "davies_bouldin", "calinski_harabasz"] and none.count() == 0
    same = C.sweep_kmeans(rows.limit(5), "v", "id", (2,)).first()
    assert tuple(same)[1:] == (0.0, None, None, None)


def test_rows_with_the_smallest_hashes(spark):
    rows = spark.range(0, 20_000, 1, 8).withColumnRenamed("id", "k")
    want = [r.k for r in rows.orderBy(F.xxhash64("k"), "k").limit(500).collect()]
    assert sorted(r.k for r in ranges.smallest(rows, "k", 500).collect()) == sorted(want)
    assert ranges.smallest(rows, "k", 20_000).count() == 20_000
    same = rows.withColumn("k", F.lit(1))  # all hashes equal
    assert ranges.smallest(same, "k", 50).count() == 50


def test_entropy_cuts_compute_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    tokens = "abcabdabeabfabcabd"
    schema = "platform string, session_id string, journey_no long, journey_pos int, journey_id string, event_token string"
    rows = spark.createDataFrame([("ios", s, 1, i, f"{s}::1", t) for s in ("x", "y") for i, t in enumerate(tokens)], schema)
    out = J.refine_with_entropy(rows.mapInPandas(count, schema), percentile=0.5)
    assert out.count() == 36 and out.columns == [*rows.columns, "entropy_score", "journey_id_rule"]
    assert seen.value == 36


def test_weights_of_rows_stay_where_they_are(spark):
    held = [["a", "b", "a", "b"], [], None, ["c"], ["a", None, "b"], ["a b", "a"]] + [["a", "b"]] * 4
    rows = spark.createDataFrame(list(enumerate(held)), "k int, s array<string>")
    model = embedding.fit_tfidf(rows, "k", "s", least=2, most=50)
    listed = {r.ngram: (r.term, r.idf) for r in model.terms.collect()}
    grams = {r.k: Counter(r.g) for r in rows.select("k", V.ngrams(F.col("s")).alias("g")).where("g is not null").collect()}
    df = Counter(g for c in grams.values() for g in c)
    assert {g: pytest.approx(math.log((1 + len(held)) / (1 + n)) + 1) for g, n in df.items() if n >= 2} == {g: x for g, (_, x) in listed.items()}
    want = {}
    for k, c in grams.items():
        w = {listed[g][0]: (1 + math.log(n)) * listed[g][1] for g, n in c.items() if g in listed}
        want |= {(k, t): pytest.approx(x / math.sqrt(sum(v * v for v in w.values()))) for t, x in w.items()}
    out = model.by_row(rows, "k", "s")
    assert {(r.k, t): w for r in out.collect() for t, w in zip(r.terms, r.ws)} == want
    assert {(r.k, r.term): r.w for r in model.transform(rows, "k", "s").collect()} == want
    assert "Exchange" not in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("density", [0.05, 0.9])
def test_singular_vectors_in_one_pass(spark, monkeypatch, density):
    rng = np.random.default_rng(4)
    x = (rng.random((150, 60)) < density) * rng.standard_normal((150, 60)) * np.exp(-np.arange(60) / 8)
    rows = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], "k int, term int, w double").repartition(5)
    basis, values = embedding.svd(rows, "k", 60, 8)
    assert values == pytest.approx(np.linalg.svd(x)[1][:8], rel=1e-9)
    monkeypatch.setattr(embedding, "_SQUARE", 0)
    other, rough = embedding.svd(rows, "k", 60, 8)
    assert rough == pytest.approx(values, rel=1e-6) and np.abs(np.abs((basis * other).sum(axis=0)) - 1).max() < 1e-5


def test_fitted_tables_are_written_once(spark):
    columns = ", ".join(f"{c} double" for c in embedding.NUMERIC)
    rows = [(f"j{i}", ["a", "b", "c", "d"][: 2 + i % 3], *[float((i * (j + 3)) % 11) for j in range(len(embedding.NUMERIC))]) for i in range(60)]
    model = scoring.fit(spark.createDataFrame(rows, f"k string, s array<string>, {columns}"), "k", "s", k=3, dimensions=2)
    for table in (model.centers, model.edges):
        assert "Exchange" not in table._jdf.queryExecution().toString()


def test_patterns_are_looked_for_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rng = np.random.default_rng(3)
    rows = [(f"k{i}", [None if x == 6 else "abcdef"[x] for x in rng.integers(0, 7, rng.integers(0, 9))]) for i in range(80)] + [("none", None), ("empty", [])]
    rows = spark.createDataFrame(rows, "k string, s array<string>").repartition(3)
    listed = [["a"], ["a", "b"], ["a", "b", "a"], ["b", "b"], ["c", "a"], ["f", "e", "d", "c"], ["x"], ["a", None], []]
    patterns = spark.createDataFrame([(f"P{i}", p, len(p), 5 + i % 2) for i, p in enumerate(listed)], "pattern_id string, tokens array<string>, length int, support_count long")
    pairs = rows.crossJoin(patterns).where(P.contains(F.col("s"), F.col("tokens"))).collect()
    want = {r.k: sorted(listed.index(p.tokens) for p in pairs if p.k == r.k) for r in rows.collect()}
    held = P.held(rows, "s", listed)
    assert {r.k: r.terms for r in held.collect()} == want
    first = lambda ns: min(((-len(listed[n]), 5 + n % 2, f"P{n}") for n in ns), default=(None,))[-1]
    assert {r.k: (r.matched, r.candidate) for r in P.candidates(rows, "k", "s", patterns).collect()} == {k: (len(ns), first(ns)) for k, ns in want.items()}
    out = embedding.pattern_vectors(rows.mapInPandas(count, rows.schema), "k", "s", patterns, 4).collect()
    assert seen.value == 82
    assert {r.k: r.matched for r in out} == {k: len(ns) for k, ns in want.items()}
    assert all(len(r.v) == 4 and np.linalg.norm(r.v) == pytest.approx(1.0 if r.matched else 0.0, abs=1e-9) for r in out)
    none = embedding.pattern_vectors(rows, "k", "s", patterns.where("false"), 4).collect()
    assert {(r.matched, tuple(r.v)) for r in none} == {(0, (0.0,))}
