"""Density clusters and their spanning trees against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.operators import density, spanning


def rows_of(spark, x, run=0):
    return spark.createDataFrame([(run, int(i), [float(c) for c in v]) for i, v in enumerate(x)], "run int, id long, v array<double>")


@pytest.mark.parametrize("kind", ["blobs", "copies", "line"])
def test_tree_equals_numpy(spark, monkeypatch, kind):
    monkeypatch.setattr(spanning, "BLOCK", 60)  # several cells and blocks
    monkeypatch.setattr(spanning, "LIST", 6)  # short lists, so that points must search again
    rng = np.random.default_rng(3)
    x = {
        "blobs": np.concatenate([rng.normal(m, 0.3, (80, 3)) for m in (0, 6, 20)]), "line": np.column_stack([np.cumsum(rng.exponential(size=150)), np.zeros(150)]),
        "copies": np.repeat(rng.normal(size=(25, 2)), 8, axis=0),
    }[kind]
    got = spanning.tree(rows_of(spark, x)).collect()
    want = density.tree_of(x, 5)
    assert len(got) == len(x) - 1
    assert np.sort([r.d for r in got]) == pytest.approx(np.sort(want[:, 2]), abs=1e-6)
    parent = list(range(len(x)))
    for r in got:
        a, b = r.a, r.b
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        assert a != b  # no circle
        parent[a] = b


def test_labels_of_several_runs_equal_numpy(spark):
    rng = np.random.default_rng(8)
    sets = [np.concatenate([rng.normal(0, 0.3, (60, 2)), rng.normal(5, 0.3, (50, 2)), rng.uniform(-8, 12, (15, 2))]), rng.normal(0, 1, (30, 2)), np.zeros((1, 2))]
    points = rows_of(spark, sets[0]).union(rows_of(spark, sets[1], 1)).union(rows_of(spark, sets[2], 2))
    got = {}
    for r in density.labels(points, 20).collect():
        got.setdefault(r.run, {})[r.id] = r.cluster
    for run, x in enumerate(sets):
        mine = np.array([got[run][i] for i in range(len(x))])
        want = density.hdbscan(x, 20)
        assert density.rand_index(mine, want) == 1.0 and ((mine == -1) == (want == -1)).all()
    assert density.labels(points.where("run > 9"), 20).count() == 0


def test_neighbours_are_exact(spark, monkeypatch):
    monkeypatch.setattr(spanning, "BLOCK", 40)
    x = np.random.default_rng(5).normal(size=(200, 4))
    found = spanning.neighbours(spanning._Cells(rows_of(spark, x)), 7).select("id", F.col("near.id").alias("near")).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert {r.id: r.near for r in found} == {i: np.argsort(d[i], kind="stable")[:7].tolist() for i in range(200)}
