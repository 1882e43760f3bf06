"""Density clusters (HDBSCAN): a spanning tree of mutual reachability, condensed; the rest is assigned to centroids.

Vectors stay on the cluster: ``spanning`` finds exact neighbours and joins components in rounds. What is then read in order
is the tree's edges, three numbers each, one task a tree; their number is bounded by ``sample``, a documented parameter
of the model's fit. Centroids and assignment (``clusters``) run over any number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import NOISE
from ..store import kept
from . import clusters, ranges, spanning


def tree_of(x: np.ndarray, neighbours: int) -> np.ndarray:
    """Minimum spanning tree of mutual reachability distances of a few points (Prim, one row of distances at a time): (a, b, distance)."""
    n = len(x)
    square = (x**2).sum(1)
    row = lambda i: np.sqrt(np.maximum(square + square[i] - 2 * x @ x[i], 0))
    core = np.array([np.partition(row(i), min(neighbours, n) - 1)[min(neighbours, n) - 1] for i in range(n)])
    best, from_, left = np.full(n, np.inf), np.zeros(n, dtype=int), np.ones(n, dtype=bool)
    edges, at = [], 0
    for _ in range(n - 1):
        left[at] = False
        d = np.maximum(np.maximum(row(at), core), core[at])
        nearer = left & (d < best)
        best[nearer], from_[nearer] = d[nearer], at
        at = int(np.argmin(np.where(left, best, np.inf)))
        edges.append((from_[at], at, best[at]))
    return np.array(sorted(edges, key=lambda e: e[2]))


def hdbscan(x: np.ndarray, min_size: int = 100, neighbours: int = 5) -> np.ndarray:
    """Labels of a few points in memory; -1 is noise."""
    return condense(len(x), tree_of(x, neighbours), min_size) if len(x) >= 2 * min_size else np.full(len(x), NOISE)


def condense(n: int, edges: np.ndarray, min_size: int = 100) -> np.ndarray:
    """Labels of the most stable clusters of the condensed tree of ``n`` points, from the ``edges`` (a, b, distance) in order."""
    if n < 2 * min_size:
        return np.full(n, NOISE)
    parent = list(range(2 * n - 1))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    size, kids, birth = [1] * n + [0] * (n - 1), {}, {}
    for k, (a, b, d) in enumerate(edges):
        a, b = root(int(a)), root(int(b))
        parent[a] = parent[b] = n + k
        size[n + k], kids[n + k], birth[n + k] = size[a] + size[b], (a, b), 1 / max(d, 1e-12)
    members: dict[int, list[tuple[int, float]]] = {}
    below: dict[int, list[int]] = {}
    start: dict[int, float] = {}

    def points(node: int) -> list[int]:
        out, stack = [], [node]
        while stack:
            i = stack.pop()
            stack += kids[i] if i >= n else []
            out += [i] if i < n else []
        return out

    stack = [(2 * n - 2, 2 * n - 2)]  # node of the single-linkage tree, condensed cluster it belongs to
    start[2 * n - 2], members[2 * n - 2], below[2 * n - 2] = 0.0, [], []
    while stack:
        node, cluster = stack.pop()
        if node < n:
            members[cluster].append((node, np.inf))
            continue
        big = [c for c in kids[node] if size[c] >= min_size]
        for c in kids[node]:
            if len(big) == 2:
                start[c], members[c], below[c] = birth[node], [], []
                below[cluster].append(c)
                stack.append((c, c))
            elif c in big:
                stack.append((c, cluster))
            else:
                members[cluster] += [(p, birth[node]) for p in points(c)]
    most = max(birth.values())
    held = {c: sum(min(l, most) - start[c] for _, l in members[c]) + sum(size[k] * (start[k] - start[c]) for k in below[c]) for c in members}
    chosen, value = {}, {}
    for c in sorted(members):  # children have smaller numbers than parents
        own, under = held[c], sum(value[k] for k in below[c])
        chosen[c] = c != 2 * n - 2 and (not below[c] or own >= under)
        value[c] = own if chosen[c] else under
    labels, stack, at = np.full(n, NOISE), [2 * n - 2], 0
    while stack:
        c = stack.pop()
        if chosen[c]:
            labels[points(c)] = at
            at += 1
        else:
            stack += below[c]
    return labels


def label_all(rows: DataFrame, key: str, vector: str, sample: int = 20_000, min_size: int = 100, neighbours: int = 5) -> DataFrame:
    """(key, cluster, fitted) for every row: the fit's own label for the sample, else the nearest cluster's, or noise beyond its farthest fitted member."""
    found = fit(rows, key, vector, sample, min_size, neighbours)
    joined = rows.select(key, vector).join(F.broadcast(found), key)  # at most ``sample`` rows
    centers = clusters.centroids(joined, "cluster", vector)
    near = clusters.nearest(rows, key, vector, centers)
    reach = near.join(F.broadcast(found), key).where(F.col("cluster") == F.col("cluster_1")).groupBy("cluster_1").agg(F.max("distance_1").alias("limit"))
    out = near.join(F.broadcast(found.withColumn("fitted", F.lit(True))), key, "left").join(F.broadcast(reach), "cluster_1", "left")  # a model's clusters
    far = F.coalesce(F.col("distance_1") > F.col("limit"), F.lit(True))
    return out.select(key, F.coalesce("cluster", F.when(far, NOISE).otherwise(F.col("cluster_1"))).alias("cluster"), F.coalesce("fitted", F.lit(False)).alias("fitted"))


def labels(points: DataFrame, min_size: int = 100, neighbours: int = 5) -> DataFrame:
    """(run, id, cluster) of each run of ``points`` (run, id, v)."""
    edges = spanning.tree(points, neighbours)

    def cut(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["d", "a", "b"])
        ids, at = np.unique(np.concatenate([t["a"], t["b"]]), return_inverse=True)
        found = condense(len(ids), np.column_stack([at[: len(t)], at[len(t) :], t["d"]]), min_size)
        return pd.DataFrame({"run": np.full(len(ids), t["run"].iloc[0]), "id": ids, "cluster": found})

    found = edges.groupBy("run").applyInPandas(cut, "run int, id long, cluster int")
    return points.select("run", "id").join(found, ["run", "id"], "left").select("run", "id", F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))


def _picked(rows: DataFrame, key: str, vector: str, sample: int) -> DataFrame:
    """(key, id, v) of at most ``sample`` rows, those with the smallest hashes of their key; written once, so that ids stay."""
    few = ranges.smallest(rows.select(key, F.col(vector).cast("array<double>").alias("v")), key, sample)
    return kept(few.withColumn("id", F.monotonically_increasing_id()))


def fit(rows: DataFrame, key: str, vector: str, sample: int = 20_000, min_size: int = 100, neighbours: int = 5) -> DataFrame:
    """(key, cluster) of at most ``sample`` rows, those with the smallest hashes of their key."""
    picked = _picked(rows, key, vector, sample)
    found = labels(picked.select(F.lit(0).alias("run"), "id", "v"), min_size, neighbours)
    return kept(picked.select(key, "id").join(found, "id").select(key, "cluster"))


def rand_index(a: np.ndarray, b: np.ndarray) -> float:
    """Adjusted Rand index of two labellings."""
    cells = np.unique(np.stack([a, b]), axis=1, return_counts=True)[1]
    two = lambda n: float((n * (n - 1) / 2).sum())
    of_a, of_b = two(np.unique(a, return_counts=True)[1]), two(np.unique(b, return_counts=True)[1])
    expected, top = of_a * of_b / max(1.0, len(a) * (len(a) - 1) / 2), (of_a + of_b) / 2
    return 1.0 if top == expected else (two(cells) - expected) / (top - expected)


def stability(rows: DataFrame, key: str, vector: str, runs: int = 5, share: float = 0.8, sample: int = 20_000, min_size: int = 100, neighbours: int = 5, seed: int = 7) -> DataFrame:
    """(run, n_clusters, ari_vs_full, noise_share): whether the fit's clusters survive fits to ``share`` of its sample.

    The sample is the one of ``fit``; the fit and all runs, each a draw by its own hashes, are one set of trees.
    """
    picked = _picked(rows, key, vector, sample)
    n = picked.count()
    drawn = picked.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs))))
    luck = F.row_number().over(Window.partitionBy("run").orderBy(F.xxhash64("id", "run", F.lit(seed)), "id"))  # ``sample`` rows at most
    points = kept(drawn.withColumn("_n", luck).where((F.col("run") == 0) | (F.col("_n") <= int(n * share))).select("run", "id", "v"))
    found = kept(labels(points, min_size, neighbours))
    full = found.where("run = 0").select("id", F.col("cluster").alias("full"))
    cells = found.where("run > 0").join(full, "id").groupBy("run", "cluster", "full").agg(F.count("*").alias("n"))
    two = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    of = lambda c: cells.groupBy("run", c).agg(F.sum("n").alias("m")).groupBy("run").agg(two("m").alias(f"in_{c}"))
    whole = cells.groupBy("run").agg(two("n").alias("same"), F.sum("n").alias("all"), F.sum(F.when(F.col("cluster") == NOISE, F.col("n")).otherwise(0)).alias("noise"), F.count_distinct(F.nullif("cluster", F.lit(NOISE))).alias("k"))
    both = whole.join(of("cluster"), "run").join(of("full"), "run")
    expected = F.col("in_cluster") * F.col("in_full") / F.greatest(F.lit(1.0), F.col("all") * (F.col("all") - 1) / 2)
    top = (F.col("in_cluster") + F.col("in_full")) / 2
    ari = F.when(top == expected, 1.0).otherwise((F.col("same") - expected) / F.nullif(top - expected, F.lit(0.0)))
    return both.select((F.col("run") - 1).alias("run"), F.col("k").cast("int").alias("n_clusters"), F.round(ari, 4).alias("ari_vs_full"), F.round(F.col("noise") / F.col("all"), 4).alias("noise_share"))
