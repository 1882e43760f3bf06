"""Scoring with a frozen model: journeys to vectors, nearest cluster, transitions, thresholds, flags and the next action.

A model is a handful of tables of bounded size (n-grams, their projection, behaviour scales, centroids, transitions,
thresholds); it is fitted once, saved below one folder and loaded by whoever scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import GLOBAL, NOISE
from ..store import kept
from . import clusters, embedding, markov
from .vocabulary import sized

#: Thresholds of a fit: name -> (column, quantile).
LIMITS = {
    "distance_p95": ("distance", 0.95), "markov_p05": ("markov_logprob", 0.05), "markov_p01": ("markov_logprob", 0.01), "back_p90": ("back_rate", 0.9), "loops_p90": ("n_loop_removed", 0.9),
    "revisit_p90": ("revisit_ratio", 0.9), "span_p95": ("span_seconds", 0.95),
}


@dataclass
class Model:
    terms: DataFrame  # (ngram, term, idf)
    basis: np.ndarray  # terms by dimensions
    numeric: embedding.Numeric
    columns: tuple[str, ...]
    centers: DataFrame  # (cluster, size, centroid)
    edges: DataFrame  # (cluster, src, dst, n)
    limits: dict[str, float]

    def vectors(self, rows: DataFrame, key: str, sequence: str) -> DataFrame:
        """(key, v) for every row: its n-grams' projection at length 1 and the behaviour block; zeros for a row without known n-grams."""
        weights = embedding.Tfidf(self.terms, 1, 2).by_row(rows, key, sequence)
        placed = embedding.project(weights, key, self.basis)
        zero = F.array_repeat(F.lit(0.0), self.basis.shape[1])
        block = F.transform(self.numeric.transform(self.columns), lambda x: x * embedding.NUMERIC_WEIGHT)
        return rows.join(placed, key, "left").select(key, F.concat(embedding.unit(F.coalesce("v", zero)), block).alias("v"))

    def locate(self, rows: DataFrame, key: str, sequence: str, vectors: DataFrame | None = None) -> DataFrame:
        """``rows`` with nearest_cluster, distance and markov_logprob; their ``vectors``, if there are any already, aren't computed again."""
        near = clusters.nearest(self.vectors(rows, key, sequence) if vectors is None else vectors, key, "v", self.centers)
        out = kept(rows.join(near.select(key, F.col("cluster_1").alias("nearest_cluster"), F.col("distance_1").alias("distance")), key))  # read twice
        return out.join(markov.score(out, key, "nearest_cluster", sequence, self.edges), key)

    def score(self, rows: DataFrame, key: str, sequence: str) -> DataFrame:
        """``rows`` with their cluster (noise beyond ``distance_p95``), anomalies, friction flags and next action with its share.

        The next action is the likeliest token after the row's last one in its nearest cluster, else over all rows; null
        if nothing ever followed that token.
        """
        judged = clusters.judge(self.locate(rows, key, sequence), self.limits)
        likely = markov.next_tokens(self.edges, 1).select("cluster", "src", F.struct("dst", "share").alias("next"))
        of = lambda cluster, name: sized(likely.where(cluster).select(F.col("cluster").alias(f"_{name}"), F.col("src").alias(f"_s_{name}"), F.col("next").alias(name)))
        last = F.element_at(sequence, -1)
        own, every = of(F.col("cluster") != GLOBAL, "own"), of(F.col("cluster") == GLOBAL, "every")
        out = judged.withColumn("_last", F.when(F.size(sequence) > 0, last))
        out = out.join(own, (F.col("nearest_cluster") == F.col("_own")) & (F.col("_last") == F.col("_s_own")), "left").join(every, F.col("_last") == F.col("_s_every"), "left")
        found = F.coalesce("own", "every")
        return out.select(*judged.columns, found["dst"].alias("next_action"), found["share"].alias("next_action_share"))

    def save(self, root: str) -> None:
        spark = self.terms.sparkSession
        spark.createDataFrame([(i, b.tolist()) for i, b in enumerate(self.basis)], "term int, b array<double>").write.mode("overwrite").parquet(f"{root}/basis")
        one = [(list(self.columns), self.numeric.means, self.numeric.scales, self.limits)]
        spark.createDataFrame(one, "columns array<string>, means array<double>, scales array<double>, limits map<string,double>").write.mode("overwrite").parquet(f"{root}/settings")
        for name, table in (("terms", self.terms), ("centers", self.centers), ("edges", self.edges)):
            table.write.mode("overwrite").parquet(f"{root}/{name}")


def load(spark: SparkSession, root: str) -> Model:
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    s, basis = read("settings").first(), read("basis").orderBy("term").collect()  # as many rows as the vocabulary is bounded to
    return Model(read("terms"), np.array([r["b"] for r in basis]), embedding.Numeric(list(s["means"]), list(s["scales"])), tuple(s["columns"]), read("centers"), read("edges"), dict(s["limits"]))


def fit(rows: DataFrame, key: str, sequence: str, k: int = 8, dimensions: int = 16, most: int = 20_000, columns: tuple[str, ...] = embedding.NUMERIC, seed: int = 7) -> Model:
    """A model of ``rows``: vectors, k-means clusters, transitions by cluster, and thresholds over the rows themselves."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    tfidf = embedding.fit_tfidf(rows, key, sequence, most=most)
    n = tfidf.terms.count()
    basis = embedding.fit_svd(tfidf.by_row(rows, key, sequence), key, n, dimensions)
    model = Model(tfidf.terms, basis, embedding.fit_numeric(rows, columns), columns, None, None, {})
    v = kept(model.vectors(rows, key, sequence))
    points = v.withColumn("features", array_to_vector("v")).cache()
    placed = kept(KMeans(k=k, seed=seed, maxIter=20).fit(points).transform(points).select(key, "v", F.col("prediction").alias("cluster")))
    points.unpersist()
    model.centers = kept(clusters.centroids(placed, "cluster", "v"))  # both are read several times
    model.edges = kept(markov.fit(rows.select(key, sequence).join(placed.select(key, "cluster"), key), "cluster", sequence))
    located = model.locate(rows, key, sequence, v)
    model.limits = {n: float(x or 0.0) for n, x in clusters.thresholds(located, LIMITS).first().asDict().items()}
    return model


def assigned_share(scored: DataFrame) -> DataFrame:
    """(cluster, rows, share) of scored rows, noise included."""
    every = Window.partitionBy()
    return scored.groupBy("cluster").agg(F.count("*").alias("rows")).select("cluster", "rows", F.round(F.col("rows") / F.sum("rows").over(every), 6).alias("share")).orderBy((F.col("cluster") == NOISE).cast("int"), "cluster")
