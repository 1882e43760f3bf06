"""Transition tables: counts by cluster and over all, smoothed scores, likely next tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import GLOBAL
from ..store import kept
from .vocabulary import sized


def pairs(rows: DataFrame, keep: list[str], sequence: str) -> DataFrame:
    """One row for each adjacent pair of a sequence: (keep, src, dst)."""
    s = F.col(sequence)
    two = F.when(F.size(s) > 1, F.transform(F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.struct(F.element_at(s, i).alias("src"), F.element_at(s, i + 1).alias("dst"))))
    return rows.select(*keep, F.inline(two))


def fit(rows: DataFrame, cluster: str, sequence: str) -> DataFrame:
    """(cluster, src, dst, n): counts in each cluster, and over all under the id ``GLOBAL``."""
    counts = pairs(rows, [cluster], sequence).groupBy(cluster, "src", "dst").agg(F.count("*").alias("n"))
    every = counts.groupBy("src", "dst").agg(F.sum("n").alias("n")).select(F.lit(GLOBAL).alias("cluster"), "src", "dst", "n")
    return counts.withColumnRenamed(cluster, "cluster").unionByName(every)


def vocabulary_size(edges: DataFrame) -> int:
    tokens = edges.where(F.col("cluster") == GLOBAL).select(F.explode(F.array("src", "dst")).alias("t"))
    return tokens.agg(F.count_distinct("t")).first()[0]


def score(rows: DataFrame, key: str, cluster: str, sequence: str, edges: DataFrame, smoothing: float = 0.1) -> DataFrame:
    """(key, markov_logprob): mean smoothed log probability of the transitions under the row's cluster; null without known pairs.

    ln((count + s) / (total of src + s * vocabulary)); pairs with a token that training never saw are skipped; a cluster
    without transitions is scored under the table of all.

    Each distinct transition is looked up once; the rows' own pairs then take one join, with a broadcast where the
    transitions are few.
    """
    v = vocabulary_size(edges)
    known = edges.where(F.col("cluster") == GLOBAL).select(F.explode(F.array("src", "dst")).alias("t")).distinct()
    have = edges.select("cluster").distinct().withColumn("_own", F.lit(True))
    totals = edges.groupBy("cluster", "src").agg(F.sum("n").alias("total"))
    each = pairs(rows.select(key, F.coalesce(F.col(cluster), F.lit(GLOBAL)).alias("_c"), sequence), [key, "_c"], sequence)
    seen = each.select("_c", "src", "dst").distinct()
    seen = seen.join(known.withColumnRenamed("t", "src"), "src").join(known.withColumnRenamed("t", "dst"), "dst")
    seen = seen.join(have, F.col("_c") == F.col("cluster"), "left").withColumn("cluster", F.when(F.col("_own"), F.col("_c")).otherwise(GLOBAL))
    seen = seen.join(edges, ["cluster", "src", "dst"], "left").join(totals, ["cluster", "src"], "left")
    log = F.ln((F.coalesce("n", F.lit(0)) + smoothing) / (F.coalesce("total", F.lit(0)) + smoothing * v))
    values = kept(seen.select("_c", "src", "dst", log.alias("log")))
    got = each.join(sized(values), ["_c", "src", "dst"]).groupBy(key).agg(F.avg("log").alias("markov_logprob"))
    return rows.select(key).join(got, key, "left")


def next_tokens(edges: DataFrame, k: int = 3, smoothing: float = 0.1, vocabulary: int | None = None) -> DataFrame:
    """The ``k`` likeliest tokens after each token of each cluster: (cluster, src, rank, dst, probability, share)."""
    v = vocabulary or vocabulary_size(edges)
    total = F.sum("n").over(Window.partitionBy("cluster", "src"))
    out = edges.withColumn("total", total).withColumn("rank", F.row_number().over(Window.partitionBy("cluster", "src").orderBy(F.col("n").desc(), "dst"))).where(F.col("rank") <= k)
    return out.select("cluster", "src", "rank", "dst", ((F.col("n") + smoothing) / (F.col("total") + smoothing * v)).alias("probability"), (F.col("n") / F.col("total")).alias("share"))
