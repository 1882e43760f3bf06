"""Drift of scored journeys from day to day, out of sketches that can be united over any days.

A day is one row: how many journeys, how many without a cluster, a HyperLogLog sketch of its tokens, a KLL sketch of its
distances, and its journeys by cluster. Days are added to a baseline by uniting rows, so no day is read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import NOISE

#: Bits of the HLL's index (relative error 1.04 / sqrt(2^bits)), and the KLL's k (rank error about 1.33 % at 200).
HLL_BITS, KLL_K = 14, 400
#: A signal is an alarm above its limit.
LIMITS = {"unassigned_rate": 0.10, "new_token_rate": 0.05, "median_distance_change": 0.20, "psi": 0.20}


def sketches(rows: DataFrame, day: str, sequence: str, distance: str, cluster: str) -> DataFrame:
    """(day, n, unassigned, tokens, distances, shares): one row a day of scored ``rows``; shares is an array of (cluster, n).

    Null distances are left out; a row without a cluster or in noise is unassigned. Counts by cluster are summed first,
    so the arrays are as long as a model has clusters.
    """
    token = rows.select(day, F.explode(F.array_distinct(sequence)).alias("token")).groupBy(day).agg(F.hll_sketch_agg("token", F.lit(HLL_BITS)).alias("tokens"))
    own = F.coalesce(F.col(cluster), F.lit(NOISE))
    by = rows.groupBy(day, own.alias("cluster")).agg(F.count("*").alias("n"))
    by = by.groupBy(day).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("cluster") == NOISE, F.col("n")).otherwise(0)).alias("unassigned"), F.array_sort(F.collect_list(F.struct("cluster", "n"))).alias("shares"))
    far = rows.where(F.col(distance).isNotNull()).groupBy(day).agg(F.kll_sketch_agg_double(F.col(distance).cast("double"), F.lit(KLL_K)).alias("distances"))
    return by.join(token, day, "left").join(far, day, "left").select(F.col(day).alias("day"), "n", "unassigned", "tokens", "distances", "shares")


def united(days: DataFrame) -> DataFrame:
    """The ``days`` as one row of the same shape, without a day."""
    shares = days.select(F.inline("shares")).groupBy("cluster").agg(F.sum("n").alias("n")).agg(F.array_sort(F.collect_list(F.struct("cluster", "n"))).alias("shares"))
    rest = days.agg(F.sum("n").alias("n"), F.sum("unassigned").alias("unassigned"), F.hll_union_agg("tokens").alias("tokens"), F.kll_merge_agg_double("distances").alias("distances"))
    return rest.join(F.broadcast(shares))  # one row each


def signals(baseline: DataFrame, days: DataFrame) -> DataFrame:
    """(day, signal, value, limit, alarm) for each of ``days`` against ``baseline`` (one row, as ``united`` gives it).

    unassigned_rate; new_token_rate: share of the day's distinct tokens that the baseline lacks; median_distance_change:
    relative to the baseline's median; psi: population stability of the clusters' shares, each at least 1e-6.
    """
    old = baseline.select(F.col("n").alias("b_n"), F.col("tokens").alias("b_tokens"), F.col("distances").alias("b_distances"), F.col("shares").alias("b_shares"))
    both = days.join(F.broadcast(old))  # one row
    distinct = lambda c: F.hll_sketch_estimate(c)
    fresh = F.greatest(F.lit(0), distinct(F.hll_union("tokens", "b_tokens")) - distinct(F.col("b_tokens"))) / F.greatest(F.lit(1), distinct(F.col("tokens")))
    median = lambda c: F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(0.5)))
    kinds = F.array_union(F.transform("shares", lambda x: x["cluster"]), F.transform("b_shares", lambda x: x["cluster"]))
    share = lambda table, n, c: F.greatest(F.lit(1e-6), F.coalesce(F.try_element_at(F.map_from_entries(table), c), F.lit(0)) / F.col(n))
    part = lambda c: (share("shares", "n", c) - share("b_shares", "b_n", c)) * F.ln(share("shares", "n", c) / share("b_shares", "b_n", c))
    values = {
        "unassigned_rate": F.col("unassigned") / F.col("n"), "new_token_rate": fresh, "median_distance_change": median("distances") / F.nullif(median("b_distances"), F.lit(0.0)) - 1,
        "psi": F.aggregate(kinds, F.lit(0.0), lambda s, c: s + part(c)),
    }
    listed = F.array(*(F.struct(F.lit(k).alias("signal"), v.cast("double").alias("value"), F.lit(LIMITS[k]).alias("limit")) for k, v in values.items()))
    return both.select("day", F.inline(listed)).withColumn("alarm", F.coalesce(F.col("value") > F.col("limit"), F.lit(False)))
