"""Looking at raw tables: clocks, durations, missing values, histograms, fingerprints, reconciliation, alignment of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import NOISE
from . import quantiles
from .events import seconds

UNITS = {"s": 1_000_000, "ms": 1000, "us": 1}


def epoch_unit(rows: DataFrame, value: str, reference: str) -> DataFrame:
    """(unit, valid, median_days): how far ``value``, read as each unit of an epoch, lies from ``reference``; the nearest first."""
    number = F.col(value).try_cast("decimal(38,6)")
    us = lambda k: (number * k).try_cast("long")
    near = [F.struct(F.lit(u).alias("unit"), (F.abs(us(k) - F.unix_micros(F.col(reference).cast("timestamp"))) / F.lit(86_400_000_000.0)).alias("days")) for u, k in UNITS.items()]
    each = rows.select(F.inline(F.array(*near)))
    out = quantiles.beside(each.groupBy("unit").agg(F.count("days").alias("valid")), each, ["unit"], {"_q": ("days", (0.5,))})
    return out.select("unit", "valid", F.round(F.col("_q")[0], 6).alias("median_days")).orderBy("median_days", "unit")


def primary_clock(rows: DataFrame, clocks: list[str]) -> DataFrame:
    """(clock, valid, distinct): the one with most valid values, then most distinct ones, first."""
    counts = rows.agg(*(f(F.col(c)).alias(f"{n}_{i}") for i, c in enumerate(clocks) for n, f in (("v", F.count), ("d", F.count_distinct))))
    listed = counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("clock"), F.col(f"v_{i}").alias("valid"), F.col(f"d_{i}").alias("distinct")) for i, c in enumerate(clocks)))))
    return listed.orderBy(F.col("valid").desc(), F.col("distinct").desc(), "clock")


def duration_flags(rows: DataFrame, value: str, q: float = 0.99) -> DataFrame:
    """``rows`` with is_missing, is_zero, is_negative, log1p of positive values, and is_outlier: above quantile ``q`` of the positive ones."""
    x = F.col(value).cast("double")
    top = quantiles.one(rows.where(x > 0), [], x, q, "_top")
    out = rows.join(F.broadcast(top), how="left").withColumns({"is_missing": x.isNull(), "is_zero": F.coalesce(x == 0, F.lit(False)), "is_negative": F.coalesce(x < 0, F.lit(False)), "log_value": F.when(x > 0, F.log1p(x)), "is_outlier": F.coalesce(x > F.col("_top"), F.lit(False))})
    return out.drop("_top")  # one row


def missing_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing, blank, distinct) from one pass."""
    text = lambda c: F.col(c).cast("string")
    one = rows.agg(*(x.alias(f"{n}_{i}") for i, c in enumerate(columns) for n, x in (("m", F.count_if(F.col(c).isNull())), ("b", F.count_if(F.trim(text(c)) == "")), ("d", F.count_distinct(F.col(c))))))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("missing"), F.col(f"b_{i}").alias("blank"), F.col(f"d_{i}").alias("distinct")) for i, c in enumerate(columns)))))


def histogram(rows: DataFrame, by: list[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts by equal bins; values outside go to bins 0 and ``bins`` + 1, as in SQL's width_bucket."""
    return rows.where(F.col(value).isNotNull()).groupBy(*by, F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def vocabulary_signals(rows: DataFrame, name: str) -> DataFrame:
    """One row: names, those seen once, shares of names with a url, a UUID, a long number, a query."""
    names = rows.groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n"))
    share = lambda p: F.round(F.avg(F.col("name").rlike(p).cast("int")), 6)
    return names.agg(
        F.count("*").alias("names"), F.count_if(F.col("n") == 1).alias("once"), share("://").alias("with_url"), share("(?i)[0-9a-f]{8}-[0-9a-f]{4}-").alias("with_uuid"), share(r"[0-9]{3,}").alias("with_number"), share(r"\?").alias("with_query")
    )


def representatives(sessions: DataFrame, key: str, length: str, repeats: str) -> DataFrame:
    """(reason, key): the shortest, the nearest to the median, the longest session and the one with most repeats; ties by key."""
    middle = quantiles.one(sessions, [], length, 0.5, "_m")
    rows = sessions.join(F.broadcast(middle))  # one row
    by = {"shortest": F.struct(F.col(length), key), "median": F.struct(F.abs(F.col(length) - F.col("_m")), key), "longest": F.struct(-F.col(length), key), "most_repeats": F.struct(-F.col(repeats), key)}
    one = rows.agg(*(F.min_by(key, o).alias(n) for n, o in by.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("reason"), F.col(n).alias("key")) for n in by))))


def readable(ids: Column, names: Column, most: int = 20) -> Column:
    """A sequence of token ids (from 1) as names, cut after ``most``."""
    text = F.array_join(F.transform(F.slice(ids, 1, most), lambda i: F.coalesce(F.get(names, i - 1), F.lit("?"))), " -> ")
    return F.when(F.size(ids) > most, F.concat(text, F.lit(" ..."))).otherwise(text)


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row (rows, checksum) that doesn't depend on order or layout."""
    return rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.lit(0)).alias("checksum"))


def reconcile(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: keys of each side, those that only one has, keys that occur more than once."""
    a, b = before.groupBy(key).agg(F.count("*").alias("a")), after.groupBy(key).agg(F.count("*").alias("b"))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count("a").alias("before"), F.count("b").alias("after"), F.count_if(F.col("b").isNull()).alias("lost"), F.count_if(F.col("a").isNull()).alias("gained"), F.count_if((F.col("a") > 1) | (F.col("b") > 1)).alias("repeated"))


def align_runs(strict: DataFrame, lenient: DataFrame, key: str, cluster: str, sequence: str) -> DataFrame:
    """(key, sequence, c_cluster, b_cluster); ValueError unless both runs hold the same keys once, with equal sequences."""
    both = strict.select(key, F.col(sequence).alias("sequence"), F.col(cluster).alias("c_cluster")).join(lenient.select(key, F.col(sequence).alias("_s"), F.col(cluster).alias("b_cluster")), key, "full_outer")
    bad = both.agg(F.count_if(F.col("c_cluster").isNull() | F.col("b_cluster").isNull()).alias("alone"), F.count_if(F.col("sequence") != F.col("_s")).alias("changed"), (F.count("*") - F.count_distinct(key)).alias("repeated")).first()
    if any(bad):
        raise ValueError(f"runs don't match: {bad.asDict()}")
    return both.drop("_s")


def sequence_support(rows: DataFrame, cluster: str, sequence: str) -> DataFrame:
    """``rows`` with noise_support: how many noise rows have the same sequence; 0 for others."""
    counts = rows.where(F.col(cluster) == NOISE).groupBy(sequence).agg(F.count("*").alias("_n"))
    return rows.join(counts, sequence, "left").withColumn("noise_support", F.when(F.col(cluster) == NOISE, F.coalesce("_n", F.lit(0))).otherwise(0)).drop("_n")


def search(rows: DataFrame, columns: list[str], words: str, order: list[Column]) -> DataFrame:
    """Rows whose columns together contain ``words``, whatever the case, in order."""
    return rows.where(F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(words.lower()))).orderBy(*order)


def capped_sample(rows: DataFrame, group: str, key: str, cap: int, seed: int = 0) -> DataFrame:
    """At most ``cap`` rows of each group, those of the smallest hashes; noise left out."""
    w = Window.partitionBy(group).orderBy(F.xxhash64(key, F.lit(seed)), key)
    return rows.where(F.col(group) != NOISE).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).drop("_n")


def nest(evidence: DataFrame, by: list[str]) -> DataFrame:
    """One row a group with its evidence as an array of structs in order of rank; ``F.inline`` turns it back."""
    return evidence.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", *(c for c in evidence.columns if c not in (*by, "rank"))))).alias("evidence"))


def unnest(nested: DataFrame, by: list[str]) -> DataFrame:
    return nested.select(*by, F.inline("evidence"))


def final_names(clusters: DataFrame, human: DataFrame, rule: DataFrame, fallback: DataFrame) -> DataFrame:
    """(cluster, name, source): the reviewed name, else the rule's, else that of the n-grams, else a default."""
    out, names = clusters.select("cluster").distinct(), []
    for n, t in (("human", human), ("rule", rule), ("ngram", fallback)):
        out = out.join(t.select("cluster", F.nullif(F.trim("name"), F.lit("")).alias(n)), "cluster", "left")
        names.append(n)
    source = F.lit("default")
    for n in names[::-1]:
        source = F.when(F.col(n).isNotNull(), n).otherwise(source)
    return out.select("cluster", F.coalesce(*names, F.lit("unclassified")).alias("name"), source.alias("source"))


def sequence_metrics(rows: DataFrame, session: str, order: list[str], token: str, kind: str) -> DataFrame:
    """Per session: events, views, actions, runs, repeats and their share of events, by windows."""
    w = Window.partitionBy(session).orderBy(*order)
    again = F.coalesce(F.lag(token).over(w) == F.col(token), F.lit(False))
    out = rows.withColumn("_again", again).groupBy(session).agg(F.count("*").alias("events"), F.count_if(F.col(kind) == "view").alias("views"), F.count_if(F.col(kind) != "view").alias("actions"), F.count_if(~F.col("_again")).alias("compressed"), F.count_if("_again").alias("repeats"))
    return out.withColumn("repeat_share", F.round(F.col("repeats") / F.col("events"), 6))


def session_summary(rows: DataFrame, session: str, order: list[str], time: str, distinct: list[str]) -> DataFrame:
    """Per session: size, span, largest pause, distinct non-null values."""
    t = F.col(time).cast("timestamp")
    gaps = rows.withColumn("_gap", seconds(t, F.lag(t).over(Window.partitionBy(session).orderBy(*order))))
    return gaps.groupBy(session).agg(F.count("*").alias("events"), F.round(seconds(F.max(t), F.min(t)), 3).alias("span_s"), F.round(F.max("_gap"), 3).alias("max_gap_s"), *(F.count_distinct(c).alias(f"n_{c}") for c in distinct))


def secondary_catalog(rows: DataFrame, catalog: DataFrame, flag: str) -> DataFrame:
    """Per lenient cluster (b_cluster): rows, rows with ``flag``, strict clusters met; with the columns of ``catalog``."""
    out = rows.where(F.col("b_cluster") != NOISE).groupBy("b_cluster").agg(F.count("*").alias("rows"), F.count_if(F.col(flag)).alias("flagged"), F.count_distinct(F.when(F.col("c_cluster") != NOISE, F.col("c_cluster"))).alias("c_clusters"))
    return out.join(catalog, "b_cluster", "left")


def choices(taxonomy: DataFrame, levels: list[str]) -> DataFrame:
    """Distinct paths of a taxonomy with their order: that of their first id."""
    return taxonomy.groupBy(*levels).agg(F.min("taxonomy_id").alias("first_id"), F.count("*").alias("leaves")).withColumn("position", F.row_number().over(Window.orderBy("first_id", *levels)))  # a taxonomy's size


def assignment_status(assigned: DataFrame, taxonomy: DataFrame, levels: list[str]) -> DataFrame:
    """``assigned`` with status: how deep its path is known: ``valid``, else ``unknown_`` and the first level that is not."""
    out, status = assigned, F.lit("valid")
    for n in range(len(levels), 0, -1):
        known = taxonomy.select(*levels[:n]).distinct().withColumn(f"_k{n}", F.lit(True))
        out = out.join(known, levels[:n], "left")
        status = F.when(F.col(f"_k{n}").isNull(), f"unknown_{levels[n - 1]}").otherwise(status)
    return out.withColumn("status", status).drop(*(f"_k{n}" for n in range(1, len(levels) + 1)))


def crosstab(rows: DataFrame, new: str, old: str) -> DataFrame:
    """(new, old, n, share of new)."""
    n = rows.groupBy(new, old).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(new)), 6))
