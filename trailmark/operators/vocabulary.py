"""Tokens, their dictionary, rare-token folding, n-grams and their lift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import BOS, EOS, RARE
from . import ranges


def token_dictionary(events: DataFrame, token: str, session: list[str], time: str, first: list[str] | None = None, mean: dict[str, str] | None = None) -> DataFrame:
    """Each token's events, sessions, first and last time, and its rank by events (ties by token).

    ``first``: columns whose values are taken from the token's first event (ties by the values themselves); ``mean``: means
    by name of a column, to three digits.
    """
    seen = [F.min_by(F.struct(*first), F.struct(time, *first)).alias("_first")] if first else []
    means = [F.round(F.avg(c), 3).alias(n) for n, c in (mean or {}).items()]
    d = events.groupBy(token).agg(F.count("*").alias("events"), F.count_distinct(*session).alias("sessions"), F.min(time).alias("first_time"), F.max(time).alias("last_time"), *seen, *means)
    d = d.select("*", "_first.*").drop("_first") if first else d
    return ranges.number(d, [F.col("events").desc(), F.col(token)], "token_id")


def vocabulary_report(events: DataFrame, channels: list[str], top: int = 100) -> DataFrame:
    """Per channel: distinct tokens, those seen once, and the share of events that the ``top`` most frequent cover."""
    stacked = events.select(F.inline(F.array(*(F.struct(F.lit(c).alias("channel"), F.col(c).alias("token")) for c in channels))))
    counts = stacked.groupBy("channel", "token").agg(F.count("*").alias("n"))
    ranked = ranges.number(counts, [F.col("n").desc(), F.col("token")], "r", ["channel"])
    return ranked.groupBy("channel").agg(
        F.count("*").alias("vocabulary"), F.count_if(F.col("n") == 1).alias("singletons"), F.round(F.sum(F.when(F.col("r") <= top, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("top_coverage")
    )


#: Rows of a table that is broadcast at most; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


def sized(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for a broadcast if it has at most ``most`` rows; it is counted for that, up to there."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def map_tokens(rows: DataFrame, key: str, sequence: str, known: DataFrame) -> DataFrame:
    """(key, _map): for each row the values of its distinct tokens, from ``known`` (token, value); a token without a value is left out.

    Tokens are joined once a row, however often they occur in it.
    """
    each = rows.select(key, F.explode_outer(F.array_distinct(sequence)).alias("token")).join(sized(known), "token", "left")
    pairs = F.collect_list(F.when(F.col("value").isNotNull(), F.struct("token", "value")))
    return each.groupBy(key).agg(F.map_from_entries(pairs).alias("_map"))


def add_token_ids(rows: DataFrame, token: str, dictionary: DataFrame) -> DataFrame:
    """``rows`` with the token_id of ``dictionary`` (token, token_id; each token once), null for a token that it lacks."""
    return rows.join(sized(dictionary.select(F.col("token").alias(token), "token_id")), token, "left")


def document_frequency(rows: DataFrame, sequence: str) -> DataFrame:
    return rows.select(F.explode(F.array_distinct(sequence)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def fold_rare(rows: DataFrame, key: str, sequence: str, coarse: str, least: int = 3) -> DataFrame:
    """(key, folded, n_backed_off, n_rare): tokens in fewer than ``least`` rows become their coarse form, or ``<rare>`` if that is rare too.

    Only frequent tokens are looked up, each once a row and kind, so the vocabulary may be of any size.
    """
    often = lambda c, name: document_frequency(rows, c).where(F.col("df") >= least).select("token", F.lit(name).alias("kind"))
    known = often(sequence, "t").union(often(coarse, "c"))
    both = F.concat(F.transform(F.array_distinct(sequence), lambda t: F.struct(t.alias("token"), F.lit("t").alias("kind"))), F.transform(F.array_distinct(coarse), lambda c: F.struct(c.alias("token"), F.lit("c").alias("kind"))))
    each = rows.select(key, F.inline_outer(both)).join(sized(known).withColumn("known", F.lit(True)), ["token", "kind"], "left")
    held = lambda kind: F.collect_list(F.when((F.col("kind") == kind) & F.col("known"), F.col("token")))
    found = rows.select(key, sequence, coarse).join(each.groupBy(key).agg(held("t").alias("_t"), held("c").alias("_c")), key)
    fold = F.zip_with(sequence, coarse, lambda t, c: F.struct(
        F.when(F.array_contains("_t", t), t).when(F.array_contains("_c", c), c).otherwise(RARE).alias("token"),
        F.when(F.array_contains("_t", t), 0).when(F.array_contains("_c", c), 1).otherwise(2).alias("how"),
    ))
    count = lambda how: F.size(F.filter("_f", lambda x: x["how"] == how)).cast("long")
    return found.select(key, fold.alias("_f")).select(key, F.col("_f.token").alias("folded"), count(1).alias("n_backed_off"), count(2).alias("n_rare"))


def ngrams(sequence: Column, low: int = 1, high: int = 2, ends: bool = True) -> Column:
    """All n-grams of a sequence, joined by spaces; with ``ends`` between start and end marks."""
    s = F.concat(F.array(F.lit(BOS)), sequence, F.array(F.lit(EOS))) if ends else sequence
    of = lambda n: F.when(F.size(s) >= n, F.transform(F.sequence(F.lit(1), F.size(s) - n + 1), lambda i: F.array_join(F.slice(s, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return F.concat(*(of(n) for n in range(low, high + 1)))


def ngram_counts(rows: DataFrame, sequence: str, low: int = 1, high: int = 2, ends: bool = True) -> DataFrame:
    """(ngram, df, n): rows that hold it, and how often it occurs."""
    numbered = rows.select(F.monotonically_increasing_id().alias("_r"), sequence)
    grams = numbered.select("_r", F.explode(ngrams(F.col(sequence), low, high, ends)).alias("ngram"))
    return grams.groupBy("_r", "ngram").agg(F.count("*").alias("n")).groupBy("ngram").agg(F.count("*").alias("df"), F.sum("n").alias("n"))


def ngram_lift(rows: DataFrame, group: str, sequence: str, top: int = 8, low: int = 1, high: int = 2, ends: bool = False) -> DataFrame:
    """Each group's n-grams of largest lift: share of the group's n-grams over share of all, each plus 1e-9."""
    counts = rows.select(group, F.explode(ngrams(F.col(sequence), low, high, ends)).alias("ngram")).groupBy(group, "ngram").agg(F.count("*").alias("n"))
    own = counts.groupBy(group).agg(F.sum("n").alias("_own"))
    every = counts.groupBy("ngram").agg(F.sum("n").alias("all"))
    total = every.agg(F.sum("all").alias("total"))
    scored = counts.join(sized(own), group).withColumn("mass", F.col("n") / F.col("_own")).join(every, "ngram").join(F.broadcast(total))  # total: one row
    scored = scored.withColumn("lift", (F.col("mass") + 1e-9) / (F.col("all") / F.col("total") + 1e-9))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.round("lift", 9).desc(), F.col("n").desc(), "ngram")))
    return ranked.where(F.col("rank") <= top).select(group, "rank", "ngram", F.round("lift", 6).alias("lift"), F.round("mass", 9).alias("mass"))
