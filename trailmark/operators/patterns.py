"""Frequent subsequences: mining, closing, ranking, and which of them a journey contains."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mine(rows: DataFrame, sequence: str, support: float = 0.01, least: int = 2, longest: int = 5) -> DataFrame:
    """(tokens, length, support_count, support): subsequences in ``support`` of the rows and ``least`` rows at least.

    A row counts once however often it holds a pattern; gaps are allowed.
    """
    from pyspark.ml.fpm import PrefixSpan

    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "tokens array<string>, length int, support_count long, support double")
    need = max(least, round(support * n), 1)
    sets = rows.select(F.transform(sequence, lambda t: F.array(t)).alias("sequence"))
    found = PrefixSpan(minSupport=(need - 0.5) / n, maxPatternLength=longest).findFrequentSequentialPatterns(sets)
    return found.select(F.flatten("sequence").alias("tokens"), F.size("sequence").alias("length"), F.col("freq").alias("support_count"), F.round(F.col("freq") / n, 4).alias("support"))


def contains(sequence: Column, pattern: Column) -> Column:
    """Whether ``pattern`` is a subsequence of ``sequence``: a fold that counts the pattern's tokens found in order."""
    found = F.aggregate(sequence, F.lit(0), lambda at, t: F.when((at < F.size(pattern)) & (F.get(pattern, at) == t), at + 1).otherwise(at))
    return found == F.size(pattern)


def _tree(patterns: list[list[str]]) -> tuple[list[str], dict]:
    """Tokens, and the patterns as a tree of prefixes: by place of the next token, and under None the numbers of those that end there."""
    tokens = sorted({t for p in patterns for t in p if t is not None})
    place, root = {t: i for i, t in enumerate(tokens)}, {}
    for number, p in enumerate(patterns):
        if None in p:
            continue  # equal to nothing
        node = root
        for t in p:
            node = node.setdefault(place[t], {})
        node.setdefault(None, []).append(number)
    return tokens, root


def _walk(sequences: pa.Array, tokens: list[str], root: dict) -> pa.ListArray:
    """The numbers of the patterns that each sequence contains, ascending: a prefix is looked for once in all rows that contain what is before it."""
    sizes = pc.fill_null(pc.list_value_length(sequences), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    code = pc.index_in(sequences.flatten().cast(pa.string()), value_set=pa.array(tokens, pa.string()), skip_nulls=True).fill_null(-1).to_numpy(zero_copy_only=False)
    places = [np.flatnonzero(code == i) for i in range(len(tokens))]
    given = np.flatnonzero(sequences.is_valid().to_numpy(zero_copy_only=False))
    rows, numbers, todo = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [(root, given, (ends - sizes)[given])]
    while todo:
        node, own, at = todo.pop()
        for token, below in node.items():
            if token is None:
                rows += [own] * len(below)
                numbers += [np.full(len(own), n, dtype=np.int64) for n in below]
                continue
            found = np.searchsorted(places[token], at)
            where = np.append(places[token], len(code))[found]  # the first place from there on
            inside = where < ends[own]
            if inside.any():
                todo.append((below, own[inside], where[inside] + 1))
    row, number = np.concatenate(rows), np.concatenate(numbers)
    order = np.lexsort((number, row))
    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(sizes)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(number[order].astype(np.int32)))


def held(rows: DataFrame, sequence: str, patterns: list[list[str]]) -> DataFrame:
    """``rows`` with ``terms`` in place of ``sequence``: the numbers of the patterns that it contains, as of ``contains``, ascending.

    The patterns are a model's; rows stay where they are.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_tree(patterns))
    others = [c for c in rows.columns if c != sequence]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in others), _walk(b.column(sequence), *shared.value)], [*others, "terms"])

    schema = rows.select(*others).withColumn("terms", F.lit(None).cast("array<int>")).schema
    return rows.mapInArrow(walk, schema)


def close(patterns: DataFrame) -> DataFrame:
    """Patterns without a longer one of the same support that contains them.

    If there is one, there is one that is longer by a single token, as support never grows with length and all frequent
    patterns are given. So each pattern rules out those that it becomes without one of its tokens.
    """
    t = F.col("tokens")
    shorter = F.transform(F.sequence(F.lit(1), F.size(t)), lambda i: F.concat(F.slice(t, 1, i - 1), F.slice(t, i + 1, F.size(t))))
    covered = patterns.where(F.size(t) > 1).select(F.explode(F.array_distinct(shorter)).alias("tokens"), "support_count").distinct()
    return patterns.join(covered, ["tokens", "support_count"], "left_anti")


def rank(patterns: DataFrame, most: int = 200, shortest: int = 2) -> DataFrame:
    """At most ``most`` patterns with ids, a like number of each length: those of largest support, ties by tokens."""
    rows = patterns.where(F.col("length") >= shortest)
    lengths = rows.select("length").distinct().count()
    quota = -(-most // max(1, lengths))
    by = F.array_join("tokens", " -> ")
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("length").orderBy(F.col("support_count").desc(), by))).where(F.col("_n") <= quota)
    no = F.row_number().over(Window.orderBy(F.col("support_count").desc(), F.col("length").desc(), by))  # bounded by ``most``
    return rows.withColumn("pattern_id", F.format_string("P%04d", no)).drop("_n").where(F.substring("pattern_id", 2, 9).cast("int") <= most)


def candidates(rows: DataFrame, key: str, sequence: str, patterns: DataFrame, most: int = 5000) -> DataFrame:
    """Each row's number of contained patterns, and the longest of them, then the rarest, then the first id.

    ``patterns`` (pattern_id, tokens, length, support_count) comes out of ``rank`` and is bounded; its size is checked.
    """
    listed = patterns.select("tokens", "pattern_id").orderBy(F.col("length").desc(), "support_count", "pattern_id").limit(most + 1).collect()
    if len(listed) > most:
        raise ValueError(f"more than {most} patterns")
    ids = F.lit([r["pattern_id"] for r in listed]) if listed else F.array().cast("array<string>")
    hits = held(rows.select(key, sequence), sequence, [r["tokens"] for r in listed])
    return hits.select(key, F.size("terms").alias("matched"), F.get(ids, F.get("terms", 0)).alias("candidate"))
