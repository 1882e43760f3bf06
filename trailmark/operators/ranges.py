"""Order over a whole table: ranges of rows in order, with counts and neighbours carried across their borders.

A window without keys, or with few, puts a table into few tasks. Here rows are sorted once in ranges and written; what
depends on earlier ranges is a count, or the last row, of each range, of which there are as many as partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import kept

#: Below the partition's number in monotonically_increasing_id.
_BITS = 33


def sorted_ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with _part and _at: the range that a row lies in, and its place in the whole order (not gapless). Written once."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return kept(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


def number(rows: DataFrame, order: list[Column], name: str, by: list[str] | None = None) -> DataFrame:
    """``rows`` with ``name``: gapless from 1 in ``order``, within ``by`` if given. Ties of the whole order are numbered in any order."""
    by = by or []
    placed = sorted_ranges(rows, [*map(F.col, by), *order])
    parts = placed.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_before", before)
    if not by:  # a row a range
        at = placed.join(F.broadcast(parts.select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))), "_part")
        return at.withColumn(name, F.col("_at").bitwiseAND((1 << _BITS) - 1) + F.col("_before") + 1).drop("_part", "_at", "_before")
    # only a key that crosses a border has a second range: fewer rows than there are ranges
    later = F.broadcast(parts.where(F.col("_before").isNotNull()).select(*by, "_part", "_before"))
    own = F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_at"))
    return join_same(placed.withColumn("_own", own), later, [*by, "_part"]).withColumn(name, F.col("_own") + F.coalesce("_before", F.lit(0))).drop("_part", "_at", "_own", "_before")


def lag(rows: DataFrame, order: list[Column], columns: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """``rows`` with, for each (new name: column) of ``columns``, its value in the row before in ``order``, within ``by`` if given."""
    by = by or []
    placed = sorted_ranges(rows, [*map(F.col, by), *order])
    held = F.struct(*map(F.col, by), *(F.col(c).alias(n) for n, c in columns.items()))
    # the last row of each range, handed to the next range that has rows
    lasts = placed.groupBy("_part").agg(F.max_by(held, "_at").alias("_last"))
    handed = lasts.withColumn("_last", F.lag("_last").over(Window.partitionBy(F.lit(0)).orderBy("_part")))
    within = Window.partitionBy("_part").orderBy("_at")
    whole = placed.withColumns({"_i": F.row_number().over(within), "_held": F.lag(held).over(within)}).join(F.broadcast(handed), "_part")
    before = F.when(F.col("_i") == 1, F.col("_last")).otherwise(F.col("_held"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_before.{c}"))
    whole = whole.withColumn("_before", before)
    return whole.withColumns({n: F.when(same, F.col(f"_before.{n}")) for n in columns}).drop("_part", "_at", "_i", "_held", "_last", "_before")


def smallest(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` of ``rows``, those with the smallest hashes of their key.

    Hashes lie evenly, so about a tenth more rows than are wanted lie below an edge that is known beforehand; only these
    are put into order, where else each partition would hand on ``most`` rows.
    """
    n, h = rows.count(), F.xxhash64(key)
    if n <= most:
        return rows
    below = rows.where(h <= -(2**63) + int(2**64 * min(0.999, 1.1 * most / n)))
    return (below if below.count() >= most else rows).orderBy(h, key).limit(most)


def join_same(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """A left join on equal keys, nulls equal too; without keys ``right`` is one row for all."""
    if not on:
        return left.join(F.broadcast(right))
    right = right.select(*(F.col(c).alias(f"_r_{c}") for c in on), *(c for c in right.columns if c not in on))
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(right[f"_r_{c}"])
    return left.join(right, condition, "left").drop(*(f"_r_{c}" for c in on))
