"""Helpers that the corpus operators share: tables, lineage cuts, distributed ranks, components."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, the separators of words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts: ``spark.checkpoint.dir``, or a temporary one where a local session sets none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("SPARK_LOCAL_DIRS", "/tmp"))
        sc.setCheckpointDir(named)
        named = sc.getCheckpointDir()
    return named


def cut(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again, so that later jobs don't recompute it.

    With ``by`` it is written in one folder for each value of that column.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, key: str, order: list, name: str, rows: int, per_task: int = 1_000_000) -> DataFrame:
    """``df`` with ``name``: a gapless number from 0 within each value of ``key``.

    A key may hold any share of the rows: it is dealt over hash buckets, as many as shuffle partitions and at least
    ``rows / per_task``, rows are numbered within (key, bucket), and the running total of the bucket counts is added. Rows that are equal in ``order`` are equal in
    all that is returned, so a recomputed task gives the same rows.
    """
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    within = Window.partitionBy(key, "_bucket").orderBy(*order)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(key, "_bucket").count()
        .select(key, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    return (
        dealt.withColumn("_row", F.row_number().over(within) - 1)
        .join(starts, [key, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_bucket", "_row", "_start")
    )


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of ``edges`` (a, b: longs): one row (node, root) for each node, root the smallest of its component.

    Alternates large-star and small-star steps until the edges no longer change. Each step groups and joins on a node;
    minima are pre-aggregated and skewed joins are split by adaptive execution, so a hub needs no task of its own.
    """

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())

    def star(e: DataFrame, both: bool) -> DataFrame:
        if both:
            e = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = e.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
        near = e.join(low, "a")
        if both:
            out = near.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = near.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was = mark(now)
    for _ in range(rounds):
        now = cut(star(star(now, True), False))
        if (is_ := mark(now)) == was:
            break
        was = is_
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
