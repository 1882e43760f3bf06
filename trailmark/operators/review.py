"""The store of reviewed names: a model's named clusters, edits of one, what changed and when, and the current version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One row a change: when, what kind, of what, and the values before and after as JSON.
AUDIT = "changed_at timestamp, change string, subject string, old string, new string"


def _audit(spark: SparkSession, when: str, change: str, subject: str, old: DataFrame, new: DataFrame) -> DataFrame:
    """One audit row from one-row tables of what was and what is."""
    as_json = lambda df: df.select(F.to_json(F.struct("*")).alias("j")).scalar()
    row = spark.range(1).select(F.lit(when).cast("timestamp").alias("changed_at"), F.lit(change).alias("change"), F.lit(subject).alias("subject"), as_json(old).alias("old"), as_json(new).alias("new"))
    return row


def platform_counts(named: DataFrame) -> DataFrame:
    """(platform, clusters)."""
    return named.groupBy("platform").agg(F.count("*").alias("clusters"))


def unknown_leaves(named: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Clusters whose taxonomy_id no leaf has."""
    return named.where(F.col("taxonomy_id").isNotNull()).join(taxonomy.select("taxonomy_id"), "taxonomy_id", "left_anti")


def swap_model(current: DataFrame, new: DataFrame, taxonomy: DataFrame, was: str, version: str, when: str) -> tuple[DataFrame, DataFrame]:
    """The named clusters of a new model in place of the ``current`` ones, and the audit row (cluster_refresh).

    The taxonomy stays. ValueError if a new cluster names a leaf that it lacks.
    """
    if lost := [r[0] for r in unknown_leaves(new, taxonomy).select("taxonomy_id").distinct().orderBy("taxonomy_id").limit(10).collect()]:
        raise ValueError(f"clusters of unknown leaves: {lost}")
    spark = new.sparkSession
    of = lambda df, v: df.agg(F.lit(v).alias("model_version"), F.count("*").alias("clusters"), F.array_sort(F.collect_set("platform")).alias("platforms"))
    return new, _audit(spark, when, "cluster_refresh", version, of(current, was), of(new, version))


def edit_assignment(named: DataFrame, platform: str, cluster: int, taxonomy_id: str, taxonomy: DataFrame, when: str) -> tuple[DataFrame, DataFrame]:
    """``named`` (platform, cluster, taxonomy_id, ...) with one cluster given to another leaf, and the audit rows: none for an edit that changes nothing.

    ValueError for an unknown cluster or leaf.
    """
    here = (F.col("platform") == platform) & (F.col("cluster") == cluster)
    if named.where(here).isEmpty():
        raise ValueError(f"no cluster {cluster} of {platform}")
    if taxonomy.where(F.col("taxonomy_id") == taxonomy_id).isEmpty():
        raise ValueError(f"no leaf {taxonomy_id}")
    after = named.withColumn("taxonomy_id", F.when(here, taxonomy_id).otherwise(F.col("taxonomy_id")))
    one = lambda df: df.where(here).select("taxonomy_id").limit(1)
    audit = _audit(named.sparkSession, when, "assignment", f"{platform}:{cluster}", one(named), one(after))
    return after, audit.where(~F.col("old").eqNullSafe(F.col("new")))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` with the rows of ``changes`` put in, or put in place of those of equal ``keys``; columns by name."""
    return current.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def delete_stale(current: DataFrame, live: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``current`` whose ``keys`` are still ``live``."""
    return current.join(live.select(*keys).distinct(), keys, "left_semi")


def publish(rows: DataFrame, root: str, version: str) -> None:
    """Write a version beside the others, then point to it; readers see the old one or the new one, whole."""
    rows.write.mode("overwrite").parquet(f"{root}/version={version}")
    rows.sparkSession.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{root}/_current")


def current(spark: SparkSession, root: str) -> tuple[str, DataFrame]:
    """The version that is pointed to, and its rows."""
    version = spark.read.schema("version string").json(f"{root}/_current").first()["version"]
    return version, spark.read.parquet(f"{root}/version={version}")


def recent(audit: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` changes, newest first."""
    return audit.orderBy(F.col("changed_at").desc(), "change", "subject").limit(n)
