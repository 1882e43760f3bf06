"""Sinks: partitioned event stores, daily summaries, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import NOISE
from ..functions import names as N


def event_store(rows: DataFrame, path: str, buckets: int = 64, rows_per_file: int = 20_000_000) -> None:
    """Raw events by platform and session bucket; an output that exists is an error.

    One shuffle puts a bucket's sessions together, in as many files as its rows need; a session is in one of them. Rows
    are counted by bucket first (platforms times ``buckets`` numbers), so no task writes more than its share at any size.
    """
    keyed = rows.withColumn("platform", N.platform(F.col("platform"))).withColumn("bucket", N.session_bucket(F.col("platform"), F.col("session_id").cast("string"), buckets))
    name = F.concat_ws("/", F.coalesce("platform", F.lit("")), "bucket")
    files = {r["k"]: -(-r["n"] // rows_per_file) for r in keyed.groupBy(name.alias("k")).agg(F.count("*").alias("n")).collect()}
    many = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in files.items() for x in kv)), name), F.lit(1)) if files else F.lit(1)
    salted = keyed.withColumn("_file", F.pmod(F.xxhash64("session_id", F.lit(11)), many))
    dealt = salted.repartition(max(1, sum(files.values())), "platform", "bucket", "_file").drop("_file")
    dealt.write.option("compression", "zstd").partitionBy("platform", "bucket").mode("errorifexists").parquet(path)


def daily_summary(rows: DataFrame, path: str) -> None:
    """Replaces exactly the (batch_date, model_version) partitions that ``rows`` hold; a rerun leaves the same table."""
    rows.write.option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("batch_date", "model_version").mode("overwrite").parquet(path)


def one_csv(rows: DataFrame, path: str) -> None:
    """An export in one file; for results that one machine is to read."""
    rows.coalesce(1).write.option("header", True).mode("overwrite").csv(path)


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def summary(scored: DataFrame, batch_date: str, model_version: str) -> DataFrame:
    """Scored journeys in the shape of the summary table: text times in UTC, flags as 0 and 1, joined sequences."""
    text = lambda c: F.regexp_replace(F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"(\.0+|(?<=\.\d{3})0+)$", "")
    has = lambda c, kind: F.col(c).cast(kind) if c in scored.columns else F.lit(None).cast(kind)
    truth = lambda c: F.lower(has(c, "string")).isin("true", "1", "yes").cast("int")
    noise = F.coalesce(has("cluster", "int"), F.lit(NOISE)) == NOISE
    return scored.select(
        F.lit(batch_date).alias("batch_date"), F.lit(model_version).alias("model_version"), F.concat(F.lit(f"{batch_date}_"), F.col("journey_id")).alias("journey_id"), N.customer_id(has("customer_id", "string")).alias("customer_id"),
        "platform", "session_id", text("start_ts").alias("start_time"), text("end_ts").alias("end_time"), *(has(c, "int").alias(c) for c in ("n_events_raw", "n_events_final", "n_unique_tokens")),
        *(F.round(has(c, "double"), 4).alias(c) for c in ("action_ratio", "back_rate", "revisit_ratio", "span_seconds")), F.array_join("sequence_tokens", ",").alias("sequence"),
        F.when(noise, "UNKNOWN").otherwise(F.concat(F.lit("C:"), has("cluster", "string"))).alias("effective_cluster_key"), *(F.coalesce(truth(c), F.lit(0)).alias(c) for c in ("geometric_anomaly", "generative_anomaly", "severe_anomaly")),
        F.when(~noise, has("taxonomy_id", "string")).alias("taxonomy_id"),
    )


#: The columns of the table that daily summaries are loaded into, in its order.
LOADED = (
    "batch_date", "model_version", "platform", "cluster_id", "taxonomy_id", "journey_id", "session_id", "device_id", "customer_id", "start_ts", "end_ts", "boundary_reason",
    "n_events_raw", "n_events_final", "n_loop_removed", "action_ratio", "back_rate", "revisit_ratio", "median_gap_s", "p90_gap_s", "max_gap_s", "entry_token", "exit_token",
    "sequence", "distance_to_centroid", "markov_logprob", "geometric_anomaly", "generative_anomaly", "severe_anomaly", "friction_flags", "scored_at",
)


def utc_text(time: Column, digits: int) -> Column:
    """A time in UTC as text, with so many digits of the second (0, 3 or 6), the rest cut off; null if it is none."""
    at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), time.try_cast("timestamp").cast("timestamp_ntz"))
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss" + ("." + "S" * digits if digits else ""))


def loaded(scored: DataFrame, batch_date: str, model_version: str) -> DataFrame:
    """Scored journeys as rows of the summary table, all of ``LOADED``; a column that ``scored`` lacks is null.

    Journeys' ids start with the day and the platform, so that no two of a batch are alike. Noise and unnamed clusters have
    no taxonomy id. Ids lose blanks and a decimal nought; empty ones, like empty flags, are null. Of the flags only
    behavioural ones are loaded (behavioral_friction_flags, where there is that column).
    """
    has = lambda c, kind: F.col(c).cast(kind) if c in scored.columns else F.lit(None).cast(kind)
    clean = lambda c: F.nullif(F.nullif(F.regexp_replace(F.trim(has(c, "string")), r"\.0$", ""), F.lit("")), F.lit("nan"))
    truth = lambda c: F.coalesce(F.lower(has(c, "string")).isin("true", "1").cast("int"), F.lit(0))
    cluster = F.coalesce(has("cluster", "int"), F.lit(NOISE))
    local = F.regexp_replace("journey_id", F.concat(F.lit("^"), "platform", F.lit("::")), F.lit(""))
    flags = "behavioral_friction_flags" if "behavioral_friction_flags" in scored.columns else "friction_flags"
    values = {
        "batch_date": F.lit(batch_date), "model_version": F.lit(model_version), "platform": F.col("platform"), "cluster_id": cluster,
        "taxonomy_id": F.when(cluster != NOISE, F.nullif(has("taxonomy_id", "string"), F.lit(""))), "journey_id": F.concat(F.lit(f"{batch_date}_"), "platform", F.lit("::"), local),
        **{c: clean(c) for c in ("session_id", "device_id", "customer_id")}, **{c: utc_text(F.col(c), 3) for c in ("start_ts", "end_ts")},
        **{c: has(c, "int") for c in ("n_events_raw", "n_events_final", "n_loop_removed")}, **{c: has(c, "string") for c in ("boundary_reason", "entry_token", "exit_token")},
        **{c: has(c, "double") for c in ("action_ratio", "back_rate", "revisit_ratio", "median_gap_s", "p90_gap_s", "max_gap_s", "distance_to_centroid", "markov_logprob")},
        "sequence": F.array_join("sequence_tokens", ","), **{c: truth(c) for c in ("geometric_anomaly", "generative_anomaly", "severe_anomaly")},
        "friction_flags": F.nullif(has(flags, "string"), F.lit("")), "scored_at": utc_text(has("scored_at", "timestamp"), 6),
    }
    return scored.select(*(values[c].alias(c) for c in LOADED))
