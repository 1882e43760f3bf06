"""Raw events to the canonical contract, and what can be said of streams before they are cut into journeys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import ALIASES, MISSING, ORDER, STREAM
from ..functions import names as N
from . import ranges


def stream_window() -> Window:
    return Window.partitionBy(*STREAM).orderBy(*ORDER)


def seconds(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(1e6)


def rename_aliases(raw: DataFrame) -> DataFrame:
    """``raw`` with the alias columns renamed whose target is missing; the first alias present wins."""
    found = {next((a for a in aliases if a in raw.columns), None): target for target, aliases in ALIASES.items() if target not in raw.columns}
    return raw.withColumnsRenamed({a: t for a, t in found.items() if a})


def canonicalize(raw: DataFrame, source_file: str | Column = "in_memory") -> DataFrame:
    """Canonical events, without rows that have no valid time or session; gaps are within the stream's total order.

    ``source_row_number`` is taken from the input, or counted in input order where it is missing. event_token and
    screen_context come with the journeys, whose boundaries they depend on.
    """
    raw = rename_aliases(raw)
    if lacking := {"session_id", "platform", "key", "segmentation_name", "client_time"} - set(raw.columns):
        raise ValueError(f"input lacks columns: {sorted(lacking)}")
    has = lambda c: F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string")
    number = F.col("source_row_number").cast("long") if "source_row_number" in raw.columns else F.monotonically_increasing_id()
    file = F.lit(source_file) if isinstance(source_file, str) else source_file
    out = raw.select(
        has("_id").cast("string").alias("record_id"), F.coalesce(has("device_id").cast("string"), F.lit("")).alias("device_id"), N.customer_id(has("customer_id")).alias("customer_id"),
        F.trim(F.col("session_id").cast("string")).alias("session_id"), N.platform(F.col("platform")).alias("platform"), N.client_time(F.col("client_time")).alias("event_time"),
        N.event_type(F.col("key")).alias("event_type"), N.canonical_name(F.col("segmentation_name").cast("string")).alias("segment_name"), has("screen_id").cast("string").alias("screen_id"),
        file.alias("source_file"), number.alias("source_row_number"),
    )
    own = N.stable_id(*map(F.col, ("platform", "session_id", "event_time", "event_type", "segment_name", "source_file", "source_row_number")))
    out = out.where(F.col("event_time").isNotNull() & (F.coalesce("session_id", F.lit("")) != ""))
    return with_gaps(out.withColumn("record_id", F.coalesce(F.nullif("record_id", F.lit("")), own)))


def with_gaps(events: DataFrame) -> DataFrame:
    w, t = stream_window(), F.col("event_time")
    return events.withColumns({"gap_prev_seconds": seconds(t, F.lag(t).over(w)), "gap_next_seconds": seconds(F.lead(t).over(w), t)})


def intake_report(raw: DataFrame) -> DataFrame:
    """One row: input rows, bad times, bad sessions, exact duplicates of what is left."""
    raw = rename_aliases(raw)
    time, session = N.client_time(F.col("client_time")), F.coalesce(F.trim(F.col("session_id").cast("string")), F.lit(""))
    rows = raw.select(time.alias("t"), session.alias("s"), N.platform(F.col("platform")).alias("p"), N.event_type(F.col("key")).alias("k"), N.canonical_name(F.col("segmentation_name").cast("string")).alias("n"))
    good = F.col("t").isNotNull() & (F.col("s") != "")
    each = rows.groupBy("p", "s", "t", "k", "n").agg(F.count("*").alias("rows"))
    return each.agg(
        F.sum("rows").alias("rows_input"), F.sum(F.when(good, F.col("rows")).otherwise(0)).alias("rows_output"), F.sum(F.when(F.col("t").isNull(), F.col("rows")).otherwise(0)).alias("invalid_client_time"),
        F.sum(F.when(F.col("s") == "", F.col("rows")).otherwise(0)).alias("invalid_session_id"), F.sum(F.when(good, F.col("rows") - 1).otherwise(0)).alias("exact_duplicates"),
    )


def from_event_table(events: DataFrame, gaps: bool = True) -> DataFrame:
    """The generic ``events`` table as canonical events: k of its props stands for a screen, its type for an action.

    Streams have no windows over all rows, so for them ``gaps`` must be False.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_type") == "view", "view").otherwise("action")
    out = events.select(
        F.col("event_id").cast("string").alias("record_id"), F.lit("").alias("device_id"), F.col("user_id").cast("string").alias("customer_id"), F.col("user_id").cast("string").alias("session_id"),
        F.when(F.col("user_id") % 2 == 0, "android").otherwise("ios").alias("platform"), F.col("ts").cast("timestamp").alias("event_time"), kind.alias("event_type"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("k"), F.expr("cast(get_json_object(props, '$.k') as int) div 20"))).otherwise(F.col("event_type")).alias("segment_name"),
        F.lit(None).cast("string").alias("screen_id"), F.lit("events").alias("source_file"), F.col("event_id").alias("source_row_number"),
    )
    return with_gaps(out) if gaps else out


def out_of_order(events: DataFrame, key: str, order: str, time: str) -> DataFrame:
    """Rows whose time lies before that of the row before them in source order."""
    return ranges.lag(events, [F.col(order)], {"previous_time": time}, [key]).where(F.col(time) < F.col("previous_time"))


def clean_sessions(events: DataFrame, session: str, order: list[str], time: str, pause_minutes: float, identities: list[str]) -> DataFrame:
    """``events`` with split_reasons, split_index and clean_session: sessions are cut at pauses, identity changes and bad times."""
    w = Window.partitionBy(session).orderBy(*order)
    reasons = [F.when(seconds(F.col(time), F.lag(time).over(w)) > pause_minutes * 60, "inactivity"), F.when(F.col(time).isNull(), "invalid_time")]
    for c in identities:
        reasons.append(F.when(F.col(c).isNotNull() & F.lag(c).over(w).isNotNull() & (F.col(c) != F.lag(c).over(w)), f"{c}_change"))
    out = events.withColumn("split_reasons", F.array_join(F.array_compact(F.array(*reasons)), ";"))
    out = out.withColumn("split_index", F.sum((F.col("split_reasons") != "").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("clean_session", F.concat(F.col(session).cast("string"), F.lit("#"), F.col("split_index")))


def previous_view(events: DataFrame) -> DataFrame:
    """As-of lookup: the last view strictly before each event of its stream, and the seconds since."""
    w = stream_window().rowsBetween(Window.unboundedPreceding, -1)
    view = F.when(F.col("event_type") == "view", F.struct("segment_name", "event_time"))
    out = events.withColumn("_view", F.last(view, ignorenulls=True).over(w))
    return out.withColumns({"previous_view": F.col("_view.segment_name"), "seconds_since_view": seconds(F.col("event_time"), F.col("_view.event_time"))}).drop("_view")


def platforms_present(rows: DataFrame, wanted: tuple[str, ...] = ("android", "ios")) -> list[str]:
    """Which of ``wanted`` platforms a day's events have, in that order: steps of the others can be skipped."""
    found = {r[0] for r in rows.where(F.col("platform").isin(*wanted)).select("platform").distinct().collect()}  # at most as many as wanted
    return [p for p in wanted if p in found]


def exact_tokens(rows: DataFrame, columns: tuple[str, ...] = ("event_type", "segment_name", "screen_name"), sentinel: str = MISSING) -> DataFrame:
    """``rows`` with exact_token, a JSON array of ``columns`` that can be read back; ``sentinel`` stands for a null.

    ValueError if a value equals ``sentinel``, as the array couldn't tell it from a null.
    """
    hits = rows.agg(*(F.count_if(F.col(c) == sentinel).alias(c) for c in columns)).first().asDict()
    if clash := {c: n for c, n in hits.items() if n}:
        raise ValueError(f"values that equal the mark of missing ones: {clash}")
    return rows.withColumn("exact_token", F.to_json(F.array(*(F.coalesce(F.col(c).cast("string"), F.lit(sentinel)) for c in columns))))


def read_exact_tokens(token: Column, columns: tuple[str, ...] = ("event_type", "segment_name", "screen_name"), sentinel: str = MISSING) -> list[Column]:
    """The columns that ``exact_tokens`` put together."""
    parts = F.from_json(token, "array<string>")
    return [F.nullif(F.get(parts, i), F.lit(sentinel)).alias(c) for i, c in enumerate(columns)]
