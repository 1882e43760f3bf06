"""Streams cut into journeys, journeys cleaned and summed up."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import MISSING, STREAM, CleanRules, SegmentRules
from ..functions import names as N
from ..store import kept
from . import quantiles
from .events import seconds, stream_window
from .vocabulary import sized

_REASONS = np.array(["", "session_start", "idle_gap", "length_cap", "root_return", "auth_change"], dtype=object)


def _flags(events: DataFrame, rules: SegmentRules) -> Column:
    """What each event of the sorted streams may cut: 1 a stream's start, else 2 a pause, and 8 a sign-in change, 16 a root screen."""
    w, kind, name = stream_window(), F.col("event_type"), F.col("segment_name")
    auth = N.is_auth(kind, name, rules.auth_markers) & ~N.is_auth(F.lag(kind).over(w), F.lag(name).over(w), rules.auth_markers) if rules.cut_on_auth else F.lit(False)
    root = (kind == "view") & N.is_root(name, rules.roots) & ~N.is_root(F.lag(name).over(w), rules.roots) if rules.cut_on_root else F.lit(False)
    first = F.row_number().over(w) == 1
    idle = F.coalesce(seconds(F.col("event_time"), F.lag("event_time").over(w)), F.lit(0.0)) > rules.idle_seconds
    return F.when(first, 1).when(idle, 2).otherwise(0) + F.when(auth, 8).otherwise(0) + F.when(root, 16).otherwise(0)


def _lengths(f: np.ndarray, since: int, longest: int, after: int) -> tuple[list[int], int]:
    """Lengths of the journeys that end in a batch of flags, and of the one left open; ``since`` events were open before it."""
    n, out, at = len(f), [], 0
    hard, roots = np.append(np.flatnonzero(f & 11), n), np.append(np.flatnonzero(f & 16), n)
    while at < n:
        cut = min(hard[np.searchsorted(hard, at)], at + max(0, longest - since), roots[np.searchsorted(roots, min(at + max(0, after - since), n))])
        cut = int(min(cut, n))
        since += cut - at
        if cut < n:
            out += [since] if since else []
            since, cut = 1, cut + 1
        at = cut
    return out, since


def segment(events: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """``events`` with journey_no (from 1 in each stream), journey_pos (from 0), boundary_reason and journey_id.

    Pauses and sign-in changes cut whatever was cut before, so windows find them; only the length cap and the return to
    a root screen depend on the last cut. That is a fold over the sorted partitions of the same shuffle which holds one
    number from row to row and jumps from cut to cut, so a stream may be of any length.
    """
    flags = _flags(events, rules)
    marked = events.withColumn("_flags", flags.cast("int"))
    schema = T.StructType([*events.schema.fields, T.StructField("journey_no", T.LongType()), T.StructField("journey_pos", T.IntegerType()), T.StructField("boundary_reason", T.StringType())])
    longest, after = rules.longest, rules.root_after

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        since, number = 0, 0
        for b in batches:
            n = b.num_rows
            f = b.column(b.num_columns - 1).to_numpy()
            hard, roots = np.append(np.flatnonzero(f & 11), n), np.append(np.flatnonzero(f & 16), n)
            reason, no, pos = np.zeros(n, dtype=np.int8), np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int32)
            at = 0  # rows below are done; ``since`` events of the open journey lie before it
            while at < n:
                cut = min(hard[np.searchsorted(hard, at)], at + max(0, longest - since), roots[np.searchsorted(roots, min(at + max(0, after - since), n))])
                cut = int(min(cut, n))
                no[at:cut], pos[at:cut] = number, np.arange(since, since + cut - at)
                since += cut - at
                if cut < n:
                    x = int(f[cut])
                    reason[cut] = x & 3 or (3 if since >= longest else 4 if x & 16 and since >= after else 5)
                    number = 1 if x & 1 else number + 1
                    no[cut], pos[cut], since, cut = number, 0, 1, cut + 1
                at = cut
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(no), pa.array(pos), pa.array(_REASONS[reason], pa.string())], names=schema.names)

    out = marked.mapInArrow(fold, schema)
    return out.withColumn("journey_id", F.concat_ws("::", *STREAM, F.col("journey_no").cast("string")))


def with_screens(segmented: DataFrame) -> DataFrame:
    """Journeys' events with screen_context (explicit, else the view's own, else carried forward in the journey) and event_token."""
    own = F.nullif(N.canonical_name(F.col("screen_id")), F.lit(MISSING))
    view = F.when(F.col("event_type") == "view", F.coalesce(own, "segment_name"))
    before = Window.partitionBy("platform", "session_id", "journey_no").orderBy("journey_pos").rowsBetween(Window.unboundedPreceding, 0)
    screen = F.coalesce(own, F.last(view, ignorenulls=True).over(before), F.lit(MISSING))
    return segmented.withColumn("screen_context", screen).withColumn("event_token", N.event_token(F.col("event_type"), F.col("screen_context"), F.col("segment_name")))


def kept_after_runs(tokens: list[str]) -> list[int]:
    return [i for i, t in enumerate(tokens) if i == 0 or t != tokens[i - 1]]


def kept_after_cycles(tokens: list[str], longest: int = 4, repeats: int = 2) -> list[int]:
    """Places that stay when a cycle of 2 to ``longest`` tokens, ``repeats`` times or more in a row, is left once; shortest first."""
    kept, at, n = [], 0, len(tokens)
    while at < n:
        for period in range(2, longest + 1):
            end = at + period
            while end + period <= n and tokens[end : end + period] == tokens[at : at + period]:
                end += period
            if end - at >= period * repeats:
                kept += range(at, at + period)
                at = end
                break
        else:
            kept.append(at)
            at += 1
    return kept


def cleaned(tokens: Column, rules: CleanRules = CleanRules()) -> Column:
    """Struct of kept (places in ``tokens``), n_dedup and n_loop, for arrays of journey length."""

    @F.pandas_udf("kept array<int>, n_dedup int, n_loop int")
    def clean(column: pd.Series) -> pd.DataFrame:
        rows = []
        for tokens in column:
            tokens = list(tokens) if tokens is not None else []
            places = kept_after_runs(tokens) if rules.runs else list(range(len(tokens)))
            left = kept_after_cycles([tokens[i] for i in places], rules.longest_cycle, rules.repeats) if rules.cycles else range(len(places))
            kept = [places[i] for i in left]
            rows.append((kept, len(tokens) - len(places), len(places) - len(kept)))
        return pd.DataFrame(rows, columns=["kept", "n_dedup", "n_loop"])

    return clean(tokens)


def roll_up(events: DataFrame, rules: CleanRules = CleanRules(), token: str = "event_token") -> DataFrame:
    """One row a journey from ``with_screens``: sizes, ratios, times, end tokens and the cleaned token sequence.

    Journeys have a bounded length, so their events are gathered as one array each. Where runs are the only thing that
    is collapsed all is built in; cycles take one vectorised function over the token arrays.
    """
    drop = (F.lit(rules.drop_chrome) & (N.screen_class(F.col("screen_context")) == "chrome")) | (F.lit(rules.drop_boot) & (N.screen_class(F.col("screen_context")) == "boot"))
    back = N.is_abandoned(F.col("segment_name"), F.col("operation_stage") if "operation_stage" in events.columns else None)
    event = F.struct("journey_pos", F.col(token).alias("token"), "event_time", (F.col("event_type") == "action").alias("action"), back.alias("back"), drop.alias("dropped"))
    rows = events.groupBy(*STREAM, "journey_no", "journey_id").agg(
        F.array_sort(F.collect_list(event)).alias("e"), F.max("device_id").alias("device_id"), F.max("customer_id").alias("customer_id"), F.max(F.when(F.col("journey_pos") == 0, F.col("boundary_reason"))).alias("boundary_reason")
    )
    rows = rows.withColumn("s", F.filter("e", lambda x: ~x["dropped"]))
    tokens = F.transform("s", lambda x: x["token"])
    if rules.cycles:
        rows = rows.withColumn("c", cleaned(tokens, rules))
    else:
        first = F.filter(F.transform("s", lambda x, i: F.when((i == 0) | (x["token"] != F.get("s", i - 1)["token"]), i)), lambda i: i.isNotNull()) if rules.runs else F.transform("s", lambda x, i: i)
        rows = rows.withColumn("_kept", first).withColumn("c", F.struct(F.col("_kept").alias("kept"), (F.size("s") - F.size("_kept")).alias("n_dedup"), F.lit(0).alias("n_loop"))).drop("_kept")
    rows = rows.withColumn("k", F.transform("c.kept", lambda i: F.get("s", i)))
    rows = rows.withColumn("sequence_tokens", F.transform("k", lambda x: x["token"])).withColumn("n", F.size("k"))
    gap = F.transform(F.sequence(F.lit(1), F.greatest(F.col("n") - 1, F.lit(1))), lambda i: seconds(F.get("k", i)["event_time"], F.get("k", i - 1)["event_time"]))
    rows = rows.withColumn("gaps", F.array_sort(F.filter(gap, lambda g: g >= 0)))
    share = lambda x: F.when(F.col("n") > 0, F.round(x / F.col("n"), 4)).otherwise(0.0)
    times = lambda end: F.when(F.col("n") > 0, F.element_at("k", end)["event_time"]).otherwise(F.element_at("e", end)["event_time"])
    return rows.select(
        "journey_id", *STREAM, "journey_no", "device_id", "customer_id", times(1).alias("start_ts"), times(-1).alias("end_ts"), "boundary_reason",
        F.size("e").alias("n_events_raw"), F.col("n").alias("n_events_final"), F.size(F.array_distinct("sequence_tokens")).alias("n_unique_tokens"), (F.size("e") - F.size("s")).alias("n_dropped_screens"),
        F.col("c.n_dedup").alias("n_dedup_removed"), F.col("c.n_loop").alias("n_loop_removed"),
        share(F.size(F.filter("k", lambda x: x["action"]))).alias("action_ratio"), share(F.size(F.filter("k", lambda x: x["back"]))).alias("back_rate"),
        F.when(F.col("n") > 0, F.round(1 - F.size(F.array_distinct("sequence_tokens")) / F.col("n"), 4)).otherwise(0.0).alias("revisit_ratio"),
        F.round(seconds(times(-1), times(1)), 3).alias("span_seconds"), *(F.round(quantile_of(F.col("gaps"), q), 3).alias(n) for q, n in ((0.5, "median_gap_s"), (0.9, "p90_gap_s"), (1.0, "max_gap_s"))),
        F.when(F.col("n") > 0, F.element_at("sequence_tokens", 1)).alias("entry_token"), F.when(F.col("n") > 0, F.element_at("sequence_tokens", -1)).alias("exit_token"), "sequence_tokens",
    )


def quantile_of(sorted_: Column, q: float) -> Column:
    """Linear quantile of a sorted array of numbers; 0 where it is empty."""
    at = (F.size(sorted_) - 1) * q
    low, high = F.floor(at).cast("int"), F.ceil(at).cast("int")
    return F.when(F.size(sorted_) > 0, F.get(sorted_, low) + (F.get(sorted_, high) - F.get(sorted_, low)) * (at - low)).otherwise(0.0)


def segmentation_report(segmented: DataFrame, shortest: int = 3) -> DataFrame:
    """(metric, value): sessions, journeys, events, lengths, short journeys, and cuts by reason."""
    cut = segmented.groupBy(*STREAM, "journey_no").agg(F.count("*").alias("n"), F.min_by("boundary_reason", "journey_pos").alias("reason"))
    sizes = kept(cut)
    facts = sizes.agg(
        F.count_distinct("session_id").cast("double").alias("sessions"), F.count("*").cast("double").alias("journeys"), F.sum("n").cast("double").alias("events"), F.round(F.avg("n"), 2).alias("mean_journey_length"),
        F.max("n").cast("double").alias("max_journey_length"),
        F.count_if(F.col("n") < shortest).cast("double").alias("journeys_below_min_length"),
    )
    ends = {"median_journey_length": F.col("_q")[0], "p90_journey_length": F.col("_q")[1]}
    facts = quantiles.beside(facts, sizes, [], {"_q": ("n", (0.5, 0.9))}).withColumns(ends).drop("_q")
    stacked = facts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in facts.columns))))
    cuts = sizes.where("reason <> ''").groupBy("reason").agg(F.count("*").cast("double").alias("value"))  # a cut begins a journey
    return stacked.union(cuts.select(F.concat(F.lit("cut_reason::"), "reason"), "value"))


def sweep_idle_gap(events: DataFrame, grid: list[float], rules: SegmentRules) -> DataFrame:
    """Journeys and their lengths for each idle threshold of ``grid``, from one pass over the sorted streams.

    A fold carries one counter a threshold from row to row, jumps from cut to cut, and gives out how many journeys of
    each length it has closed; these counts, a row a length and partition, are all that is shuffled after the sort.
    """
    flags = _flags(events, SegmentRules(**{**rules.__dict__, "idle_seconds": float("inf")}))
    gap = F.coalesce(seconds(F.col("event_time"), F.lag("event_time").over(stream_window())), F.lit(0.0))
    marked = events.select(flags.cast("int").alias("_f"), gap.alias("_gap"))
    taus = np.array(grid, dtype=float)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        since, closed = [0] * len(taus), [Counter() for _ in taus]
        for b in batches:
            f, gaps = b.column(0).to_numpy(), b.column(1).to_numpy()
            for k, tau in enumerate(taus):
                own = np.where((f & 1 == 0) & (gaps > tau), f | 2, f)
                lengths, since[k] = _lengths(own, since[k], rules.longest, rules.root_after)
                closed[k].update(lengths)
        rows = [(float(t), n, c) for t, counts, rest in zip(taus, closed, since) for n, c in (counts + Counter([rest])).items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.float64(), pa.int64(), pa.int64()))], ["tau", "n", "c"])

    counts = marked.mapInArrow(fold, "tau double, n long, c long").groupBy("tau", "n").agg(F.sum("c").alias("c"))
    up = F.sum("c").over(Window.partitionBy("tau").orderBy("n"))
    ranked = counts.withColumns({"up": up, "all": F.sum("c").over(Window.partitionBy("tau"))})  # a row a length
    at = lambda half: F.min(F.when(F.col("up") > half, F.col("n")))
    share = lambda hit: F.round(F.sum(F.when(hit, F.col("c")).otherwise(0)) / F.sum("c"), 4)
    return ranked.groupBy(F.col("tau").alias("idle_gap_seconds")).agg(
        F.sum("c").alias("journeys"), F.round(F.sum(F.col("n") * F.col("c")) / F.sum("c"), 2).alias("mean_length"),
        ((at(F.floor((F.col("all") - 1) / 2)) + at(F.ceil((F.col("all") - 1) / 2))) / 2).alias("median_length"),
        share(F.col("n") < 3).alias("share_len_lt_3"), share(F.col("n") > 50).alias("share_len_gt_50"),
    )


def run_lengths(events: DataFrame, key: list[str], order: list[str], token: str) -> DataFrame:
    """Run-length encoding: (key, run, token, n, first and last position) by gaps and islands."""
    w = Window.partitionBy(*key).orderBy(*order)
    rows = events.withColumn("_i", F.row_number().over(w)).withColumn("_new", (F.lag(token).over(w).isNull() | (F.lag(token).over(w) != F.col(token))).cast("int"))
    rows = rows.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "run").agg(F.min(token).alias("token"), F.count("*").alias("n"), F.min("_i").alias("first_pos"), F.max("_i").alias("last_pos"))


def contexts(segmented: DataFrame, order: int = 3, token: str = "event_token") -> DataFrame:
    """Each event with its contexts of up to ``order`` tokens, itself last: (stream, journey_no, journey_pos, k, context, next)."""
    w = Window.partitionBy(*STREAM, "journey_no").orderBy("journey_pos")
    rows = segmented.select(*STREAM, "journey_no", "journey_pos", F.lead(token).over(w).alias("next"), *(F.lag(token, order - 1 - i).over(w).alias(f"t{i}") for i in range(order)))
    of = lambda k: F.struct(F.lit(k).alias("k"), F.when(F.col(f"t{order - k}").isNotNull(), F.array(*(F.col(f"t{i}") for i in range(order - k, order)))).alias("context"))
    return rows.select(*STREAM, "journey_no", "journey_pos", "next", F.inline(F.array(*(of(k) for k in range(1, order + 1))))).where("context is not null")


def branching_entropy(segmented: DataFrame, order: int = 3, token: str = "event_token", least: int = 3) -> DataFrame:
    """(context, n, entropy in nats of the next token) for contexts seen ``least`` times or more."""
    return _branching(contexts(segmented, order, token).where("next is not null"), least)


def _branching(each: DataFrame, least: int) -> DataFrame:
    counts = each.groupBy("k", "context", "next").agg(F.count("*").alias("c"))
    n, logs = F.sum("c"), F.sum(F.col("c") * F.ln("c"))
    return counts.groupBy("k", "context").agg(n.alias("n"), (F.ln(n) - logs / n).alias("entropy")).where(F.col("n") >= least)


def refine_with_entropy(segmented: DataFrame, percentile: float = 0.9, order: int = 3, shortest: int = 3, token: str = "event_token") -> DataFrame:
    """``segmented`` with entropy_score, and journeys cut again where the score reaches the given percentile of positive scores.

    A score is the branching entropy of the longest known context that ends at the event. Events keep their place: they
    are written once with their contexts as columns, each of which is looked up among the known ones, with a broadcast
    where these are few. The second cut is a fold over each journey, whose length is bounded.
    """
    journey = Window.partitionBy(*STREAM, "journey_no")
    w = journey.orderBy("journey_pos")
    near = {f"_t{i}": F.lag(token, order - 1 - i).over(w) for i in range(order)}
    whole = lambda k: F.when(F.col(f"_t{order - k}").isNotNull(), F.array(*(F.col(f"_t{i}") for i in range(order - k, order))))
    rows = segmented.withColumns({**near, "_next": F.lead(token).over(w)}).withColumns({f"_c{k}": whole(k) for k in range(1, order + 1)})
    rows = kept(rows.drop(*near))
    each = rows.where("_next is not null").select(F.inline(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"_c{k}").alias("context"), F.col("_next").alias("next")) for k in range(1, order + 1))))).where("context is not null")
    known = kept(_branching(each, 3))
    for k in range(1, order + 1):
        rows = rows.join(sized(known.where(F.col("k") == k).select(F.col("context").alias(f"_c{k}"), F.col("entropy").alias(f"_e{k}"))), f"_c{k}", "left")
    score = F.coalesce(*(F.col(f"_e{k}") for k in range(order, 0, -1)), F.lit(0.0))
    out = kept(rows.select(*segmented.columns, score.alias("entropy_score")))
    high = quantiles.one(out.where("entropy_score > 0"), [], "entropy_score", percentile, "v").first()
    if high is None:
        return out
    high = high["v"]
    hits = out.where(F.col("entropy_score") >= high).groupBy(*STREAM, "journey_no").agg(F.sort_array(F.collect_list("journey_pos")).alias("_places"))
    cuts = F.aggregate("_places", F.array().cast("array<int>"), lambda a, p: F.when(p - F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) >= shortest, F.array_append(a, p)).otherwise(a))
    hits = hits.select(*STREAM, "journey_no", cuts.alias("_cuts")).where(F.size("_cuts") > 0)
    part = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<int>")), lambda p: p <= F.col("journey_pos")))
    return out.join(hits, [*STREAM, "journey_no"], "left").withColumn("journey_id_rule", F.col("journey_id")).withColumn("journey_id", F.concat_ws(".", "journey_id", part.cast("string"))).select(*out.columns, "journey_id_rule")


def with_gap_events(segmented: DataFrame) -> DataFrame:
    """Seconds between kept neighbours of a journey."""
    w = Window.partitionBy(*STREAM, "journey_no").orderBy("journey_pos")
    return segmented.withColumn("gap_in_journey", seconds(F.col("event_time"), F.lag("event_time").over(w)))


def eligible(rows: DataFrame, sequence: str = "sequence_tokens", least: int = 3) -> DataFrame:
    """``rows`` with model_eligible: whether the cleaned sequence has ``least`` tokens or more; models are fitted to and score those alone."""
    return rows.withColumn("model_eligible", F.coalesce(F.size(sequence) >= least, F.lit(False)))
