"""Journeys out of an unbounded stream, by typed state of groups of sessions with event-time timers; fixed windows beside them.

Sessions are dealt over groups by a hash, and a group's state is one value: of each session its open journey, bounded by the
rules' length cap, that journey's number and why it began, and when it is due; one timer a group stands at the earliest of
these. So a trigger asks for state and writes it once a group, however many sessions have rows, not a few times a session.
A journey closes at the same boundaries as in batch; the timer closes those that stay idle. Number and reason outlive it by
``remember_seconds``, so that journeys of one session are numbered on across silences, as they are in batch; after that the
session is forgotten. Control rows flush or reset a session at their place in time. Open tails can be read from a stream's
checkpoint as a table, and control rows for all of them made from it.

Needs Spark's RocksDB state store, which the starting functions here set for their own query.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..contracts import STREAM, SegmentRules

#: An event that lies further behind the last one of its session is too late.
TOLERANCE_MS = 2000

OUTPUT = (
    "platform string, session_id string, kind string, journey_no long, start_reason string, close_reason string, n_events int, start_ms long, end_ms long, "
    "tokens array<string>, error string"
)
_STATE = (
    "due long, sessions array<struct<platform:string,session_id:string,journey_no:long,reason:string,due:long,"
    "events:array<struct<ms:long,number:long,kind:string,name:string>>>>"
)
#: Groups of sessions: many to a core, so that they even out.
GROUPS = 1024
#: The event type of control rows; their segment_name says what to do.
CONTROL, FLUSH, RESET = "control", "flush", "reset"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class Session:
    """The open journey of one session: events as (ms, source number, type, name), in order."""

    rules: SegmentRules
    events: list[tuple[int, int, str, str]] = field(default_factory=list)
    journey_no: int = 1
    reason: str = "session_start"
    tolerance_ms: int = TOLERANCE_MS
    buffer: int | None = None  # events held at most; not given: 1000, or as many as the longest journey has

    def _auth(self, e: tuple) -> bool:
        return e[2] == "action" and any(m in e[3].lower() for m in self.rules.auth_markers)

    def boundary(self, e: tuple) -> str | None:
        r, last = self.rules, self.events[-1]
        if e[0] - last[0] > r.idle_seconds * 1000:
            return "idle_gap"
        if len(self.events) >= r.longest:
            return "length_cap"
        if r.cut_on_root and e[2] == "view" and e[3] in r.roots and last[3] not in r.roots and len(self.events) >= r.root_after:
            return "root_return"
        if r.cut_on_auth and self._auth(e) and not self._auth(last):
            return "auth_change"
        return None

    def close(self, reason: str) -> dict | None:
        """The open journey as a row; the next one starts empty. None if nothing is open."""
        if not self.events:
            return None
        screen, tokens = None, []
        for _, _, kind, name in self.events:
            screen = name if kind == "view" else screen
            tokens.append(f"view@{name}" if kind == "view" else f"{kind}@{screen or '<missing>'}#{name}")
        row = {
            "kind": "journey", "journey_no": self.journey_no, "start_reason": self.reason, "close_reason": reason, "n_events": len(tokens),
            "start_ms": self.events[0][0], "end_ms": self.events[-1][0], "tokens": tokens, "error": None,
        }
        self.events, self.journey_no, self.reason = [], self.journey_no + 1, reason
        return row

    def append(self, e: tuple[int | None, int, str, str]) -> list[dict]:
        """Rows that the event brings about: closed journeys, or an error. Within the tolerance late events are sorted in."""
        if e[0] is None or e[0] <= 0:
            return [error("invalid_client_time")]
        last = self.events[-1][0] if self.events else None
        if last is not None and e[0] < last - self.tolerance_ms:
            return [error("event_too_late")]
        out = []
        if last is not None and e[0] >= last and (why := self.boundary(e)):
            out.append(self.close(why))
        bisect.insort(self.events, e, key=lambda x: x[:2])
        if len(self.events) > (self.buffer or max(1000, self.rules.longest)):
            out.append(self.close("buffer_cap"))
        return out

    def snapshot(self, shortest: int) -> dict:
        """The open journey as it stands: provisional, or still collecting."""
        row = Session(self.rules, list(self.events), self.journey_no, self.reason).close("open")
        return row | {"kind": "provisional" if len(self.events) >= shortest else "collecting"}


def error(code: str) -> dict:
    return {"kind": "error", "journey_no": None, "start_reason": None, "close_reason": None, "n_events": None, "start_ms": None, "end_ms": None, "tokens": None, "error": code}


def _arrived(rows: Iterator[pd.DataFrame]) -> dict[tuple, list[tuple]]:
    """Each session's (ms, source number, type, name) of one trigger, whose rows have no order of arrival: by time, then source number, nulls last."""
    table = pd.concat(list(rows)).sort_values(["timeless", "micros", "unnumbered", "source_row_number"], kind="stable")
    ms = (table["micros"] // 1000).tolist()
    found: dict[tuple, list[tuple]] = {}
    for *session, t, n, kind, name in zip(table["platform"], table["session_id"], ms, table["source_row_number"].tolist(), table["event_type"], table["segment_name"]):
        found.setdefault(tuple(session), []).append((t, n, kind, name))
    return found


class JourneyProcessor(StatefulProcessor):
    """One group of sessions: their open journeys and what goes with them as a value, one timer at a time."""

    def __init__(self, rules: SegmentRules, remember_seconds: float, provisional: bool) -> None:
        self.rules, self.remember_ms, self.provisional = rules, int(remember_seconds * 1000), provisional

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("group", _STATE)

    def _held(self) -> tuple[int | None, dict[tuple, tuple[Session, int]]]:
        """When the timer is set to, and each session with when it is due."""
        due, sessions = self.state.get() or (None, [])
        return due, {(p, k): (Session(self.rules, [tuple(e) for e in events], no, reason), at) for p, k, no, reason, at, events in sessions}

    def _due(self, s: Session, now_ms: int) -> int:
        last = s.events[-1][0] + int(self.rules.idle_seconds * 1000) + 1 if s.events else now_ms + self.remember_ms
        return max(last, now_ms + 1)

    def _keep(self, held: dict[tuple, tuple[Session, int]], timer: int | None) -> None:
        then = min((at for _, at in held.values()), default=None)
        if then != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if then is not None:
                self.handle.registerTimer(then)
        if held:
            self.state.update((then, [(*key, s.journey_no, s.reason, at, s.events) for key, (s, at) in held.items()]))
        else:
            self.state.clear()

    def _rows(self, rows: list[tuple[tuple, dict | None]]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([(*key, *r.values()) for key, r in rows if r], columns=[f.split()[0] for f in OUTPUT.split(", ")])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (timer, held), now, out = self._held(), timerValues.getCurrentWatermarkInMs(), []
        for session, arrived in _arrived(rows).items():
            if not (session[1] or "").strip():
                out += [(session, error("missing_session_id"))] * len(arrived)
                continue
            s, known = held[session][0] if session in held else Session(self.rules), True
            for event in arrived:
                kind, name = event[2:]
                if kind == CONTROL and name == RESET:
                    s, known = Session(self.rules), False
                elif kind == CONTROL:
                    out.append((session, s.close(FLUSH)))
                else:
                    out += [(session, r) for r in s.append(event)]
                known = known or bool(s.events)
            if self.provisional and s.events:
                out.append((session, s.snapshot(self.rules.shortest)))
            if known:
                held[session] = s, self._due(s, now)
            else:
                held.pop(session, None)
        self._keep(held, timer)
        yield from self._rows(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (_, held), out = self._held(), []
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        for session in [k for k, (_, at) in held.items() if at <= now]:
            s = held.pop(session)[0]
            if row := s.close("idle_timeout"):
                s.reason = "idle_gap"  # what the next event will find in batch
                held[session] = s, self._due(s, now)
                out.append((session, row))
        self._keep(held, None)  # Spark deletes the timer that has expired
        yield from self._rows(out)


def _grouped(rows: DataFrame, groups: int):
    """Nulls of whole numbers would make floats of them in pandas, so they are 0 with a mark; a time of 0 is as wrong as none."""
    micros, number = F.unix_micros("event_time"), F.col("source_row_number")
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long"))
    rows = rows.withColumns({"timeless": micros.isNull(), "micros": zero(micros), "unnumbered": number.isNull(), "source_row_number": zero(number)})
    return rows.withColumn("session_group", F.pmod(F.xxhash64(*STREAM), F.lit(groups))).groupBy("session_group")


def journeys(
    events: DataFrame, rules: SegmentRules = SegmentRules(), late_seconds: int = 2, provisional: bool = False, remember_seconds: float = 7 * 86400.0, groups: int = GROUPS,
) -> DataFrame:
    """A stream of canonical events as a stream of closed journeys (and error rows; with ``provisional`` also open ones).

    Rows without a session id come out as errors. ``events`` need platform, session_id, event_time, event_type,
    segment_name and source_row_number; rows of the event type ``CONTROL`` flush or reset their session. Events behind the
    watermark are dropped by Spark, events too far behind their own session come out as errors. A table works as well as
    a stream; all its events are then one trigger. A task holds a trigger's rows of one of the ``groups`` at a time; their
    number can't change while a checkpoint is used.
    """
    marked = events.select(*STREAM, "event_time", "source_row_number", "event_type", "segment_name").withWatermark("event_time", f"{late_seconds} seconds")
    return _grouped(marked, groups).transformWithStateInPandas(JourneyProcessor(rules, remember_seconds, provisional), OUTPUT, "append", "EventTime")


WINDOWS = "platform string, session_id string, window_index long, start_ms long, end_ms long, n_events long, n_arrived long"


class WindowProcessor(StatefulProcessor):
    """Windows of a group of sessions: each starts at an event and ends at the first event of a given time later, which starts the next."""

    def __init__(self, seconds: float) -> None:
        self.ms = int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = handle.getValueState("windows", "sessions array<struct<platform:string,session_id:string,window_index:long,start_ms:long,n_events:long,n_arrived:long>>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {(p, k): tuple(rest) for p, k, *rest in (self.windows.get() or ([],))[0]}
        out = []
        for session, arrived in _arrived(rows).items():
            index, start, n, since = held.get(session, (1, None, 0, 0))
            for t in (r[0] for r in arrived):
                if t <= 0:
                    continue
                start = t if start is None else start
                if t - start >= self.ms:
                    out.append((*session, index, start, t, n, since + 1))
                    index, start, n, since = index + 1, t, 1, 0
                else:
                    n, since = n + 1, since + 1
            if start is not None:
                held[session] = index, start, n, since
        if held:
            self.windows.update(([(*session, *rest) for session, rest in held.items()],))
        yield pd.DataFrame(out, columns=[f.split()[0] for f in WINDOWS.split(", ")])


def fixed_durations(events: DataFrame, seconds: float = 30.0, groups: int = GROUPS) -> DataFrame:
    """A stream (or table) of canonical events as its closed windows of ``seconds``, by session and driven by the data.

    ``n_events`` counts from the window's first event on, ``n_arrived`` what has come since the window before was given
    out, the closing event included. Events without a time are passed over.
    """
    rows = events.select(*STREAM, "event_time", "source_row_number", F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("string").alias("segment_name"))
    return _grouped(rows, groups).transformWithStateInPandas(WindowProcessor(seconds), WINDOWS, "append", "None")


@contextmanager
def rocks(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB, as typed state needs; the session's setting comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(key, was)


def finished(rows: DataFrame, folder: str, schema: str = OUTPUT) -> DataFrame:
    """Runs a stream over all that its source holds now, into Parquet below ``folder``, and reads what it has written."""
    out = f"{folder}/rows"
    with rocks(rows.sparkSession):
        writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{folder}/state")
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return rows.sparkSession.read.schema(schema).parquet(out)


def closed_journeys(events: DataFrame, folder: str, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """Runs ``journeys`` over all that a stream holds now, with its state below ``folder``, and reads the result."""
    return finished(journeys(events, rules), folder)


def open_tails(spark: SparkSession, folder: str, operator: int = 0) -> DataFrame:
    """(platform, session_id, journey_no, start_reason, n_events, start_ms, end_ms) of the journeys that a stream left open.

    Read from the state below ``folder`` by Spark's reader of state, partition by partition; the stream may be stopped.
    """
    held = spark.read.format("statestore").option("path", f"{folder}/state").option("operatorId", operator).option("stateVarName", "group").load()
    ms = F.col("events.ms")
    return held.select(F.inline("value.sessions")).where(F.size(ms) > 0).select(
        *STREAM, "journey_no", F.col("reason").alias("start_reason"), F.size(ms).cast("long").alias("n_events"), F.array_min(ms).alias("start_ms"), F.array_max(ms).alias("end_ms"),
    )


def flush_rows(tails: DataFrame, action: str = FLUSH) -> DataFrame:
    """A control row for each session of ``open_tails``, after its last event: put into the stream it flushes (or resets) all."""
    return tails.select(
        *STREAM, F.timestamp_millis("end_ms").alias("event_time"), F.lit(CONTROL).alias("event_type"), F.lit(action).alias("segment_name"), F.lit(2**62).alias("source_row_number"),
    )
