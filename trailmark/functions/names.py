"""Cleaning of times, names, screens and addresses, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import AUTH_MARKERS, BACK_MARKERS, BOOT_SCREENS, CHROME_SCREENS, MISSING, QUERY_KEYS, ROOT_SCREENS


def _blank(x: Column, *more: str) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin("", "nan", "none", *more), F.lit(True))


def client_time(value: Column) -> Column:
    """Epoch milliseconds or ISO 8601 text as a timestamp; null where it is neither."""
    text = F.trim(value.cast("string"))
    millis = text.try_cast("double")
    return F.coalesce(F.timestamp_millis(millis.cast("long")), F.when(millis.isNull() & (text != ""), F.try_to_timestamp(text)))


def client_time_by_shape(value: Column) -> Column:
    """Thirteen digits are milliseconds, ten are seconds, anything else is ISO 8601 text."""
    text = F.trim(value.cast("string"))
    return (
        F.when(text.rlike(r"^\d{13}$"), F.timestamp_millis(text.try_cast("long")))
        .when(text.rlike(r"^\d{10}$"), F.timestamp_seconds(text.try_cast("long")))
        .otherwise(F.try_to_timestamp(text))
    )


def platform(value: Column) -> Column:
    text = F.lower(F.trim(value.cast("string")))
    return F.when(_blank(text, "<na>"), "unknown").otherwise(text)


def event_type(value: Column) -> Column:
    text = platform(value)
    return F.when(text == "[cly]_view", "view").when(text == "[cly]_action", "action").otherwise(text)


def customer_id(value: Column) -> Column:
    """Without the ``.0`` of a number read as a float; null where blank."""
    return F.nullif(F.regexp_replace(F.trim(value.cast("string")), r"^(\d+)\.0$", "$1"), F.lit(""))


def stable_id(*parts: Column) -> Column:
    """SHA-1 over the parts, joined by U+001F; null parts count as empty."""
    return F.sha1(F.concat_ws("\x1f", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def session_bucket(platform_: Column, session: Column, buckets: int) -> Column:
    """A stable bucket: the first 8 bytes of a SHA-1 as an unsigned number, modulo ``buckets``."""
    digest = F.sha1(F.concat_ws("\x1f", F.lower(F.trim(platform_)), F.trim(session)))
    return F.pmod(F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(buckets)).cast("int")


def mask_segment(segment: Column) -> Column:
    """A path segment that identifies an instance as ``{id}``, ``{uuid}`` or ``{code}``."""
    return (
        F.when(segment.rlike(r"^\d+$"), "{id}")
        .when(segment.rlike(r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^[0-9a-f]{16,}$"), "{uuid}")
        .when(segment.rlike(r"^(?=.*\d)[A-Z0-9]{6,}$"), "{code}")
        .otherwise(segment)
    )


def mask_path(path: Column) -> Column:
    return F.array_join(F.transform(F.split(path, "/"), mask_segment), "/")


def canonical_url(url: Column) -> Column:
    """Host, masked path without slashes at its end, and the query keys that matter in order."""
    rest = F.regexp_extract(url, r"^[^:/?#]*://([^#]*)", 1)
    place, query = F.regexp_extract(rest, r"^([^?]*)", 1), F.regexp_extract(rest, r"\?(.*)$", 1)
    host, path = F.regexp_extract(place, r"^([^/]*)", 1), F.regexp_replace(mask_path(F.regexp_extract(place, r"^[^/]*(.*)$", 1)), r"/+$", "")
    pairs = F.transform(F.split(query, "&"), lambda kv: F.concat(F.lower(F.regexp_extract(kv, r"^([^=]*)=", 1)), F.lit("="), F.regexp_extract(kv, r"^[^=]*=(.*)$", 1)))
    kept = F.array_sort(F.filter(pairs, lambda kv: kv.rlike(rf"^({'|'.join(QUERY_KEYS)})=.")))
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def query_keys(url: Column) -> Column:
    """The sorted distinct names of a url's query parameters."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.regexp_extract(kv, r"^([^=]*)", 1))
    return F.array_sort(F.array_distinct(F.filter(keys, lambda k: k != "")))


def canonical_name(name: Column, missing: str = MISSING) -> Column:
    text = F.trim(name)
    return F.when(_blank(name, "null"), missing).when(F.contains(text, F.lit("://")), canonical_url(text)).when(F.contains(text, F.lit("/")), mask_path(text)).otherwise(text)


def screen_class(screen: Column) -> Column:
    return F.when(screen.isin(*BOOT_SCREENS), "boot").when(screen.isin(*CHROME_SCREENS), "chrome").otherwise("ux")


def _any(text: Column, markers: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(low, F.lit(m))
    return F.coalesce(out, F.lit(False))


def is_back(target: Column) -> Column:
    return _any(target, BACK_MARKERS)


def is_abandoned(target: Column, stage: Column | None = None) -> Column:
    """Whether an event gives up: by its operation's stage where events are labelled, else by its target's name."""
    return is_back(target) if stage is None else F.coalesce(stage == "abort", F.lit(False))


def is_root(screen: Column, roots: tuple[str, ...] = ROOT_SCREENS) -> Column:
    return F.coalesce(screen.isin(*roots), F.lit(False))


def is_auth(kind: Column, target: Column, markers: tuple[str, ...] = AUTH_MARKERS) -> Column:
    return F.coalesce((kind == "action") & _any(target, markers), F.lit(False))


def event_token(kind: Column, screen: Column, target: Column) -> Column:
    return F.when(kind == "view", F.concat(kind, F.lit("@"), screen)).otherwise(F.concat(kind, F.lit("@"), screen, F.lit("#"), target))


def mask_identifier(value: Column, left: int = 4, right: int = 4) -> Column:
    """An identifier for display: its two ends, or stars where it is short."""
    text = value.cast("string")
    return F.when(F.length(text) <= left + right, F.repeat(F.lit("*"), F.length(text))).otherwise(F.concat(F.substring(text, 1, left), F.lit("..."), F.substring(text, -right, right)))
