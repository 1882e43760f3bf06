"""URL filters: host and path rules, and a Bloom filter cascade for listed keys.

A cascade (CRLite, Larisch et al.) stores which keys of a known universe are listed: its first level is a Bloom filter
of the listed keys, the second one of the unlisted keys that the first lets pass, the third one of the listed keys that
the second lets pass, and so on until none is left. For every key of the universe the answer is exact. Rows are then
judged without a join, by bit tests against a few arrays of checked size; where the list outgrows one, keys are dealt to
segments by hash, each with a cascade of its own.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits a key, hash functions, and the most bits that a segment's filter may take (2^23 bits are 1 MB).
BITS_A_KEY, HASHES, MOST_BITS = 10, 7, 1 << 23


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and the start of a path, like ``example.net/en/``; verdict: allow or block."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty for a null url or one without ``://``."""
    after = F.when(F.contains(url, F.lit("://")), url.substr(F.instr(url, "://") + F.lit(3), F.length(url)))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits; null where none does."""
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):  # the longest is tested first
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        which, verdict = F.when(fits, r.pattern).otherwise(which), F.when(fits, r.verdict).otherwise(verdict)
    return which, verdict


@dataclass
class Level:
    bits: int
    seed: int
    words: DataFrame  # (segment, words): the 64-bit words of each segment's filter, in order

    def passes(self, key: Column, segment: int) -> Column:
        """Whether the filter of ``segment`` holds ``key``; a segment without a filter holds nothing."""
        words = F.coalesce(self.words.where(F.col("segment") == segment).select("words").scalar(), F.array().cast("array<long>"))
        out = F.lit(True)
        for at in _positions(key, self.bits, self.seed):
            word = F.coalesce(F.get(words, F.shiftright(at, 6).cast("int")), F.lit(0).cast("long"))
            out = out & (F.call_function("shiftrightunsigned", word, _bit(at)).bitwiseAND(F.lit(1)) == 1)
        return out


def _bit(at: Column) -> Column:
    return at.bitwiseAND(F.lit(63)).cast("int")


def _positions(key: Column, bits: int, seed: int) -> list[Column]:
    size = F.lit(bits).cast("long")
    one, two = F.pmod(F.xxhash64(key, F.lit(seed)), size), F.pmod(F.xxhash64(F.lit(seed), key), size)
    return [F.pmod(one + F.lit(i) * two, size) for i in range(HASHES)]


def _level(keys: DataFrame, bits: int, seed: int) -> Level:
    """Filters of ``bits`` bits over ``keys`` (segment, key), one for each segment, all made by one aggregation."""
    at = F.explode(F.array(*_positions(F.col("key"), bits, seed))).alias("at")
    ones = keys.select("segment", at).select("segment", F.shiftright("at", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("at"))).alias("set"))
    words = ones.groupBy("segment", "word").agg(F.bit_or("set").alias("set"))
    found = F.map_from_entries(F.collect_list(F.struct("word", "set")))  # bits // 64 entries at most
    row = words.groupBy("segment").agg(found.alias("found"))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(bits // 64 - 1).cast("long")), lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0).cast("long")))
    return Level(bits, seed, cut(row.select("segment", every.alias("words"))))


@dataclass
class Cascade:
    """Exact membership for every key of the universe it was built over; other keys may be taken for listed ones.

    Keys are dealt to segments by hash, and each segment is a cascade of its own.
    """

    levels: list[Level]
    segments: int = 1

    def segment(self, key: Column) -> Column:
        return _segment(key, self.segments)

    def contains(self, key: Column, segment: int = 0) -> Column:
        """Whether a key of ``segment`` is listed; a null key is not."""
        out = F.lit(len(self.levels) % 2 == 1)  # past the last level: of the kind that it holds
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].passes(key, segment), out).otherwise(F.lit(i % 2 == 1))
        return F.when(key.isNull(), F.lit(False)).otherwise(out)

    def mark(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with a column ``name``: whether their ``key`` is listed. Each segment's rows are tested against its own filters."""
        if self.segments == 1:
            return rows.withColumn(name, self.contains(F.col(key)))
        dealt = _by_segment(rows.withColumn("_segment", F.coalesce(self.segment(F.col(key)), F.lit(0))), "_segment")
        parts = [dealt.where(F.col("_segment") == s).drop("_segment").withColumn(name, self.contains(F.col(key), s)) for s in range(self.segments)]
        return functools.reduce(DataFrame.union, parts)


def _segment(key: Column, segments: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("segment"), key), F.lit(segments)).cast("int")


def _by_segment(rows: DataFrame, segment: str) -> DataFrame:
    """``rows`` written in one folder a segment, so that a segment's rows are read alone."""
    return cut(rows, by=segment)


def build(universe: DataFrame, most_bits: int = MOST_BITS) -> Cascade:
    """The cascade over ``universe`` (key: distinct, listed: boolean); no segment's filter takes over ``most_bits``."""
    universe = universe.select("key", "listed")
    n = universe.agg(F.count_if("listed").alias("listed")).first()["listed"]
    segments = max(1, -(-BITS_A_KEY * n // most_bits))
    while (made := _build(universe, segments, most_bits)) is None:
        segments *= 2  # some level of some segment would outgrow the bound
    return made


def _build(universe: DataFrame, segments: int, most_bits: int) -> Cascade | None:
    made = Cascade([], segments)
    dealt = _by_segment(universe.withColumn("segment", made.segment(F.col("key"))), "segment") if segments > 1 else universe.withColumn("segment", F.lit(0))
    ours, others = dealt.where("listed").select("segment", "key"), dealt.where("not listed").select("segment", "key")
    most = lambda rows: (rows.groupBy("segment").count().agg(F.max("count")).first()[0]) or 0
    while n := most(ours):
        bits = max(64, 1 << (BITS_A_KEY * n - 1).bit_length())
        if bits > most_bits and (n > 1 or bits > 64):
            return None
        level = _level(ours, bits, len(made.levels))
        made.levels.append(level)
        passed = [others.where((F.col("segment") == s) & level.passes(F.col("key"), s)) for s in range(segments)]
        ours, others = cut(functools.reduce(DataFrame.union, passed)), ours
    return made


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", most_bits: int = MOST_BITS) -> DataFrame:
    """(id, host, path, rule, verdict) for every row: the longest rule's verdict, else block for a listed key and allow for others.

    The key of a page is host and path; ``listed`` has a column key. Keys that no page has don't matter; repeated and
    null keys are ignored. A null url has an empty key, which can be listed like any other. Repeated rows and ids are
    judged alike, a null id like any other; only the named columns are read; an empty table stays empty. Where a filter
    would outgrow ``most_bits``, keys are dealt to segments with filters of their own, with the same result.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    which, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", "host", "path", F.concat("host", "path").alias("key"), which.alias("rule"), verdict.alias("ruled"))
    marks = rows.select("key", F.lit(True).alias("here"), F.lit(False).alias("listed")).union(listed.where("key is not null").select("key", F.lit(False), F.lit(True)))
    universe = cut(marks.groupBy("key").agg(F.bool_or("here").alias("here"), F.bool_or("listed").alias("listed")).where("here").select("key", "listed"))
    found = build(universe, most_bits).mark(rows, "key", "hit")
    return found.select("id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))
