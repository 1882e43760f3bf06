"""Removal of long byte strings that occur more than once, by threshold-bounded interval expansion on a BWT.

In one block of bytes (``repeated_starts``): the suffixes are sorted, and from the Burrows-Wheeler transform the common
prefix lengths of neighbours are derived in increasing order, by breadth-first backward extension of intervals (Beller,
Gog, Ohlebusch and Schnattinger); it stops at the minimum length, so what has no value yet shares at least that much.

A corpus is cut into such blocks by content. Every window of ``length`` bytes belongs to the smallest of its inner
``gram``-byte hashes, its anchor; windows with equal bytes have equal anchors at equal places. Anchors are counted
first, which leaves windows that can repeat; runs of windows around equal anchors with wholly equal bytes repeat
without further ado, and one of them stands for all. Only the different contexts of one anchor meet in a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut

LENGTH, GRAM = 200, 64
#: Windows of a text that are hashed at once; different contexts of an anchor, and bytes, that one block takes.
CHUNK, BUCKET, BLOCK = 1 << 18, 4096, 1 << 20

_U = np.uint64
_rng = np.random.default_rng(64)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=_U)
_BASE = int(_rng.integers(1, 1 << 62)) * 2 + 1
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64, at least n of them."""
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, 4096), base, dtype=_U)
        factors[0] = 1
        _powers[base] = np.cumprod(factors, dtype=_U)
    return _powers[base]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, last window, hash of the anchor, hash of all the run's bytes."""
    found = []
    for at in range(0, len(raw) - length + 1, CHUNK):
        part = np.frombuffer(raw, dtype=np.uint8, count=min(len(raw) - at, CHUNK + length - 1), offset=at)
        n, inverse = len(part), _power(pow(_BASE, -1, 1 << 64), CHUNK + length)
        sums = np.zeros(n + 1, dtype=_U)
        np.cumsum(_VALUE[part] * _power(_BASE, CHUNK + length)[:n], out=sums[1:])
        hashes = _mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
        low = (hashes & ~_U(0xFFFFFF)) | np.arange(len(hashes), dtype=_U)  # the leftmost of equal hashes is the anchor
        width, have = length - gram + 1, 1
        while have < width:
            step = min(have, width - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        place = (low & _U(0xFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        whole = _mix((sums[last + length] - sums[first]) * inverse[first] + (last - first).astype(_U))
        found.append((first + at, last + at, hashes[place[first]], whole))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols (0 to 511; 0 follows the end), by prefix doubling of the tied ones."""
    n, have = len(symbols), 7
    ext = np.concatenate([symbols.astype(np.int64), np.zeros(have, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for j in range(have):
        key = (key << 9) | ext[j : n + j]
    order = np.argsort(key, kind="stable")
    start = np.concatenate([[True], np.diff(key[order]) != 0])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    while have < depth:
        tied = ~(start & np.concatenate([start[1:], [True]]))
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        here = order[slots]
        after = np.where(here + have < n, rank[np.minimum(here + have, n - 1)] + 1, 0)
        key = rank[here] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        order[slots], key = here[by], key[by]
        start[slots] = np.concatenate([[True], np.diff(key) != 0])
        rank[order[slots]] = np.maximum.accumulate(np.where(start[slots], slots, 0))
        have *= 2
    return order


def prefix_bounds(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``order``: whether its suffix shares fewer than ``length`` symbols with the one before.

    Intervals of suffixes with a common start are extended backwards, breadth first: an interval of l + 1 common symbols
    that ends where no value is set yet sets it to l and is extended in turn.
    """
    n = len(symbols)
    bwt = symbols[order - 1]
    by = np.argsort(bwt, kind="stable")
    back = np.empty(n, dtype=np.int64)  # place of the suffix that is longer by the preceding symbol
    back[by] = np.arange(n)
    known = np.zeros(n + 1, dtype=bool)
    known[[0, n]] = True
    lo, hi = np.array([0]), np.array([n - 1])
    for _ in range(length):
        one = lo == hi
        left, right = [back[lo[one]]], [back[lo[one]]]
        if not one.all():
            a, size = lo[~one], (hi - lo)[~one] + 1
            flat = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            key = np.repeat(np.arange(len(a)), size) * 512 + bwt[flat]
            order_ = np.argsort(key, kind="stable")
            edge = np.concatenate([[True], np.diff(key[order_]) != 0, [True]])
            flat = flat[order_]
            left.append(back[flat[edge[:-1]]])
            right.append(back[flat[edge[1:]]])
        lo, hi = np.concatenate(left), np.concatenate(right)
        new = ~known[hi + 1]
        lo, hi = lo[new], hi[new]
        if not len(lo):
            break
        known[hi + 1] = True
    return known[:n]


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context the starts of its windows of ``length`` bytes that occur at another place in some context."""
    symbols = np.concatenate([x for c in contexts for x in (np.frombuffer(c, dtype=np.uint8).astype(np.int16) + 1, [0])]).astype(np.int16)
    sizes = np.array([len(c) + 1 for c in contexts])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    own = np.repeat(np.arange(len(contexts)), sizes)
    place = np.arange(len(symbols)) - begins[own]
    window = place + length < sizes[own]
    order = suffix_order(symbols, length)
    group = np.cumsum(prefix_bounds(symbols, order, length))
    often = np.bincount(group, weights=window[order]) > 1
    again = np.zeros(len(symbols), dtype=bool)
    again[order] = often[group]
    again &= window
    return [np.flatnonzero(again[a : b - 1]) for a, b in zip(begins, begins[1:])]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive numbers as (first, last)."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate([[0], cuts + 1])].tolist(), starts[np.concatenate([cuts, [len(starts) - 1]])].tolist()))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(id, text, spans) for every row: the text as given and its repeated bytes as (start, end) runs, merged and in order.

    A byte is repeated if a string of ``length`` bytes around it also starts anywhere else, in the same text or another.
    Null texts are empty and stay null. Repeated rows repeat each other, with or without an id: texts are told apart by
    id and checksum (rows without an id: by a 64-bit hash). Only the named columns are read.
    """
    kind = docs.schema[id_col].dataType
    text = F.col(text_col).cast("string")
    tag = F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(F.crc32(F.encode(text, "utf-8")))
    docs = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(tag, F.lit(0)).cast("long").alias("tag"))
    who = [T.StructField("id", kind), T.StructField("tag", T.LongType())]
    longs = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    ints = lambda *names: [T.StructField(n, T.IntegerType()) for n in names]
    schema = T.StructType([*who, *ints("first", "last"), *longs("h", "c")])

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                rows = [anchors((t.as_py() or "").encode(), length, gram) for t in part.column(1)]
                at = pa.array(np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]))
                columns = [np.concatenate(x) for x in zip(*rows)]
                arrays = [part.column(0).take(at), part.column(2).take(at), *(pa.array(x.astype(np.int32)) for x in columns[:2]), *(pa.array(x.astype(_U).view(np.int64)) for x in columns[2:])]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    seen = cut(docs.mapInArrow(anchor, schema))
    # written before it is joined, so that the join's shuffle on a hot anchor is one that adaptive execution can split
    twice = cut(seen.groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).where("n > 1").select("h", (F.col("low") != F.col("high")).alias("mixed")))
    hits = cut(seen.join(twice, "h"))
    mixed = hits.where("mixed")
    kinds = mixed.groupBy("h", "c").agg(F.count("*").alias("n"), F.min(F.struct("id", "tag", "first", "last")).alias("at"))
    kinds = cut(kinds)
    sizes = cut(kinds.groupBy("h").agg(F.count("*").alias("contexts")))
    kinds = kinds.join(sizes, "h").select("h", (F.col("n") == 1).alias("single"), (F.col("contexts") > bucket).alias("hot"), "at.*")
    spans = hits.where("not mixed").select("id", "tag", "first", "last")
    spans = spans.union(mixed.join(cut(mixed.groupBy("h", "c").count().where("count > 1").select("h", "c")), ["h", "c"]).select("id", "tag", "first", "last"))

    wanted = kinds.groupBy("id", "tag").agg(F.collect_list(F.struct("h", "single", "hot", "first", "last")).alias("wanted"))
    same = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["tag"] == b["tag"])
    near = docs.join(wanted, same(docs, wanted)).select(docs["id"], docs["tag"], docs["text"], "wanted")
    schema_c = T.StructType([*who, *ints("first"), *longs("h"), T.StructField("single", T.BooleanType()), T.StructField("hot", T.BooleanType()), T.StructField("bytes", T.BinaryType())])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                at, first, h, single, hot, data = [], [], [], [], [], []
                for i, (t, ws) in enumerate(zip(part.column(2), part.column(3))):
                    raw = (t.as_py() or "").encode()
                    for w in ws.as_py():
                        at.append(i)
                        first.append(w["first"])
                        h.append(w["h"])
                        single.append(w["single"])
                        hot.append(w["hot"])
                        data.append(raw[w["first"] : w["last"] + length])
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(first, pa.int32()), pa.array(h, pa.int64()), pa.array(single, pa.bool_()), pa.array(hot, pa.bool_()), pa.array(data, pa.binary())], names=schema_c.names)

    near = cut(near.mapInArrow(contexts, schema_c))  # texts are looked into once; the contexts are read for two ends
    schema_s = T.StructType([*who, *ints("first", "last")])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole anchors, as they come in order, up to about ``BLOCK`` bytes at a time."""
        rows: list[tuple] = []

        def done() -> pa.RecordBatch:
            out = [(r[0], r[1], r[2] + a, r[2] + z) for r, s in zip(rows, repeated_starts([r[5] for r in rows], length)) if r[4] for a, z in _runs(s)]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 4, types)], names=schema_s.names)

        types, held = None, 0
        for b in batches:
            types = types or [b.schema.field(0).type, pa.int64(), pa.int32(), pa.int32()]
            for k in range(0, b.num_rows, 4096):
                for r in zip(*(c.to_pylist() for c in b.slice(k, 4096).columns)):
                    if held > BLOCK and r[3] != rows[-1][3]:
                        yield done()
                        rows, held = [], 0
                    rows.append(r)
                    held += len(r[5])
        if rows:
            yield done()

    finer = (gram + length) // 2
    schema_f = T.StructType([*who, *ints("first"), *longs("h", "c"), T.StructField("single", T.BooleanType()), T.StructField("bytes", T.BinaryType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts cut anew around anchors of ``finer`` bytes, which fewer of them share."""
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part, at, rest = b.slice(k, 256), [], []
                for i, (f, data) in enumerate(zip(part.column(2).to_pylist(), part.column(6).to_pylist())):
                    for a, z, h, c in zip(*anchors(data, length, finer)):
                        at.append(i)
                        rest.append((f + int(a), int(np.uint64(h).view(np.int64)), int(np.uint64(c).view(np.int64)), data[a : z + length]))
                first, h, c, data = zip(*rest) if rest else ([],) * 4
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(first, pa.int32()), pa.array(h, pa.int64()), pa.array(c, pa.int64()), part.column(4).take(at), pa.array(data, pa.binary())], names=schema_f.names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                rows = [(h, f, c, len(c) - length + 1) for h, f, c in zip(*(part.column(i).to_pylist() for i in (3, 2, 5)))]
                at = pa.array([i for i, r in enumerate(rows) for _ in range(r[3])], pa.int64())
                first = [f + j for _, f, _, n in rows for j in range(n)]
                w = [xxhash.xxh3_64_intdigest(c[j : j + length], seed=h + (1 << 63)) - (1 << 63) for h, _, c, n in rows for j in range(n)]
                yield pa.RecordBatch.from_arrays([part.column(i).take(at) for i in (0, 1, 4)] + [pa.array(first, pa.int32()), pa.array(w, pa.int64())], names=["id", "tag", "single", "first", "w"])

    def in_blocks(rows: DataFrame) -> DataFrame:
        rows = rows.select("id", "tag", "first", "h", "single", "bytes").repartition("h").sortWithinPartitions("h")
        return rows.mapInArrow(blocks, schema_s)

    # Contexts of an anchor that has too many for a block are cut anew around finer anchors, counted, and met again. What
    # even then has too many is counted window by window. Counts by anchor are added up before they are joined, and what
    # they are joined to is written first, so that the contexts of a hot anchor needn't meet in one task.
    last = (F.col("first") + F.octet_length("bytes") - length).alias("last")
    fine = cut(near.where("hot").mapInArrow(split, schema_f).withColumn("n", F.when(F.col("single"), 1).otherwise(2)))
    met = cut(fine.groupBy("h", "c").agg(F.sum("n").alias("in_c"), F.min(F.struct("id", "tag", "first", "bytes")).alias("at")))
    spans = spans.union(fine.where("single").join(cut(met.where("in_c > 1").select("h", "c")), ["h", "c"]).select("id", "tag", "first", last))
    sizes = cut(met.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1"))
    met = met.join(sizes, "h").select("at.id", "at.tag", "at.first", "h", (F.col("in_c") == 1).alias("single"), "at.bytes", (F.col("contexts") > bucket).alias("hot"))
    spans = spans.union(in_blocks(near.where("not hot"))).union(in_blocks(met.where("not hot")))
    each = met.where("hot").select("id", "tag", "first", "h", "single", "bytes").mapInArrow(windows, T.StructType([*who, T.StructField("single", T.BooleanType()), *ints("first"), *longs("w")]))
    often = each.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    spans = spans.union(each.where("single").join(often, "w").select("id", "tag", "first", F.col("first").alias("last")))

    merged = spans.groupBy("id", "tag").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    rows = docs.join(merged, same(docs, merged), "left").select(docs["id"], docs["text"], "found")
    sorted_ = F.array_sort(F.coalesce("found", F.array().cast("array<struct<first:int,last:int>>")))
    return rows.select("id", "text", sorted_.alias("found"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(id, n_bytes, spans, kept) for every row: removed byte runs (start, end) and the remaining bytes; see ``repeated``."""
    rows = repeated(docs, id_col, text_col, length, gram, bucket)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                sizes, spans, kept = [], [], []
                for t, found in zip(part.column(1), part.column(2)):
                    raw, own = (t.as_py() or "").encode(), []
                    for f in found.as_py():  # in order of their first window
                        if own and f["first"] <= own[-1]["end"]:
                            own[-1]["end"] = max(own[-1]["end"], f["last"] + length)
                        else:
                            own.append({"start": f["first"], "end": f["last"] + length})
                    edges = [0, *(x for s in own for x in (s["start"], s["end"])), len(raw)]
                    sizes.append(len(raw))
                    spans.append(own)
                    kept.append(b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, arrow), pa.array(kept, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)
