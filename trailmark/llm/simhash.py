"""SimHash near-duplicate classes by covering locality-sensitive hashing.

A covering family of bit masks (Pagh, "Locality-sensitive hashing without false negatives") guarantees that any two
fingerprints at ``radius`` or fewer differing bits agree on all bits of at least one mask: each bit i gets a non-zero
vector m(i) of radius + 1 bits, mask v (non-zero) holds the bits with odd <m(i), v>, and some v is orthogonal to the
vectors of the differing bits. So no link is lost, and a bucket holds fingerprints that agree on about half their bits.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import components, cut

BITS = 64
#: Largest number of distinct fingerprints that one task compares with each other.
BUCKET = 1024


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit number; 0 for a text without words."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z are lowered and only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :])], dtype="<u8")
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as a signed number; 0 for none."""
    total = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 65536):
        total += np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) for every row of ``docs``; null and empty texts get 0."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def masks(radius: int, seed: int) -> list[int]:
    """The 2^(radius+1) - 1 covering masks, as signed 64-bit numbers; bits share the vectors evenly."""
    size = 2 ** (radius + 1) - 1
    vectors = [1 + i % size for i in range(BITS)]
    random.Random(seed).shuffle(vectors)
    found = [sum(1 << i for i in range(BITS) if (vectors[i] & v).bit_count() & 1) for v in range(1, size + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def _spanning(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """For each list of distinct fingerprints: links (smallest of its component, fingerprint) within the list."""
    for batch in batches:
        a, b = [], []
        for listed in batch.column(0):
            rest = np.sort(np.array(listed.as_py(), dtype=np.int64))
            while len(rest):
                root, front, rest = rest[0], rest[:1], rest[1:]
                while len(front) and len(rest):
                    near = np.zeros(len(rest), dtype=bool)
                    for f in front:
                        near |= np.bitwise_count((rest ^ f).view(np.uint64)) <= radius
                    front, rest = rest[near], rest[~near]
                    a += [int(root)] * len(front)
                    b += front.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET, buckets: list[DataFrame] | None = None) -> DataFrame:
    """(a, b) links whose components are those of all pairs of ``fps`` (fp: distinct longs) within ``radius`` bits.

    Buckets of two are compared in place, small ones by one task each. A bucket of more than ``bucket`` fingerprints is
    not compared: each of its fingerprints goes to the buckets of another covering family on the bits still free, which
    keeps every close pair together in one of them. Free bits halve each time and k free bits leave 2^k fingerprints at
    most, so the largest list is bounded whatever the data hold.

    To ``buckets`` the compared buckets (mask, key, fp) are added, in one of which at least each close pair lies: links
    span components only, and who asks more of a pair than ``radius`` has to look at the pairs themselves.
    """
    rows, out, level = fps.select("fp", F.lit(0).cast("long").alias("mask")), [], 0
    floor = max(3, bucket.bit_length() - 1)  # up to 3 free bits may stay free for good
    while True:
        family = [F.col("mask").bitwiseOR(F.lit(m)) for m in masks(radius, seed=level)]
        rows = rows.select("fp", F.explode(F.array_distinct(F.array(*family))).alias("mask")).distinct() if level else rows.select("fp", F.explode(F.array(*family)).alias("mask"))
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        full = cut(rows.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
        out.append(full.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b"))
        hot = (F.col("n") > bucket) & (F.bit_count("mask") < BITS - floor)
        dealt = cut(rows.join(full.where("n > 2" if buckets is None else "n > 1").select("mask", "key", (F.col("n") > 2).alias("listed"), hot.alias("hot")), ["mask", "key"]))
        if buckets is not None:
            buckets.append(dealt.where("not hot").select("mask", "key", "fp"))
        lists = dealt.where("listed and not hot").groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        out.append(lists.mapInArrow(lambda it: _spanning(it, radius), "a long, b long"))
        if full.where(hot).isEmpty():
            break
        rows, level = dealt.where("hot").select("fp", "mask"), level + 1
    every = out[0]
    for x in out[1:]:
        every = every.union(x)
    return every


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """One row (id, fp, component) for each row of ``docs``; component: the smallest id that close fingerprints reach.

    Null and empty texts have fingerprint 0 and are linked like others. Rows are never merged: repeated rows come back
    as often, ties share a component. Null ids take part, and a component without any id has a null one. Columns of
    ``docs`` other than the two named are ignored; an empty table gives an empty result.
    """
    marked = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(marked.groupBy("fp").agg(F.min("id").alias("first")))
    linked = components(links(classes.select("fp"), radius, bucket))
    roots = classes.join(linked, classes.fp == linked.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component"))
    return marked.join(roots.join(least, "root").select("fp", "component"), "fp").select("id", "fp", "component")


#: Thinned classes of a text's shingles: about so many shingles in each, so many classes; hashes in a sketch; seeds.
PER_CLASS, CLASSES, SKETCH = 5, 16, 192
#: Pairs whose sketches are that near to the limit (four deviations) are compared by their whole sets.
NEAR = 0.12
#: Rows of a group that are compared with each other by one task.
BLOCK = 256


def _scramble(h: np.ndarray, seed: int) -> np.ndarray:
    x = (h ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def shingle_facts(text: str | None, shingle: int) -> tuple[int, int, list[int], bytes]:
    """SimHash, hash of the set of shingles, keys of thinned classes, and a bottom-k sketch of a text.

    The shingles are dealt into K classes by hash, K a power of two near their number over ``PER_CLASS``; of ``CLASSES``
    classes (of several dealings, where there are fewer) the sets are hashed to keys. Two texts at a similarity of 0.8
    share the set of a class with a probability of about 0.29, so they miss all sixteen in 1 of 200 cases, and at 0.85 in
    1 of 5,000. Around a change of K both values are used, so that similar texts share one.
    """
    words = (text or "").encode().lower().split()
    joined = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    each = np.array([xxhash.xxh64_intdigest(s, 42) for s in joined], dtype=np.uint64)
    fp = _majority(each)
    h = np.unique(each)
    n = len(h)
    whole = int(_scramble(h, 1).sum(dtype=np.uint64).view(np.int64)) if n else 0
    keys = set()
    for level in {max(0, round(np.log2(max(1.0, n * f / PER_CLASS)))) for f in (0.89, 1.12)} if n else ():
        k = 1 << int(level)
        for deal in range(-(-CLASSES // k)):
            x = _scramble(h, 2 + deal)
            of = (x % np.uint64(k)).astype(np.int64)
            for c in range(min(k, CLASSES)):
                own = x[of == c]
                if len(own):
                    keys.add(xxhash.xxh3_64_intdigest(np.array([level, deal, c, int(_scramble(own, 99).sum(dtype=np.uint64).view(np.int64))], dtype=np.int64).tobytes()) - (1 << 63))
    return fp, whole, sorted(keys), np.sort(_scramble(h, 7) >> np.uint64(32))[:SKETCH].astype("<u4").tobytes()


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two shingle sets from their sketches: exact where they have up to ``SKETCH`` shingles together."""
    return _similarity(a, b)[0]


def _similarity(a: bytes, b: bytes) -> tuple[float, bool]:
    """``similarity`` and whether it is exact."""
    x, y = np.frombuffer(a, dtype="<u4"), np.frombuffer(b, dtype="<u4")
    union = np.union1d(x, y)
    exact, union = len(union) <= SKETCH and len(x) < SKETCH and len(y) < SKETCH, union[:SKETCH]
    return (float(np.isin(union, np.intersect1d(x, y)).sum() / len(union)) if len(union) else 1.0), exact


def shingle_set(text: str | None, shingle: int) -> bytes:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    words = (text or "").encode().lower().split()
    joined = {b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else ()
    return np.sort(np.array([xxhash.xxh64_intdigest(s, 42) for s in joined], dtype="<u8")).tobytes()


def _overlap(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (len(x) + len(y) - common) if len(x) or len(y) else 1.0


def _joined(table: pa.Table, least: float) -> pa.Table:
    """Links (a, b) between components that the rows of one task (node, root, own, _sketch) join: every pair counts.

    Pairs of one component, and of one side where the task stands for two blocks, need no look. Of the others those are
    compared whose common hashes would be enough, which is never fewer than the comparison itself counts.
    """
    roots, own = table.column("root").to_numpy(), table.column("own").to_numpy()
    sketches = [x.as_py() for x in table.column("_sketch")]
    values = [np.unique(np.frombuffer(x, dtype="<u4")) for x in sketches]
    size = np.array([len(v) for v in values])
    _, which, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    row, often = np.repeat(np.arange(len(values)), size), times > 1
    at = (np.cumsum(often) - 1)[which]
    common = np.zeros((len(values), len(values)), dtype=np.float32)
    for k in range(0, int(often.sum()), 4096):
        held = np.zeros((len(values), 4096), dtype=np.float32)
        here = often[which] & (at >= k) & (at < k + 4096)
        held[row[here], at[here] - k] = 1
        common += held @ held.T
    union = np.minimum(SKETCH, size[:, None] + size[None, :] - common)
    may = np.triu(common >= least * union - 1e-3, 1) & (roots[:, None] != roots[None, :])
    if (own != own[0]).any():
        may &= own[:, None] != own[None, :]
    parent: dict[int, int] = {}

    def top(i: int) -> int:
        while (up := parent.get(i, i)) != i:
            i = up
        return i

    a, b = [], []
    for i, j in zip(*np.nonzero(may)):
        x, y = top(int(roots[i])), top(int(roots[j]))
        if x != y and similarity(sketches[i], sketches[j]) >= least:
            parent[max(x, y)] = min(x, y)
            a.append(max(x, y))
            b.append(min(x, y))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def join_groups(groups: DataFrame, sketches: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(a, b) links between the roots of ``groups`` (group, node, root) such that each similar pair of a group has one component.

    A group of more than ``block`` rows is dealt into blocks, and each two of them are compared by one task: nothing of
    a group is left out, and no task holds more than about two blocks.
    """
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = groups.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("node", "group"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = dealt.select("group", "node", "root", "own", other).select("group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "root", "own")
    full = pairs.join(sketches, "node").select("group", "low", "high", "node", "root", "own", "_sketch")
    return full.groupBy("group", "low", "high").applyInArrow(lambda t: _joined(t, least), "a long, b long").distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 3, least: float = 0.8, bucket: int = BUCKET) -> DataFrame:
    """One row of ``docs`` for each class of near-duplicates, with all its columns: that of the smallest id.

    Linked are texts with a similarity of ``least`` or more of their sets of shingles. Candidates are texts whose SimHash
    differs in ``radius`` bits at most (whatever links join, every pair that is still apart is compared too), and, as
    SimHash alone finds few of the pairs that are asked for (at a similarity of 0.8 some ten bits differ), texts that
    share the set of a thinned class of shingles: each with the first and the last text of that class and, where these
    don't join the class, with every text that is still apart. The former are compared by their sketches and, near the
    limit, by their whole sets; the latter by their sketches. Equal sets are one text from the start, whatever their
    fingerprints.

    Null ids come last; a tie is decided by position. Null and empty texts and those without words are one class.
    Repeated rows are copies of each other. Columns may have any names. An empty table stays empty.
    """
    names, kinds = docs.columns, docs.schema
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))  # whatever the columns are called
    id_col, text_col = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    added = [T.StructField("_fp", T.LongType()), T.StructField("_set", T.LongType()), T.StructField("_keys", T.ArrayType(T.LongType())), T.StructField("_sketch", T.BinaryType()), T.StructField("_at", T.LongType())]
    at = docs.columns.index(text_col)
    plain = docs.withColumn("_at", F.monotonically_increasing_id())
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            facts = list(zip(*(shingle_facts(t.as_py(), shingle) for t in b.column(at)))) or [()] * 4
            more = [pa.array(x, t) for x, t in zip(facts, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *more, b.column(b.num_columns - 1)], names=schema.names)

    base = cut(plain.mapInArrow(run, schema))  # written with its numbering, which a recomputation could change
    order = F.struct(F.col(id_col).isNull().alias("blank"), F.col(id_col).alias("id"), "_at")
    texts = cut(base.groupBy("_set").agg(F.min(order).alias("first"), F.first("_keys").alias("keys")).withColumn("node", F.col("first._at")))
    marks = cut(base.select("_set", "_fp").distinct().join(texts.select("_set", "node"), "_set").select("node", "_fp"))  # repeats count in a fingerprint, so a set may have several
    by_fp = marks.groupBy("_fp").agg(F.min("node").alias("head"))
    buckets: list[DataFrame] = []
    equal = marks.join(by_fp, "_fp").select(F.col("node").alias("a"), F.col("head").alias("b"))
    close = links(by_fp.select(F.col("_fp").alias("fp")), radius, bucket, buckets)
    heads = lambda name: by_fp.select(F.col("_fp").alias(name), F.col("head").alias(f"{name}_head"))
    close = close.join(heads("a"), "a").join(heads("b"), "b").select(F.col("a_head").alias("a"), F.col("b_head").alias("b"))

    keyed = texts.select("node", F.explode("keys").alias("key"))
    shared = cut(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).where("n > 1").drop("n"))
    met = keyed.join(shared, "key").select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b"))
    met = met.union(equal).union(close).where("a <> b")
    met = cut(met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sketches = cut(base.select(F.col("_at").alias("node"), "_sketch").join(met.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"))
    of = lambda name: sketches.select(F.col("node").alias(name), F.col("_sketch").alias(f"s_{name}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that are similar enough by their sketches (sure), or so near to the limit that the sketches can't tell."""
        for b in batches:
            found = [_similarity(x.as_py(), y.as_py()) for x, y in zip(b.column(2), b.column(3))]
            sure = [v >= (least if exact else least + NEAR) for v, exact in found]
            near = [not exact and abs(v - least) < NEAR for v, exact in found]
            keep = pa.array([s or n for s, n in zip(sure, near)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sure, pa.bool_())], names=["a", "b", "sure"]).filter(keep)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t.as_py(), shingle) for t in part.column(1)], pa.binary())], names=["node", "held"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.select([0, 1]).filter(pa.array([_overlap(x.as_py(), y.as_py()) >= least for x, y in zip(b.column(2), b.column(3))], pa.bool_()))

    rough = cut(met.join(of("a"), "a").join(of("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(compare, "a long, b long, sure boolean"))
    unsure = rough.where("not sure").select("a", "b")
    few = base.select(F.col("_at").alias("node"), text_col).join(unsure.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    sets = cut(few.mapInArrow(whole, "node long, held binary"))
    held = lambda name: sets.select(F.col("node").alias(name), F.col("held").alias(f"h_{name}"))
    alike = rough.where("sure").select("a", "b").union(unsure.join(held("a"), "a").join(held("b"), "b").select("a", "b", "h_a", "h_b").mapInArrow(decide, "a long, b long"))
    roots = cut(texts.select("node").join(components(alike), "node", "left").select("node", F.coalesce("root", "node").alias("root")))

    # classes, fingerprints and buckets of close ones whose links so far did not join all: every pair that is still apart
    members = keyed.select("node", F.col("key").alias("group")).join(roots, "node")
    apart = members.groupBy("group").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("n > 3 and low <> high")
    groups = members.join(apart.select("group"), "group").select("group", "node", "root")
    found = marks.join(roots, "node")
    of_fp = cut(found.groupBy("_fp").agg(F.min("root").alias("low"), F.max("root").alias("high")))
    own = F.xxhash64(F.lit("fp"), "_fp").alias("group")
    groups = groups.union(found.join(of_fp.where("low <> high").select("_fp"), "_fp").select(own, "node", "root"))
    for level, x in enumerate(buckets):
        x = x.select(F.xxhash64(F.lit(level), "mask", "key").alias("group"), F.col("fp").alias("_fp"))
        apart = x.join(of_fp, "_fp").groupBy("group").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
        groups = groups.union(x.join(apart.select("group"), "group").join(found, "_fp").select("group", "node", "root"))
    groups = cut(groups)
    if not groups.isEmpty():
        every = base.select(F.col("_at").alias("node"), "_sketch")
        sketches = cut(every.join(groups.select("node").distinct(), "node", "left_semi"))
        merged = components(join_groups(groups, sketches, least)).select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = roots.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    classes = texts.join(roots, "node").groupBy("root").agg(F.min("first").alias("first"))
    kept = cut(classes.select(F.col("first._at").alias("_at")))
    # a merge join at any size, as what is kept grows with the table
    return base.join(kept.hint("merge"), "_at", "left_semi").select(*(F.col(f"c{i}").alias(f.name, metadata=f.metadata) for i, f in enumerate(kinds.fields)))
