"""Sharding by a k-d tree over document metadata.

The tree is built for all nodes of a level at once: a node that stands for several shards is split along its widest
metadata dimension at the weighted median (more exactly at the share of its bytes that its left shards are to take),
found by distributed histograms that are refined around the cut. Only histograms of a fixed number of bins come to the
driver; the tree is then an expression over the dimensions, so no row is moved while it grows.

Dimensions are ordered: a string stands at the middle of the bytes of its value when the values are put in order, so
that a node's width along it is the share of all bytes that its values span; sizes and word lengths by their logarithm.

Documents with equal texts share one point, so they stay in one shard. Groups of equal texts (and single documents) that
hold more than ``hot`` of a shard's bytes, of which there are less than shards / hot, would upset a cut: they are put
into the shards first, whole, and the tree deals out the rest. A group that no shard could hold is dealt out by document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import cut, ranked

#: Bytes that a document takes beside its text.
ROW_BYTES = 16
BINS, SPAN_BITS, TIE_BITS = 2048, 20, 31
#: Rows of a table that is broadcast at most; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000


@dataclass
class Node:
    first: int
    room: list[float]  # bytes that each of its shards is to take
    dim: str | None = None
    at: int = 0  # coordinates below go left
    left: Node | None = None
    right: Node | None = None

    @property
    def shards(self) -> int:
        return len(self.room)


def _choose(node: Node, leaf) -> Column:
    if node.dim is None:
        return F.lit(leaf(node))
    return F.when(F.col(node.dim) < node.at, _choose(node.left, leaf)).otherwise(_choose(node.right, leaf))


def build(points: DataFrame, room: list[float], dims: list[str], weight: str = "size", tolerance: float = 0.002) -> Node:
    """The tree over ``points`` whose leaves take weights in proportion to ``room``.

    Each of ``dims`` is a column of longs, the value of a dimension above ``TIE_BITS`` bits of the point's tie-break: it
    orders points along the dimension and has few ties. A cut is refined until its bin holds ``tolerance`` of a shard's
    weight or points of one coordinate.
    """
    shards = len(room)
    extents = [f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))]
    all_ = points.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("w"), *extents).first()
    width = lambda r, d: (r[f"hi_{d}"] >> TIE_BITS) - (r[f"lo_{d}"] >> TIE_BITS) if r and r[f"lo_{d}"] is not None else 0
    fine = tolerance * float(all_["w"]) / shards
    root = Node(0, room)
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        index = {id(n): i for i, n in enumerate(level)}
        held = points.withColumn("node", _choose(root, lambda n: index.get(id(n), -1))).where("node >= 0")
        found = {r["node"]: r for r in held.groupBy("node").agg(F.sum(weight).alias("w"), *extents).collect()} if len(level) > 1 else {0: all_}
        cuts = []
        for i, n in enumerate(level):
            r = found.get(i)
            d = max(range(len(dims)), key=lambda k: width(r, dims[k]) / max(1, width(all_, dims[k])))
            some = r is not None and r[f"lo_{dims[d]}"] is not None
            lo, hi = (r[f"lo_{dims[d]}"], r[f"hi_{dims[d]}"] + 1) if some else (0, 1)
            cuts.append({"dim": d, "lo": lo, "hi": hi, "below": 0.0, "goal": float(r["w"]) * _left_share(n) if some else 0.0, "open": some})
        while any(c["open"] for c in cuts):
            at = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("node") + 1)
            x = F.element_at(F.array(*dims), at([c["dim"] + 1 for c in cuts])).alias("x")
            lo, hi = at([c["lo"] if c["open"] else 1 for c in cuts]).cast("long"), at([c["hi"] if c["open"] else 0 for c in cuts]).cast("long")
            step = at([max(1, -(-(c["hi"] - c["lo"]) // BINS)) for c in cuts]).cast("long")
            near = held.select("node", weight, x, lo.alias("lo"), hi.alias("hi"), step.alias("step")).where("x >= lo and x < hi")
            bins = near.groupBy("node", F.expr("(x - lo) div step").alias("bin")).agg(F.sum(weight).alias("w"), F.min("x").alias("least"), F.max("x").alias("most")).collect()
            by: dict[int, list] = {}
            for b in sorted(bins, key=lambda b: b["bin"]):
                by.setdefault(b["node"], []).append(b)
            for i, c in enumerate(cuts):
                if not c["open"]:
                    continue
                c["open"] = False
                for b in by.get(i, []):
                    w = float(b["w"])
                    if c["below"] + w >= c["goal"]:  # the cut lies in this bin
                        if b["least"] == b["most"] or w <= fine:
                            c["lo"] = b["least"] if c["goal"] - c["below"] < c["below"] + w - c["goal"] else b["most"] + 1
                        else:
                            c |= {"lo": b["least"], "hi": b["most"] + 1, "open": True}
                        break
                    c["below"] += w
        for n, c in zip(level, cuts):
            half = n.shards // 2
            n.dim, n.at = dims[c["dim"]], c["lo"]
            n.left, n.right = Node(n.first, n.room[:half]), Node(n.first + half, n.room[half:])
        level = [x for n in level for x in (n.left, n.right)]
    return root


def _left_share(n: Node) -> float:
    half = n.shards // 2
    return sum(n.room[:half]) / whole if (whole := sum(n.room)) > 0 else half / n.shards


def ordered_codes(values: DataFrame, value: str, weight: str) -> DataFrame:
    """(value, code) for each row of ``values`` (value: distinct, weight): the middle of its weight among all in order, over 2^``SPAN_BITS``.

    A running total over range partitions: each adds up its own rows, and the totals of those before it are added.
    """
    parts = cut(values.repartitionByRange(value).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as partitions
    starts = parts.groupBy("part").agg(F.sum(weight).alias("w")).withColumn("start", F.coalesce(F.sum("w").over(before), F.lit(0)))
    total = F.sum("w").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = cut(starts.withColumn("total", total).drop("w"))
    own = Window.partitionBy("part").orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum(weight).over(own), F.lit(0)) + F.col(weight) / 2
    ranked_ = parts.join(F.broadcast(starts), "part")
    return ranked_.select(value, F.floor(middle / F.col("total") * ((1 << SPAN_BITS) - 1)).cast("int").alias("code"))


def place_whole(weights: list[int], shards: int, goal: float) -> tuple[list[int], list[float]]:
    """A shard for each of ``weights``, the heaviest first into the emptiest, and the room that is left in each."""
    room, where = [goal] * shards, [0] * len(weights)
    for k in sorted(range(len(weights)), key=lambda k: (-weights[k], k)):
        where[k] = max(range(shards), key=lambda s: room[s])
        room[where[k]] -= weights[k]
    return where, [max(0.0, r) for r in room]


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", dims: tuple[str, ...] = ("source", "lang"), hot: float = 0.1, per_task: int = 1_000_000) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; shards hold nearly equal bytes, slots count from 0 in each.

    Dimensions are ``dims`` (null is a value of its own; copies of a text take their group's least), the size, and the
    bytes between blanks. A null text has no bytes. Repeated rows, also of null ids, are rows of their own with slots of
    their own. Of an empty table nothing comes. Only the named columns are read.
    """
    text = F.col(text_col).cast("string")
    bytes_ = F.coalesce(F.octet_length(text), F.lit(0))
    word = bytes_ / (bytes_ - F.coalesce(F.octet_length(F.replace(text, F.lit(" "), F.lit(""))), F.lit(0)) + 1)
    fine = lambda x: F.floor(F.log2(x + 1) * (1 << (SPAN_BITS - 6))).cast("int")
    names, one = [f"d{i}" for i in range(len(dims))], ["text_crc32", "text_hash", "size"]
    read = cut(docs.select(
        F.col(id_col).alias("id"), (bytes_ + ROW_BYTES).cast("long").alias("size"), F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8")).alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), fine(word).alias("word"), *(F.col(d).cast("string").alias(n) for d, n in zip(dims, names)),
        F.monotonically_increasing_id().alias("row"),
    ))
    few = read.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    goal = few["bytes"] / shards
    # written before they are joined, so that the join on a hot group is a plain shuffle that adaptive execution can split
    groups = cut(read.groupBy(*one).agg(F.count("*").alias("copies"), *(F.min(n).alias(f"least_{n}") for n in names)).where((F.col("copies") > 1) | (F.col("size") > hot * goal)))
    held = F.col("copies") * F.col("size")
    heavy = groups.where((held > hot * goal) & (held <= goal)).select(*one, held.alias("held")).orderBy(*one).collect()  # fewer than shards / hot
    where, room = place_whole([r["held"] for r in heavy], shards, goal)
    set_ = F.lit(None).cast("int")
    if heavy:
        fixed = read.sparkSession.createDataFrame([(*r[:3], s) for r, s in zip(heavy, where)], "text_crc32 long, text_hash long, size long, fixed int")
        groups, set_ = groups.join(F.broadcast(fixed), one, "left"), F.col("fixed")
    groups = cut(groups.select(*one, "copies", *(f"least_{n}" for n in names), set_.alias("fixed")))
    small = groups.count() <= BROADCAST_ROWS
    points = read.join(F.broadcast(groups) if small else groups, one, "left")
    split = F.coalesce(held > goal, F.lit(False)) & (F.col("copies") > 1)  # no shard holds such a group
    tie = F.shiftrightunsigned(F.when(split, F.xxhash64("text_hash", "row")).otherwise(F.xxhash64("text_hash", "text_crc32")), 64 - TIE_BITS)
    own = lambda n: F.when(F.col("copies") > 1, F.col(f"least_{n}")).otherwise(F.col(n)).alias(n)
    points = cut(points.select("id", "row", "size", "text_crc32", "word", "fixed", tie.alias("tie"), *map(own, names)))
    for n in names:
        codes = cut(ordered_codes(points.where("fixed is null").groupBy(n).agg(F.sum("size").alias("w")), n, "w").withColumnRenamed(n, "_value"))
        codes = F.broadcast(codes) if codes.count() <= BROADCAST_ROWS else codes
        points = points.join(codes, F.col(n).eqNullSafe(F.col("_value")), "left").withColumn(n, F.coalesce("code", F.lit(0))).drop("_value", "code")
    order = lambda value: F.shiftleft(value.cast("long"), TIE_BITS) + F.col("tie")
    every = [*names, "d_size", "d_word"]
    points = cut(points.withColumn("d_size", fine(F.col("size"))).withColumnRenamed("word", "d_word").select("id", "row", "size", "text_crc32", "fixed", *(order(F.col(n)).alias(n) for n in every)))
    tree = build(points.where("fixed is null"), room, every)
    placed = points.withColumn("shard", F.coalesce("fixed", _choose(tree, lambda n: n.first)))
    return ranked(placed, "shard", ["id", "row"], "slot", few["rows"], per_task).select("id", "size", "text_crc32", "shard", "slot")
