"""Nearest neighbours by largest inner product: collision counting over sorted projections.

Vectors are put on the unit sphere: a stored vector x becomes (x / M, sqrt(1 - |x|^2 / M^2)), a query q becomes
(q / |q|, 0), so that the nearest point is the one of the largest inner product. M is the upper edge of the band of
lengths that x lies in: with one M for all, short vectors would differ from queries in the last coordinate alone. A band
with M |q| below what a query has found can't better it and is left out. Each block of vectors
holds ``PROJECTIONS`` arrays of its points' projections on random lines, sorted. A query opens a window around its own
projection in each array; windows grow with the radius (virtual rehashing). A point that lies in at least ``threshold()`` windows is verified by its exact inner product. A point within
the radius lies in a window with the known probability of a Gaussian, so the binomial tail bounds what is missed by
``MISS`` at the radius itself, and by less inside it. A query stops once it has verified enough points within the radius.

Equal vectors are one point with the ids of its first members, so copies cost nothing and never crowd a block. Blocks are
cells of a band around sampled pivots, dealt further by hash where a cell is large. Each query searches its own block
first, then the blocks that follow in rounds, each ``WIDER`` times as many as before. Its worst kept score sets the radius
of the next round, so each round gains a few lists a query; blocks of cells whose ranges of projections the windows meet too
seldom to reach the threshold are left out.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import cut

PROJECTIONS, HALF_WIDTH, MISS = 48, 1.0, 0.02
#: Points a block, queries a task, cells, queries searched at once, growth of a round; they bound memory, not results.
BLOCK, QUERIES, CELLS, BATCH, WIDER = 4096, 16384, 256, 256, 4
#: Lengths of a band, as a share of its upper edge, and bands at most; the last holds all shorter vectors.
BAND, BANDS = 0.9, 32
#: Radii on the unit sphere (its points are at most 2 apart), then all points.
RADII = (*(2.0**i for i in range(-5, 2)), math.inf)
SEED = 20


@functools.cache
def threshold(projections: int = PROJECTIONS, miss: float = MISS) -> int:
    """The most windows that a point at the radius reaches with a probability of at least 1 - ``miss``."""
    p = math.erf(HALF_WIDTH / math.sqrt(2))
    below = 0.0
    for n in range(projections + 1):
        below += math.comb(projections, n) * p**n * (1 - p) ** (projections - n)
        if below > miss:
            return n
    return projections


@functools.cache
def lines(dimensions: int) -> np.ndarray:
    """The random lines, the same for all tasks: (PROJECTIONS, dimensions + 1)."""
    return np.random.default_rng(SEED).standard_normal((PROJECTIONS, dimensions + 1))


def on_sphere(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    return np.column_stack([scaled, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))])


def lengths(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(axis=1, initial=0.0)
    return np.sqrt(((vectors / top[:, None]) ** 2).sum(axis=1)) * top


def asked(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors / lengths(vectors)[:, None], np.zeros(len(vectors))])


def distances(scores: np.ndarray, length: np.ndarray, longest: float) -> np.ndarray:
    """On the sphere of vectors up to ``longest``, from queries of that ``length``; none has a higher score than the product."""
    with np.errstate(invalid="ignore"):
        return np.where(np.isneginf(scores), np.inf, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * scores / (length * longest))))


class Block:
    """Sorted projections of some points, with their vectors and the ids of each."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, starts: np.ndarray, longest: float) -> None:
        self.vectors, self.ids, self.starts, self.longest = vectors, ids, starts, longest
        seen = lines(vectors.shape[1]) @ on_sphere(vectors, longest).T
        order = np.argsort(seen, axis=1, kind="stable")
        self.sorted = np.take_along_axis(seen, order, axis=1)
        self.rank = np.empty(seen.shape, np.uint16 if len(vectors) < 1 << 15 else np.uint32)
        np.put_along_axis(self.rank, order, np.arange(len(vectors), dtype=self.rank.dtype)[None], axis=1)

    def search(self, queries: np.ndarray, k: int, least: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (ids, scores) of its ``k`` best in the order of score and id.

        With ``least``, a score for each query, it takes one step at the radius of that score instead of all ``RADII``.
        """
        out = []
        for a in range(0, len(queries), BATCH):
            now = queries[a : a + BATCH]
            one = None if least is None else distances(least[a : a + BATCH], lengths(now), self.longest)[:, None] * (1 + 1e-9)
            out += self._batch(now, k, np.tile(RADII, (len(now), 1)) if one is None else one)
        return out

    def _batch(self, queries: np.ndarray, k: int, steps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        at = lines(queries.shape[1]) @ asked(queries).T
        window = lambda x, side: np.array([np.searchsorted(row, y, side) for row, y in zip(self.sorted, x)]).T
        seen = np.zeros((len(queries), len(self.vectors)), bool)
        found, scores = [np.empty(0, np.int64)] * len(queries), [np.empty(0)] * len(queries)
        worst = np.full(len(queries), math.inf)
        length = lengths(queries)
        going = np.arange(len(queries))
        for step in steps.T:
            radius = np.minimum(step, worst * (1 + 1e-9))  # at that radius what is kept is within it
            reach = np.where(np.isinf(radius), 4.0, radius)[going] * HALF_WIDTH
            left = window(at[:, going] - reach, "left")
            wide = window(at[:, going] + reach, "right") - left
            for i, a, n in zip(going, left.astype(self.rank.dtype), wide.astype(self.rank.dtype)):
                if math.isinf(radius[i]):
                    new = np.flatnonzero(~seen[i])
                else:
                    inside = self.rank - a[:, None] < n[:, None]  # ranks before the window wrap around
                    new = np.flatnonzero((np.add.reduce(inside, axis=0, dtype=np.uint8) >= threshold()) & ~seen[i])
                if len(new):
                    seen[i, new] = True
                    found[i] = np.concatenate([found[i], new])
                    scores[i] = np.concatenate([scores[i], np.einsum("ij,j->i", self.vectors[new], queries[i])])
                    found[i], scores[i], last = self._best(found[i], scores[i], k)
                    if last is not None:
                        worst[i] = distances(np.float64(last), length[i], self.longest)
            going = going[worst[going] > radius[going]]
            if not len(going):
                break
        return [self._first(f, s, k) for f, s in zip(found, scores)]

    def _best(self, found: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float | None]:
        """The points that hold the ``k`` best ids, with all that tie, and the last score; None if there are fewer ids."""
        if len(found) > k:
            keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[keep], scores[keep]
        best = np.argsort(-scores, kind="stable")
        held = np.cumsum((self.starts[found + 1] - self.starts[found])[best])
        return found, scores, scores[best[np.searchsorted(held, k)]] if held[-1] >= k else None

    def _first(self, found: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.starts[found + 1] - self.starts[found]
        ids = np.concatenate([self.ids[self.starts[i] : self.starts[i + 1]] for i in found]) if len(found) else np.empty(0, np.int64)
        each = np.repeat(scores, sizes)
        best = np.lexsort((ids, -each))[:k]
        return ids[best], each[best]


def _matrix(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _block(table: pa.Table, dimensions: int, edges: np.ndarray) -> Block:
    table = table.sort_by("point")  # so that equal scores are met in one order, however rows arrive
    ids = table.column("ids").combine_chunks()
    starts = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return Block(_matrix(table.column("v"), dimensions), ids.flatten().to_numpy(zero_copy_only=False), starts, edges[table.column("cell")[0].as_py()])


def points(rows: DataFrame, k: int) -> DataFrame:
    """(h, v, point, ids): distinct vectors, numbered, each with its ``k`` smallest ids. To be written before it is used."""
    own = Window.partitionBy("h", "v").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(own)).where(F.col("n") <= k)
    return few.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("h", "v", F.monotonically_increasing_id().alias("point"), "ids")


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, v, h): distinct rows with an id whose vector is neither null nor zero and has finite components only, as doubles."""
    v = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))  # no negative zeros
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).select(F.col(id).cast("long").alias("id"), v.alias("v"))
    return rows.where(finite & F.exists("v", lambda x: x != 0)).withColumn("h", F.xxhash64("v"))


def nearest(vectors: DataFrame, wanted, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``wanted`` (a column of ``id``'s values) holds, its ``k`` nearest others.

    Nearest first by inner product in double precision, ties to smaller ids. Rows without an id and vectors that are null,
    zero or hold null or infinite components or NaN take no part; shorter vectors count as filled up with zeros. A row that
    repeats an id and a vector counts once; an id with several vectors is a candidate with each, asks with each, and
    never finds itself. No rows, no results; with fewer than ``k`` others all of them are found. Other columns don't matter.
    """
    rows = usable(vectors, id, vector)
    sizes = rows.agg(F.max(F.size("v")), F.min(F.size("v"))).first()
    if sizes[0] is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    dimensions = sizes[0]
    if sizes[1] < dimensions:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dimensions) - F.size("v")))).withColumn("h", F.xxhash64("v"))
    rows = rows.distinct()
    queries = rows.where(wanted(F.col("id"))).select(F.col("id").alias("query_id"), "h", "v")
    own = queries.groupBy("query_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    most = k + (own or 1)  # a query may find itself, with each of its vectors
    base = cut(points(rows, most))
    members = cut(queries.join(base.select("h", "v", "point"), ["h", "v"]).select("query_id", "point"))

    greatest = F.array_max(F.transform("v", F.abs))
    top, n = base.agg(F.max(greatest), F.count("*")).first()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / top) * (x / top)))
    longest = float(base.agg(F.max(norm)).first()[0]) * top * (1 + 1e-12)
    kinds = max(1, min(CELLS // BANDS, n // BLOCK))
    cells = BANDS * kinds
    edges = np.repeat(longest * BAND ** np.arange(BANDS), kinds)
    pivots = asked(np.array([r["v"] for r in base.orderBy("h", "v").limit(kinds).select("v").collect()]))[:, :-1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            v = _matrix(pa.chunked_array([b.column("v")]), dimensions)
            band = np.clip(np.floor(np.log(lengths(v) / longest) / math.log(BAND)), 0, BANDS - 1).astype(np.int32)
            yield b.append_column("cell", pa.array(band * kinds + np.argmax(v @ pivots.T, axis=1), pa.int32()))

    asking = members.select("point").distinct().withColumn("asks", F.lit(True))
    in_cells = base.select("point", "v", "ids").mapInArrow(placed, "point long, v array<double>, ids array<long>, cell int")
    in_cells = cut(in_cells.join(asking, "point", "left").withColumn("asks", F.coalesce("asks", F.lit(False))))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            cell = b.column("cell").to_numpy()
            seen = on_sphere(_matrix(pa.chunked_array([b.column("v")]), dimensions), edges[cell][:, None]) @ lines(dimensions).T
            present = np.unique(cell)
            low, high, count = (np.array([f(seen[cell == c]) for c in present]) for f in (lambda x: x.min(0), lambda x: x.max(0), len))
            yield pa.RecordBatch.from_arrays([pa.array(present, pa.int32()), pa.array(list(low)), pa.array(list(high)), pa.array(count, pa.int64())], ["cell", "low", "high", "n"])

    # one row a batch and cell, summed by cell and line: at most CELLS x PROJECTIONS rows come back
    parts = in_cells.select("v", "cell").mapInArrow(ranges, "cell int, low array<double>, high array<double>, n long")
    spans = parts.select("cell", "n", F.posexplode(F.arrays_zip("low", "high"))).groupBy("cell", "pos")
    spans = spans.agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"), F.sum("n").alias("n")).collect()
    blocks_of = {r["cell"]: -(-r["n"] // BLOCK) for r in spans}
    low, high = np.full((cells, PROJECTIONS), np.inf), np.full((cells, PROJECTIONS), -np.inf)
    for r in spans:
        low[r["cell"], r["pos"]], high[r["cell"], r["pos"]] = r["low"], r["high"]
    first = np.concatenate([[0], np.cumsum([blocks_of.get(c, 0) for c in range(cells)])])
    start, many = F.array(*map(F.lit, first[:-1].tolist())), F.array(*(F.lit(blocks_of.get(c, 1)) for c in range(cells)))
    spread = F.pmod(F.xxhash64("point", F.lit(SEED)), F.element_at(many, F.col("cell") + 1))
    in_blocks = in_cells.withColumn("block", (F.element_at(start, F.col("cell") + 1) + spread).cast("long"))

    def at_home(table: pa.Table) -> pa.Table:
        asks = table.filter(table.column("asks"))
        found = _block(table, dimensions, edges).search(_matrix(asks.column("v"), dimensions), most) if len(asks) else []
        lists = {"ids": pa.array([f[0] for f in found], pa.list_(pa.int64())), "scores": pa.array([f[1] for f in found], pa.list_(pa.float64()))}
        return pa.table({c: asks.column(c) for c in ("point", "v", "block")} | lists)

    need, total = threshold(), int(first[-1])

    def visits(since: int, until: int):
        """Which of the blocks that follow a query's own, from number ``since`` on to before ``until``, it can gain from."""

        def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v, least = _matrix(pa.chunked_array([b.column("v")]), dimensions), b.column("least").to_numpy()
                at, length, own = asked(v) @ lines(dimensions).T, lengths(v), b.column("block").to_numpy()
                picked = [(np.empty(0, np.int64), np.empty(0, np.int64))]
                for c in np.flatnonzero(np.diff(first)):
                    reach = distances(least, length, edges[c])[:, None] * HALF_WIDTH * (1 + 1e-9)
                    met = ((at - reach <= high[c]) & (at + reach >= low[c])).sum(axis=1) >= need
                    met &= least <= length * edges[c] * (1 + 1e-9)
                    for block in range(first[c], first[c + 1]):
                        after = (block - own) % total
                        rows_ = np.flatnonzero(met & (after >= since) & (after < until))
                        picked.append((rows_, np.full(len(rows_), block)))
                rows_, to = (np.concatenate(x) for x in zip(*picked))
                columns = [b.column(c).take(pa.array(rows_)) for c in ("point", "v", "least")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(to, pa.int64())], ["point", "v", "least", "block"])

        return rows_of

    def away(stored: pa.Table, queries_: pa.Table) -> pa.Table:
        if not len(stored):
            queries_ = queries_.slice(0, 0)
        found, points_ = [], queries_.column("point").to_pylist()
        if len(queries_):
            least = queries_.column("least").to_numpy()
            searched = _block(stored, dimensions, edges).search(_matrix(queries_.column("v"), dimensions), most, least)
            better = [scores >= x for (_, scores), x in zip(searched, least)]
            found = [(p, f[0][b], f[1][b]) for p, f, b in zip(points_, searched, better) if b.any()]
        return pa.table({
            "point": pa.array([f[0] for f in found], pa.int64()), "ids": pa.array([f[1] for f in found], pa.list_(pa.int64())),
            "scores": pa.array([f[2] for f in found], pa.list_(pa.float64())),
        })

    def merged(rows_: DataFrame) -> DataFrame:
        """One row a point: the ``most`` best of its lists, and the last one's score once there are so many."""
        pairs = F.transform(F.arrays_zip("ids", "scores"), lambda x: F.struct((-x["scores"]).alias("minus"), x["ids"].alias("id")))
        best = F.slice(F.array_sort(F.flatten(F.collect_list(pairs))), 1, most)
        out = rows_.groupBy("point").agg(F.max("v").alias("v"), F.max("block").alias("block"), best.alias("best"))
        least = F.when(F.size("best") >= most, -F.element_at("best", -1)["minus"]).otherwise(float("-inf"))
        ids, scores = F.transform("best", lambda x: x["id"]), F.transform("best", lambda x: -x["minus"])
        return out.select("point", "v", "block", least.alias("least"), ids.alias("ids"), scores.alias("scores"))

    own = in_blocks.groupBy("block").applyInArrow(at_home, "point long, v array<double>, block long, ids array<long>, scores array<double>")
    now = cut(merged(own))
    chunks = max(1, -(-now.count() // QUERIES))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    dealt = in_blocks.select("block", "cell", "point", "v", "ids", each.alias("chunk"))
    keys, since = ["block", "chunk"], 1
    while since < total:
        until = since * WIDER
        going = now.mapInArrow(visits(since, until), "point long, v array<double>, least double, block long")
        going = going.withColumn("chunk", F.pmod(F.xxhash64("point"), F.lit(chunks)).cast("long"))
        gained = dealt.groupBy(*keys).cogroup(going.groupBy(*keys)).applyInArrow(away, "point long, ids array<long>, scores array<double>")
        now = cut(merged(now.select("point", "v", "block", "ids", "scores").unionByName(gained, allowMissingColumns=True)))
        since = until
    lists = now.select("point", F.arrays_zip("ids", "scores").alias("list"))
    kept = F.slice(F.filter("list", lambda x: x["ids"] != F.col("query_id")), 1, k)
    ranked = members.join(lists, "point").select("query_id", F.posexplode(kept).alias("p", "x"))
    return ranked.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
