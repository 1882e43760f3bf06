"""Minimum spanning trees of mutual reachability distances, of several point sets at once, without gathering vectors.

Points lie in cells around sampled pivots; a cell's radius bounds from below how near any of its points can be, so whole
cells are left out of exact searches. Each point's nearest neighbours are found first in its own block, then in the blocks
that the bound leaves. Boruvka's rounds then join components by their least edge: most are found among the neighbours;
where a point's list may hide a nearer edge (its last distance doesn't exceed the component's best), the point searches
the blocks once more, up to that best. Edges are ordered by weight and then by their ends, so ties never make a circle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import kept

#: Neighbours kept of each point at least, points a block, cells, and askers compared at once.
LIST, BLOCK, CELLS, BATCH = 16, 2048, 256, 256
_NEAR = "array<struct<d:double,id:bigint>>"


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    n = len(column)
    flat = pa.chunked_array(column.chunks if isinstance(column, pa.ChunkedArray) else [column]).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows; the same pair has the same distance in every block."""
    return np.sqrt(np.maximum(((x**2).sum(1)[:, None] + (y**2).sum(1)) - 2 * np.einsum("id,jd->ij", x, y), 0))


def _nearest(x: np.ndarray, stored: np.ndarray, ids: np.ndarray, k: int, within: np.ndarray | None = None) -> list[list[dict]]:
    out = []
    for a in range(0, len(x), BATCH):
        d = _apart(x[a : a + BATCH], stored)
        some = min(k, d.shape[1])
        rough = np.partition(d, some - 1, axis=1)[:, some - 1]
        for i, row in enumerate(d):
            at = np.flatnonzero(row <= (rough[i] if within is None else min(rough[i], within[a + i])))
            best = at[np.lexsort((ids[at], row[at]))][:k]
            out.append([{"d": float(row[j]), "id": int(ids[j])} for j in best])
    return out


class _Cells:
    """Where points lie, and which blocks a point may have to visit: for each run, block and pivot."""

    def __init__(self, points: DataFrame) -> None:
        n = points.count()
        kinds = max(1, min(CELLS, n // BLOCK))
        self.pivots = _vectors(pa.array([r["v"] for r in points.orderBy(F.xxhash64("id", "run"), "run", "id").limit(kinds).select("v").collect()], pa.list_(pa.float64())))
        pivots = self.pivots

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in filter(len, batches):
                d = _apart(_vectors(b.column("v")), pivots)
                cell = d.argmin(axis=1)
                yield b.append_column("cell", pa.array(cell, pa.int32())).append_column("far", pa.array(d[np.arange(len(d)), cell]))

        self.points = kept(points.select("run", "id", "v").mapInArrow(placed, "run int, id long, v array<double>, cell int, far double"))
        spans = self.points.groupBy("run", "cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()  # CELLS a run at most
        self.blocks = sorted((r["run"], r["cell"], i, r["far"]) for r in spans for i in range(-(-r["n"] // BLOCK)))
        many = F.create_map(*(F.lit(x) for r in spans for x in (f"{r['run']}:{r['cell']}", -(-r["n"] // BLOCK))))
        deal = F.pmod(F.xxhash64("id", F.lit(3)), F.element_at(many, F.concat_ws(":", "run", "cell")))
        self.points = self.points.select("run", "id", "v", F.concat_ws(":", "run", "cell", deal).alias("block"))

    def visits(self, asking: DataFrame, bound: str, home: bool) -> DataFrame:
        """``asking`` (run, v, block, ...) once for each block of its run that may hold a point within ``bound``, as column ``at``."""
        pivots, blocks = self.pivots, self.blocks
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asking.schema) + ", at string"

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in filter(len, batches):
                d, run, own = _apart(_vectors(b.column("v")), pivots), b.column("run").to_numpy(), np.array(b.column("block").to_pylist())
                most = b.column(bound).to_numpy(zero_copy_only=False)
                for r, cell, i, far in blocks:
                    name = f"{r}:{cell}:{i}"
                    slack = 1e-6 * (far + d[:, cell])  # roots of rounded differences
                    hit = np.flatnonzero((run == r) & (d[:, cell] - far - slack <= most) & (home | (own != name)))
                    if len(hit):
                        yield b.take(pa.array(hit)).append_column("at", pa.array([name] * len(hit)))

        return asking.mapInArrow(rows, schema)


def neighbours(cells: _Cells, k: int) -> DataFrame:
    """(run, id, v, block, near): each point's ``k`` nearest of its run, itself among them, nearest first; exact."""

    def at_home(t: pa.Table) -> pa.Table:
        x = _vectors(t.column("v"))
        near = _nearest(x, x, t.column("id").to_numpy(), k)
        kind = pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64())]))
        return t.append_column("near", pa.array(near, kind))

    home = cells.points.groupBy("block").applyInArrow(at_home, f"run int, id long, v array<double>, block string, near {_NEAR}")
    home = kept(home.withColumn("bound", F.when(F.size("near") >= k, F.element_at("near", -1)["d"]).otherwise(float("inf"))))

    def away(stored: pa.Table, asks: pa.Table) -> pa.Table:
        near = _nearest(_vectors(asks.column("v")), _vectors(stored.column("v")), stored.column("id").to_numpy(), k, asks.column("bound").to_numpy()) if len(stored) and len(asks) else []
        kind = pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64())]))
        few = asks if near else asks.slice(0, 0)
        return pa.table({"run": few.column("run").cast(pa.int32()), "id": few.column("id").cast(pa.int64()), "near": pa.array(near, kind)})

    going = cells.visits(home.select("run", "id", "v", "block", "bound"), "bound", home=False).drop("block").withColumnRenamed("at", "block")
    more = cells.points.groupBy("block").cogroup(going.groupBy("block")).applyInArrow(away, f"run int, id long, near {_NEAR}")
    both = home.drop("bound").unionByName(more, allowMissingColumns=True)
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    return both.groupBy("run", "id").agg(F.max("v").alias("v"), F.max("block").alias("block"), merged.alias("near"))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("run", "comp").agg(F.min(F.struct("w", "lo", "hi")).alias("best"))


def tree(points: DataFrame, core: int = 5, rounds: int = 64) -> DataFrame:
    """(run, a, b, d): the edges of the tree of each run of ``points`` (run, id, v), a < b.

    The reachability of two points is the largest of their distance and of both core distances, a core distance being
    that of the ``core``-th nearest point, the point itself counted. Ids are unique within a run.
    """
    k = max(core, LIST)
    cells = _Cells(points)
    found = neighbours(cells, k)
    reach = F.element_at("near", F.least(F.lit(core), F.size("near")))["d"]
    horizon = F.when(F.size("near") >= k, F.element_at("near", -1)["d"]).otherwise(float("inf"))
    pts = kept(found.withColumns({"core": reach, "horizon": horizon}))
    pairs = pts.select("run", F.col("id").alias("a"), F.col("core").alias("core_a"), F.inline("near")).withColumnRenamed("id", "b").where("a <> b")
    other = pts.select("run", F.col("id").alias("b"), F.col("core").alias("core_b"))
    ends = [F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")]
    edges = kept(pairs.join(other, ["run", "b"]).select("run", *ends, F.greatest("d", "core_a", "core_b").alias("w")).distinct())
    place = kept(pts.select("run", "id", F.col("id").alias("comp")))
    out = None

    def search(stored: pa.Table, asks: pa.Table) -> pa.Table:
        best: dict[tuple[int, int], tuple] = {}
        if len(stored) and len(asks):
            y, ids, own = _vectors(stored.column("v")), stored.column("id").to_numpy(), stored.column("comp").to_numpy()
            reach_y, x = stored.column("core").to_numpy(), _vectors(asks.column("v"))
            who, comp, reach_x, run = (asks.column(c).to_numpy() for c in ("id", "comp", "core", "run"))
            for a in range(0, len(x), BATCH):
                w = np.maximum(np.maximum(_apart(x[a : a + BATCH], y), reach_y), reach_x[a : a + BATCH, None])
                w[comp[a : a + BATCH, None] == own] = np.inf
                least = w.min(axis=1)
                for i in np.flatnonzero(np.isfinite(least)):
                    ties = ids[w[i] == least[i]]
                    edge = min((float(least[i]), min(int(who[a + i]), int(t)), max(int(who[a + i]), int(t))) for t in ties)
                    at = (int(run[a + i]), int(comp[a + i]))
                    best[at] = min(best.get(at, edge), edge)
        columns = [[r for r, _ in best], [c for _, c in best], *([e[i] for e in best.values()] for i in range(3))]
        kinds = (pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["run", "comp", "w", "lo", "hi"])

    for _ in range(rounds):
        ends_of = lambda side: place.select("run", F.col("id").alias(side), F.col("comp").alias(f"comp_{side}"))
        cross = edges.join(ends_of("lo"), ["run", "lo"]).join(ends_of("hi"), ["run", "hi"]).where("comp_lo <> comp_hi")
        edges = kept(cross.select("run", "lo", "hi", "w"))  # edges inside components never come back
        known = cross.select("run", F.explode(F.array("comp_lo", "comp_hi")).alias("comp"), "w", "lo", "hi")
        best = kept(_least(known))
        now = pts.join(place, ["run", "id"])
        several = place.groupBy("run").agg(F.count_distinct("comp").alias("n")).where("n > 1").select("run")
        hidden = now.join(F.broadcast(several), "run").join(best, ["run", "comp"], "left").withColumn("bound", F.coalesce("best.w", F.lit(float("inf")))).where("horizon <= bound")
        asks = kept(hidden.select("run", "id", "v", "block", "comp", "core", "bound"))
        if asks.limit(1).count():
            going = cells.visits(asks.where("core <= bound"), "bound", home=True).drop("block").withColumnRenamed("at", "block")
            stored = now.select("block", "id", "v", "comp", "core")
            extra = stored.groupBy("block").cogroup(going.groupBy("block")).applyInArrow(search, "run int, comp long, w double, lo long, hi long")
            best = kept(_least(best.select("run", "comp", "best.*").unionByName(extra)))
        chosen = best.select("run", "comp", "best.*")
        if not chosen.limit(1).count():
            return out if out is not None else chosen.select("run", F.col("lo").alias("a"), F.col("hi").alias("b"), F.col("w").alias("d"))
        new = chosen.select("run", F.col("lo").alias("a"), F.col("hi").alias("b"), F.col("w").alias("d")).distinct()
        out = kept(new if out is None else out.union(new))
        place = _joined(place, chosen)
    raise RuntimeError(f"trees did not settle in {rounds} rounds")


def _joined(place: DataFrame, chosen: DataFrame) -> DataFrame:
    """``place`` after each component has followed its chosen edge; pointers are doubled until they rest at a root."""
    ends_of = lambda side: place.select("run", F.col("id").alias(side), F.col("comp").alias(f"comp_{side}"))
    linked = chosen.join(ends_of("lo"), ["run", "lo"]).join(ends_of("hi"), ["run", "hi"])
    to = linked.select("run", "comp", F.when(F.col("comp") == F.col("comp_lo"), F.col("comp_hi")).otherwise(F.col("comp_lo")).alias("to"))
    back = to.select("run", F.col("comp").alias("to"), F.col("to").alias("back"))
    # two that chose each other: the smaller is the root
    points = kept(to.join(back, ["run", "to"], "left").select("run", "comp", F.when((F.col("back") == F.col("comp")) & (F.col("comp") < F.col("to")), F.col("comp")).otherwise(F.col("to")).alias("to")))
    while True:
        up = points.select("run", F.col("comp").alias("to"), F.col("to").alias("next"))
        then = kept(points.join(up, ["run", "to"], "left").select("run", "comp", F.coalesce("next", "to").alias("next"), "to"))
        moved = then.where("next <> to").limit(1).count()
        points = then.select("run", "comp", F.col("next").alias("to"))
        if not moved:
            break
    return kept(place.join(points, ["run", "comp"], "left").select("run", "id", F.coalesce("to", "comp").alias("comp")))
