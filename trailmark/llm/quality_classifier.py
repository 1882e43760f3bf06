"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated.

A Gaussian kernel over standardised document statistics is approximated by cosines of random projections (Rahimi and
Recht). Each partition of the labelled rows sums its share of the normal equations, Spark adds the shares up, and the
driver solves a system of fixed size. An isotonic fit over a histogram of the raw scores turns them into probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import SPACE, cut

#: Random features, ridge penalty a row, kernel width in standard deviations, seed, bins of the calibration histogram.
FEATURES, RIDGE, WIDTH, SEED, BINS = 128, 1e-4, 4.0, 20, 512
#: Raw scores are binned over this range; those outside fall into the end bins.
LOW, HIGH = -0.5, 1.5
#: Parts of the labelled rows, each calibrated by a fit to the others.
FOLDS = 5

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "log_longest_word", "upper", "digit", "symbol", "exclaim", "punctuation", "newline", "non_ascii",
    "distinct_words", "top_word", "short_words", "shouted_words", "dup_lines", "log_line", "entropy",
)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[np.frombuffer(chars.encode(), dtype=np.uint8)] = 1
    return out


_UPPER, _DIGIT, _SYMBOL = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("#*$%&|<>")
_PUNCTUATION, _SPACES = _class(".,;:?'\"()-_/"), _class(SPACE)
_HIGH = np.concatenate([np.zeros(128), np.ones(128)])
_KINDS = np.stack([_UPPER, _DIGIT, _SYMBOL, _class("!"), _PUNCTUATION, _class("\n"), _HIGH], axis=1)


def statistics(text: str | None) -> list[float]:
    """The document statistics of a whole text, in the order of ``STATISTICS``; all 0 for a text without words."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    inked = max(1, len(raw) - int(count @ _SPACES))
    share = (count @ _KINDS) / inked
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    p = count[count > 0] / len(raw)
    return [
        math.log1p(len(raw)), math.log1p(n), inked / n, math.log1p(max(map(len, seen))), *share.tolist(),
        len(seen) / n ** 0.8, max(seen.values()) / n, sum(c for w, c in seen.items() if len(w) <= 3) / n, sum(c for w, c in seen.items() if w.isupper()) / n,
        1 - len(set(lines)) / len(lines), math.log1p(len(raw) / len(lines)), float(-(p * np.log2(p)).sum()),
    ]


def featurize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) for every row."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = [statistics(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["id", "stats"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the random features and a constant
    grid: list[float]  # calibrated probability at evenly spaced raw scores from LOW to HIGH

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.normal(size=(len(STATISTICS), FEATURES)) / WIDTH
        phase = rng.uniform(0, 2 * math.pi, FEATURES)
        z = math.sqrt(2 / FEATURES) * np.cos(np.clip((stats - self.mean) / self.scale, -8, 8) @ w + phase)
        return np.concatenate([z, np.ones((len(stats), 1))], axis=1)


def _stats(batch: pa.RecordBatch, at: int) -> np.ndarray:
    return np.array(batch.column(at).flatten(), dtype=float).reshape(-1, len(STATISTICS))


def fit(stats: DataFrame, labels: DataFrame) -> Model | None:
    """A model from ``stats`` (id, stats) and ``labels`` (id, label: 0 or 1, others and nulls ignored); None without both labels.

    The ridge fit is made on all labelled rows, and ``FOLDS`` times on those outside one fold (by hash of the id); the
    calibration sees each row through the fit that left it out.
    """
    fold = F.coalesce(F.pmod(F.xxhash64("id"), F.lit(FOLDS)), F.lit(0)).cast("int").alias("fold")
    rows = cut(stats.join(labels.where("label in (0, 1)").select("id", F.col("label").cast("double").alias("y")), "id").select("stats", "y", fold))
    moments = [f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(len(STATISTICS)) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    about = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *moments).first()
    if not about["n"] or not 0 < about["ones"] < about["n"]:
        return None
    model = Model(np.array([about[f"m{i}"] for i in range(len(STATISTICS))]), np.array([about[f"s{i}"] or 1.0 for i in range(len(STATISTICS))]) + 1e-9, np.zeros(FEATURES + 1), [])
    size = FEATURES + 2
    upper = np.triu_indices(size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            z = np.concatenate([model.features(_stats(b, 0)), np.array(b.column(1), dtype=float)[:, None]], axis=1)
            of = b.column(2).to_numpy()
            for k in np.unique(of):
                total[k] = total.get(k, 0) + z[of == k].T @ z[of == k]
        for k, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(upper[0]), pa.int32()), pa.array(range(len(upper[0])), pa.int32()), pa.array(t[upper])], names=["fold", "at", "v"])

    found = rows.mapInArrow(sums, "fold int, at int, v double").groupBy("fold", "at").agg(F.sum("v").alias("v")).collect()  # as many rows as the systems have numbers
    equations = np.zeros((FOLDS, size, size))
    for r in found:
        i, j = upper[0][r["at"]], upper[1][r["at"]]
        equations[r["fold"], i, j] = equations[r["fold"], j, i] = r["v"]
    every = equations.sum(axis=0)
    model.weights = solve(every)
    left_out = [Model(model.mean, model.scale, solve(every - e), []) for e in equations]

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, x = b.column(2).to_numpy(), _stats(b, 0)
            z = model.features(x)
            out = (z * np.array([m.weights for m in left_out])[of]).sum(axis=1) if len(of) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(out)], names=["y", "raw"])

    bins = rows.mapInArrow(raw, "y double, raw double").groupBy(_bin(F.col("raw")).cast("int").alias("bin")).agg(F.count("*").alias("n"), F.sum("y").alias("y")).collect()
    model.grid = isotonic([(r["bin"], r["n"], r["y"]) for r in bins])
    return model


def solve(equations: np.ndarray) -> np.ndarray:
    """Ridge weights from the sums of products of (features, 1, y); the penalty is ``RIDGE`` a row, and none on the constant."""
    penalty = np.diag([RIDGE * equations[-2, -2]] * FEATURES + [0.0]) + np.eye(FEATURES + 1) * 1e-9
    return np.linalg.solve(equations[:-1, :-1] + penalty, equations[:-1, -1])


def _bin(raw):
    return F.least(F.greatest((raw - LOW) / (HIGH - LOW) * BINS, F.lit(0.0)), F.lit(BINS - 1e-6))


def pools(bins: list[tuple[int, int, float]]) -> list[list[float]]:
    """Pool adjacent violators over (bin, rows, ones): pools of [rows, ones, rows * position, bins] with rising shares of ones."""
    out: list[list[float]] = []
    for at, n, ones in sorted(bins):
        out.append([n, ones, n * (at + 0.5), 1])
        while len(out) > 1 and out[-2][1] * out[-1][0] >= out[-1][1] * out[-2][0]:
            last = out.pop()
            out[-1] = [a + b for a, b in zip(out[-1], last)]
    return out


def isotonic(bins: list[tuple[int, int, float]]) -> list[float]:
    """The isotonic fit over (bin, rows, ones) at the bins' edges, linear between the middles of its pools."""
    found = pools(bins)
    n = sum(p[0] for p in found)
    at = [p[2] / p[0] for p in found]
    value = [(p[1] + 0.5 * p[0] / n) / (p[0] + p[0] / n) for p in found]  # drawn a little towards 1/2, by one row over all
    return np.clip(np.interp(np.arange(BINS + 1), at, value) + (np.arange(BINS + 1) - BINS / 2) * 1e-6, 0, 1).tolist()


def _raw(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with the raw score of column stats in its place."""
    at = rows.columns.index("stats")
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "stats"), T.StructField("raw", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = model.features(_stats(b, at)) @ model.weights if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), pa.array(raw)], names=schema.names)

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of ``docs``, learnt from ``labels`` (id, label); 0.5 for all where nothing can be learnt.

    Null and empty texts are texts without words and get a score like others. Repeated ids are rows of their own and
    count as often in training. Only the named columns are read; an empty table gives an empty result.
    """
    stats = cut(featurize(docs, id_col, text_col))
    model = fit(stats, labels)
    if model is None:
        return stats.select("id", F.lit(0.5).alias("score"))
    raw = _raw(stats, model).withColumn("x", _bin(F.col("raw")))
    low = F.floor("x").cast("int")
    grid = F.array(*map(F.lit, model.grid))
    at = F.element_at(grid, low + 1)
    return raw.select("id", (at + (F.element_at(grid, low + 2) - at) * (F.col("x") - low)).alias("score"))
