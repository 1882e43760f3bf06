"""Journeys as vectors: TF-IDF, truncated SVD, behaviour metrics, weighted channels, global projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import BOS, EOS
from ..store import kept
from .vocabulary import ngrams

#: Channel weights, and the weight of the behaviour block.
CHANNELS = {"primary": 1.0, "coarse": 0.45, "intent": 0.30, "operation": 0.20}
NUMERIC_WEIGHT = 0.35
NUMERIC = ("n_events_final", "n_unique_tokens", "action_ratio", "back_rate", "revisit_ratio", "n_dedup_removed", "n_loop_removed", "span_seconds", "median_gap_s", "p90_gap_s", "max_gap_s")
SKEWED = ("n_events_final", "n_unique_tokens", "n_dedup_removed", "n_loop_removed", "span_seconds", "median_gap_s", "p90_gap_s", "max_gap_s")


def unit(v: Column) -> Column:
    """A vector of doubles of length 1; zero vectors stay as they are."""
    once = lambda x, f: F.get(F.transform(F.array(x), f), 0)  # noqa: E731  # a lambda's own variable is computed once, not again for each element
    norm = lambda y: F.sqrt(F.aggregate(y, F.lit(0.0), lambda s, x: s + x * x))
    return once(v, lambda y: once(norm(y), lambda n: F.when(n > 0, F.transform(y, lambda x: x / n)).otherwise(y)))


@dataclass
class Tfidf:
    """n-gram vocabulary with smoothed inverse document frequencies: ln((1 + n) / (1 + df)) + 1."""

    terms: DataFrame  # (ngram, term, idf)
    low: int
    high: int

    def by_row(self, rows: DataFrame, key: str, sequence: str) -> DataFrame:
        """(key, terms, ws) for each row with a known n-gram: weights (1 + ln tf) * idf, of length 1, in arrays; rows stay where they are.

        A batch's n-grams are put together and looked up once for each distinct one; the vocabulary is a model's.
        """
        listed = self.terms.select("ngram", "term", "idf").collect()  # as many as the fit chose
        names, low, high = [r["ngram"] for r in listed], self.low, self.high
        shared = rows.sparkSession.sparkContext.broadcast((names, np.array([r["term"] for r in listed], dtype=np.int32), np.array([r["idf"] for r in listed], dtype=float)))

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, term, idf = shared.value
            known = pa.array(names, pa.string())
            for b in filter(len, batches):
                row, at = _grams(b.column(1), known, low, high)
                pairs, tf = np.unique(row * max(1, len(names)) + at, return_counts=True)
                row, at = np.divmod(pairs, max(1, len(names)))
                w = (1 + np.log(tf)) * idf[at]
                present, starts, sizes = np.unique(row, return_index=True, return_counts=True)
                w = w / np.repeat(np.sqrt(np.add.reduceat(w * w, starts)), sizes) if len(w) else w
                offsets = pa.array(np.append(starts, len(w)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(term[at]), pa.array(w))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(present)), *lists], [key, "terms", "ws"])

        return rows.select(key, sequence).mapInArrow(weigh, f"{key} {rows.schema[key].dataType.simpleString()}, terms array<int>, ws array<double>")

    def transform(self, rows: DataFrame, key: str, sequence: str) -> DataFrame:
        """(key, term, w): the weights of ``by_row``, a row each; keys are unique."""
        return self.by_row(rows, key, sequence).select(key, F.inline(F.arrays_zip("terms", "ws"))).toDF(key, "term", "w")


def _grams(sequences: pa.Array, known: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in ``known`` of each n-gram of ``vocabulary.ngrams`` that is known."""
    sizes = pc.list_value_length(sequences)
    given = np.flatnonzero(sizes.is_valid().to_numpy(zero_copy_only=False))
    sizes = sizes.drop_null().to_numpy(zero_copy_only=False).astype(np.int64) + 2
    flat = sequences.flatten().cast(pa.string())
    ends = np.cumsum(sizes)
    at = np.empty(int(sizes.sum()), dtype=np.int64)
    inner = np.ones(len(at), dtype=bool)
    inner[ends - 1] = inner[ends - sizes] = False
    at[inner], at[ends - sizes], at[ends - 1] = np.arange(len(flat)), len(flat), len(flat) + 1
    words = pa.concat_arrays([flat, pa.array([BOS, EOS], pa.string())]).dictionary_encode(null_encoding="encode")
    code, names = words.indices.to_numpy()[at].astype(np.int64), words.dictionary.to_pylist()
    row = np.repeat(given, sizes)
    rows, places = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for n in range(low, high + 1):
        m = max(0, len(code) - n + 1)
        same = np.flatnonzero(row[:m] == row[n - 1 :])
        grams, own = np.unique(np.stack([code[same + i] for i in range(n)], axis=1), axis=0, return_inverse=True)
        joined = pa.array([" ".join(w for w in (names[c] for c in g) if w is not None) for g in grams.tolist()], pa.string())
        found = pc.index_in(joined, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)[own.ravel()]
        rows.append(row[same][found >= 0])
        places.append(found[found >= 0].astype(np.int64))
    return np.concatenate(rows), np.concatenate(places)


def fit_tfidf(rows: DataFrame, key: str, sequence: str, low: int = 1, high: int = 2, least: int = 5, most: int = 20_000) -> Tfidf:
    """The ``most`` most frequent n-grams of those in ``least`` rows or more; a row counts once in an n-gram's frequency."""
    n = rows.count()
    g = ngrams(F.col(sequence), low, high)
    one = lambda x, df, tf: F.struct(x.alias("ngram"), F.lit(df).alias("df"), F.lit(tf).alias("tf"))
    grams = rows.select(g.alias("g")).select(F.inline(F.concat(F.transform(F.array_distinct("g"), lambda x: one(x, 1, 0)), F.transform("g", lambda x: one(x, 0, 1)))))
    df = grams.groupBy("ngram").agg(F.sum("df").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= least)
    chosen = df.orderBy(F.col("total").desc(), "ngram").limit(most).withColumn("idf", F.ln((1 + F.lit(n)) / (1 + F.col("df"))) + 1)
    ids = {r["ngram"]: (i, r["idf"]) for i, r in enumerate(chosen.orderBy("ngram").collect())}  # bounded by ``most``
    terms = rows.sparkSession.createDataFrame([(g, i, x) for g, (i, x) in ids.items()], "ngram string, term int, idf double")
    return Tfidf(F.broadcast(terms), low, high)


#: Weights that are multiplied at once, terms in a block of sums, and tasks that hold sums, at most.
_SLICE, _TERMS, _TASKS = 50_000, 512, 64
#: Terms whose products are all added up in one pass; of more of them a random subspace is multiplied pass by pass.
_SQUARE = 1024


def _by_row(weights: DataFrame, key: str) -> DataFrame:
    """(key, terms, ws): each row's terms and weights as arrays; a row's terms are bounded by its length. ``weights`` may be that already."""
    if "terms" in weights.columns:
        return weights.select(key, "terms", "ws").where(F.size("terms") > 0)
    return weights.groupBy(key).agg(F.collect_list(F.struct("term", "w")).alias("s")).select(key, F.col("s.term").cast("array<int>").alias("terms"), F.col("s.w").cast("array<double>").alias("ws"))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first weight of each row, terms, weights) of some rows at a time; every row has a term."""
    terms = batch.column("terms")
    starts = terms.offsets.to_numpy() - terms.offsets[0].as_py()
    flat, ws = terms.flatten().to_numpy(zero_copy_only=False), batch.column("ws").flatten().to_numpy(zero_copy_only=False)
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + _SLICE, "right")) - 1)
        a, b = starts[row], starts[end]
        yield starts[row:end] - a, flat[a:b], ws[a:b]
        row = end


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), dtype=float) for x in table.column("block"))
    return pa.table({"first": table.column("first").slice(0, 1), "block": pa.array([total.tobytes()], pa.binary())})


def _products(starts: np.ndarray, terms: np.ndarray, ws: np.ndarray, basis: np.ndarray) -> np.ndarray:
    return np.add.reduceat(basis[terms] * ws[:, None], starts, axis=0)


def svd(weights: DataFrame, key: str, terms: int, k: int, seed: int = 7, steps: int = 6, extra: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` right singular vectors (terms by k) of the rows' weights, uncentred, and their singular values.

    Up to ``_SQUARE`` terms X'X itself is summed, in one pass over the rows, and turned to its vectors. Of more terms, a
    randomised range finder: a random subspace of ``extra`` more dimensions is multiplied by X'X ``steps`` times and made
    orthonormal in between, then turned to its own singular vectors. X'X q is a sum over rows, of which each task adds up
    its own in one matrix of terms by k; blocks of these are all that is shuffled, and terms by k numbers come back.
    """
    spark = weights.sparkSession
    k, wide = max(1, min(k, terms)), max(1, min(k + extra, terms))
    rows = kept(_by_row(weights, key).select("terms", "ws"))
    rows = rows.coalesce(min(_TASKS, max(1, rows.rdd.getNumPartitions())))
    signed = lambda basis: basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    if terms <= _SQUARE:
        values, vectors = np.linalg.eigh(_square(rows, terms))
        first = np.argsort(-values)[:k]
        return signed(vectors[:, first]), np.sqrt(np.maximum(values[first], 0.0))

    def times(q: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(q)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            basis = shared.value
            z = np.zeros_like(basis)
            for b in filter(len, batches):
                for starts, at, ws in _slices(b):
                    y = np.repeat(_products(starts, at, ws, basis), np.diff(np.append(starts, len(at))), axis=0) * ws[:, None]
                    order = np.argsort(at, kind="stable")
                    first = np.flatnonzero(np.diff(at[order], prepend=-1))
                    z[at[order][first]] += np.add.reduceat(y[order], first, axis=0)
            for i in range(0, len(z), _TERMS):
                if (part := z[i : i + _TERMS]).any():
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([part.tobytes()], pa.binary())], ["first", "block"])

        sums = rows.mapInArrow(partial, "first long, block binary").groupBy("first").applyInArrow(_added, "first long, block binary")
        z = np.zeros_like(q)
        for r in sums.collect():  # terms by k numbers
            part = np.frombuffer(r["block"], dtype=float).reshape(-1, q.shape[1])
            z[r["first"] : r["first"] + len(part)] = part
        shared.unpersist()
        return z

    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(terms, wide)))[0]
    for _ in range(steps):
        q = np.linalg.qr(times(q))[0]
    values, turn = np.linalg.eigh(q.T @ times(q))
    first = np.argsort(-values)[:k]
    basis = q @ turn[:, first]
    return signed(basis), np.sqrt(np.maximum(values[first], 0.0))


def _square(rows: DataFrame, terms: int) -> np.ndarray:
    """X'X of ``rows`` (terms, ws): each task adds up its own rows, pair by pair or, where rows are full, as matrices."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros((terms, terms))
        for b in filter(len, batches):
            for starts, at, ws in _slices(b):
                sizes = np.diff(np.append(starts, len(at)))
                if 50 * float((sizes.astype(float) ** 2).sum()) < len(sizes) * float(terms) ** 2:
                    own = np.repeat(sizes, sizes)  # each weight beside all of its row
                    left = np.repeat(np.arange(len(at)), own)
                    right = np.repeat(np.repeat(starts, sizes), own) + np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own)
                    z += np.bincount(at[left].astype(np.int64) * terms + at[right], ws[left] * ws[right], terms * terms).reshape(terms, terms)
                    continue
                for i in range(0, len(starts), 2048):
                    a, e = starts[i], starts[i + 2048] if i + 2048 < len(starts) else len(at)
                    x = np.zeros((min(2048, len(starts) - i), terms))
                    np.add.at(x, (np.repeat(np.arange(len(x)), sizes[i : i + 2048]), at[a:e]), ws[a:e])
                    z += x.T @ x
        for i in range(0, terms, _TERMS):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([z[i : i + _TERMS].tobytes()], pa.binary())], ["first", "block"])

    sums = rows.mapInArrow(partial, "first long, block binary").groupBy("first").applyInArrow(_added, "first long, block binary")
    z = np.zeros((terms, terms))
    for r in sums.collect():  # terms by terms numbers, at most 8 MB
        part = np.frombuffer(r["block"], dtype=float).reshape(-1, terms)
        z[r["first"] : r["first"] + len(part)] = part
    return z


def fit_svd(weights: DataFrame, key: str, terms: int, k: int, seed: int = 7) -> np.ndarray:
    """The basis of ``svd``; each vector's largest component is positive."""
    return svd(weights, key, terms, k, seed)[0]


def project(weights: DataFrame, key: str, basis: np.ndarray) -> DataFrame:
    """(key, v): each row's weights times ``basis`` (terms by k), a product a batch of rows."""
    shared = weights.sparkSession.sparkContext.broadcast(basis)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            v = np.concatenate([_products(*part, shared.value) for part in _slices(b)])
            lists = pa.ListArray.from_arrays(np.arange(0, v.size + 1, v.shape[1], dtype=np.int32), v.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), lists], [key, "v"])

    return _by_row(weights, key).mapInArrow(placed, f"{key} {weights.schema[key].dataType.simpleString()}, v array<double>")


@dataclass
class Numeric:
    means: list[float] = field(default_factory=list)
    scales: list[float] = field(default_factory=list)

    @staticmethod
    def raw(c: str) -> Column:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        return F.log1p(F.greatest(x, F.lit(0.0))) if c in SKEWED else x

    def transform(self, columns: tuple[str, ...] = NUMERIC) -> Column:
        """The behaviour block: logarithms of skewed columns, standardised, of length 1."""
        return unit(F.array(*((self.raw(c) - m) / s for c, m, s in zip(columns, self.means, self.scales))))


def fit_numeric(rows: DataFrame, columns: tuple[str, ...] = NUMERIC) -> Numeric:
    """Means and population deviations; constant columns are divided by 1."""
    r = rows.agg(*(f(Numeric.raw(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    return Numeric([r[f"m{i}"] or 0.0 for i in range(len(columns))], [r[f"s{i}"] or 1.0 for i in range(len(columns))])


def join_channels(parts: dict[str, Column], numeric: Column | None = None, weights: dict[str, float] = CHANNELS) -> Column:
    """One vector of the channels' unit vectors, each times its weight, and the behaviour block."""
    times = lambda v, w: F.transform(v, lambda x: x * w)
    blocks = [times(v, weights[n]) for n, v in parts.items()]
    return F.concat(*blocks, *([times(numeric, NUMERIC_WEIGHT)] if numeric is not None else []))


def pattern_vectors(rows: DataFrame, key: str, sequence: str, patterns: DataFrame, k: int = 64, numeric: Column | None = None, most: int = 5000) -> DataFrame:
    """(key, matched, v): rows as vectors of the frequent patterns that they contain, in place of n-grams.

    Which of ``patterns`` (tokens; a bounded list, its size is checked) a row contains, reduced to ``k`` dimensions and
    brought to length 1, with the behaviour block ``numeric`` behind. A row without any pattern has zeros there.
    """
    from .patterns import held

    listed = [r["tokens"] for r in patterns.select("tokens").orderBy(F.size("tokens"), "tokens").limit(most + 1).collect()]
    if len(listed) > most:
        raise ValueError(f"more than {most} patterns")
    k = max(1, min(k, len(listed)))
    block = F.array().cast("array<double>") if numeric is None else F.transform(numeric, lambda x: x * NUMERIC_WEIGHT)
    hits = kept(held(rows.select(key, sequence, block.alias("_block")), sequence, listed))  # read by the fit and once more
    basis = np.zeros((1, k))
    if listed:
        weights = hits.select(key, "terms", F.transform("terms", lambda t: F.lit(1.0)).alias("ws"))
        basis = fit_svd(weights, key, len(listed), k)
    shared = rows.sparkSession.sparkContext.broadcast(basis)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in filter(len, batches):
            terms = b.column("terms")
            sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
            v = np.zeros((len(b), k))
            np.add.at(v, np.repeat(np.arange(len(b)), sizes), shared.value[terms.flatten().to_numpy(zero_copy_only=False)])
            lists = pa.ListArray.from_arrays(np.arange(0, v.size + 1, k, dtype=np.int32), v.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes.astype(np.int32)), lists, b.column("_block")], [key, "matched", "v", "_block"])

    schema = f"{key} {rows.schema[key].dataType.simpleString()}, matched int, v array<double>, _block array<double>"
    return hits.mapInArrow(placed, schema).select(key, "matched", F.concat(unit(F.col("v")), "_block").alias("v"))


def reduce(rows: DataFrame, vector: str, k: int) -> DataFrame:
    """``rows`` with ``vector`` centred and projected on its first ``k`` principal components, of length 1."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.stat import Summarizer

    data = rows.withColumn("_v", array_to_vector(F.col(vector)))
    mean = data.select(Summarizer.mean(F.col("_v")).alias("m")).first()["m"].toArray()
    centred = data.withColumn("_v", array_to_vector(F.zip_with(vector, F.array(*map(F.lit, mean.tolist())), lambda x, m: x - m)))
    out = PCA(k=k, inputCol="_v", outputCol="_p").fit(centred).transform(centred)
    return out.withColumn(vector, unit(vector_to_array("_p"))).drop("_v", "_p")
