"""Mixing documents to target weights with soft domain membership.

A naive Bayes classifier, learnt from a labelled table, gives each document a posterior over domains. Rates r >= 0, one
a document, are then fitted so that expected domain totals, the sums of rate * tokens * posterior, match target token
totals: least squares by projected gradient. Each step is one aggregation over the compact table of posteriors, whose
result is a few numbers; the residual is whitened by the domains' own second moments, so a step of 1 converges.

Everything is DataFrame expressions: the classifier's tables and the way of the steps are a few hundred literals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import cut

#: Labelled rows that the classifier is fitted on at most (those with the smallest hashes of their id).
LABELLED = 20_000
#: Marker words of a domain: at most so many, in that share of its documents at least, so many times as frequent as elsewhere.
MARKERS, MARKER_SHARE, MARKER_LIFT = 40, 0.01, 5.0
BINS = 8
#: The largest error of a domain's total as a share of all tokens, the least gain of a step where targets can't be met
#: (as a share of the present residual), and the steps after which the fit gives up with an error.
TOLERANCE, GAIN, STEPS = 1e-4, 5e-3, 500


def _shape(docs: DataFrame, id_col: str, text_col: str, carried: list[str] | None = None) -> DataFrame:
    """(id, n_tokens, words, stats): lower-case words, their number, and statistics of the whole text that get binned.

    With columns ``carried`` also _row, a struct of them.
    """
    row = [F.struct(*(F.col(f"`{c}`") for c in carried)).alias("_row")] if carried else []
    more = ["_row"] if carried else []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*row, F.col(id_col).alias("id"), text.alias("text"), F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("words"))
    n = F.size("words").cast("long")
    chars = F.greatest(F.length("text"), F.lit(1))
    stats = F.array(
        F.log2(n + 1.0), F.log2(1 + 1000 * F.regexp_count("text", F.lit("[A-Z][A-Z]")) / chars), F.log2(1 + 1000 * F.regexp_count("text", F.lit(r"[#*$%&|<>!]")) / chars),
        10 * F.size(F.array_distinct("words")) / F.pow(F.greatest(n, F.lit(1)), F.lit(0.8)),
    )
    return rows.select(*more, "id", n.alias("n_tokens"), "words", stats.alias("stats"))


@dataclass
class Classifier:
    domains: list[str]
    prior: list[float]
    markers: dict[str, list[str]]
    lows: list[float]  # of the binned statistics
    steps: list[float]
    tables: list[list[list[float]]] | None = None  # log probability by feature, domain, bin

    def bins(self) -> list[Column]:
        """The bin of each feature: the statistics, then the number of each domain's marker words in the text."""
        stat = lambda i: F.least(F.greatest(F.floor((F.col("stats")[i] - self.lows[i]) / self.steps[i]), F.lit(0)), F.lit(BINS - 1)).cast("int")
        own = lambda d: F.least(F.size(F.array_intersect("words", _strings(self.markers[d]))), F.lit(BINS - 1))
        return [*(stat(i) for i in range(len(self.lows))), *(own(d) for d in self.domains)]

    def posteriors(self, shaped: DataFrame, carried: list[str] | None = None) -> DataFrame:
        """(id, n_tokens, p: posterior by domain, in order), and _row where it is carried."""
        own = [*(["_row"] if carried else []), "id", "n_tokens"]
        every = _strings(sorted({w for ws in self.markers.values() for w in ws}))
        rows = shaped.select(*own, "stats", F.array_intersect("words", every).alias("words"))
        rows = rows.select(*own, F.array(*self.bins()).alias("bins"))
        logs = []
        for d in range(len(self.domains)):
            total = F.lit(float(np.log(self.prior[d])))
            for f, table in enumerate(self.tables):
                total = total + F.element_at(F.array(*map(F.lit, table[d])), F.col("bins")[f] + 1)
            logs.append(total)
        rows = rows.select(*own, F.array(*logs).alias("logs"))
        rows = rows.select(*own, F.transform("logs", lambda x: F.exp(x - F.array_max("logs"))).alias("e"))
        whole = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
        return rows.select(*own, F.transform("e", lambda x: x / whole).alias("p"))


def _strings(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)).cast("array<string>")


def fit(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> Classifier:
    """Naive Bayes from ``labels`` (id, domain); rows of other or null domains are ignored. Without labels the prior is flat."""
    picked = labels.where(F.col("domain").isin(domains)).select("id", "domain").orderBy(F.xxhash64("id"), "id", "domain").limit(labelled)
    rows = cut(_shape(docs.join(F.broadcast(picked.select("id").distinct().withColumnRenamed("id", id_col)), id_col, "left_semi"), id_col, text_col).join(F.broadcast(picked), "id"))  # at most ``labelled`` ids
    about = rows.agg(*(f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(4) for n, f in (("lo", F.min), ("hi", F.max))), *(F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains))).first()
    count = [about[f"n{k}"] for k in range(len(domains))]
    total = sum(count)
    lows = [about[f"lo{i}"] or 0.0 for i in range(4)]
    steps = [max(((about[f"hi{i}"] or 0.0) - lows[i]) / BINS, 1e-9) for i in range(4)]
    words = rows.select("domain", F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(*(F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)))
    words = cut(words.where(" or ".join(f"n{k} >= {max(3, MARKER_SHARE * n)}" for k, n in enumerate(count)))) if total else None
    markers: dict[str, list[str]] = {d: [] for d in domains}
    for k, d in enumerate(domains):
        if count[k]:
            rest = sum((F.col(f"n{j}") for j in range(len(domains)) if j != k), F.lit(0))
            lift = (F.col(f"n{k}") / count[k]) / ((rest + 1) / (total - count[k] + 1))
            best = words.where((F.col(f"n{k}") >= max(3, MARKER_SHARE * count[k])) & (lift >= MARKER_LIFT)).orderBy((F.col(f"n{k}") * F.ln(lift)).desc(), "word").limit(MARKERS)
            markers[d] = [r["word"] for r in best.collect()]
    found = Classifier(domains, [(n + 1) / (total + len(domains)) for n in count], markers, lows, steps)
    bins = rows.select("domain", F.posexplode(F.array(*found.bins())).alias("feature", "bin")).groupBy("domain", "feature", "bin").count().collect()
    tables = np.full((4 + len(domains), len(domains), BINS), 0.5)
    for r in bins:
        tables[r["feature"], domains.index(r["domain"]), r["bin"]] += r["count"]
    found.tables = np.log(tables / tables.sum(axis=2, keepdims=True)).tolist()
    return found


def rate(p: Column, way: list[float], least: Column | None = None, most: Column | None = None) -> Column:
    """The rate of a document with posterior ``p`` after a descent of ``way``, within ``least`` (0 if not given) and ``most`` (no bound)."""
    dot = F.aggregate(F.zip_with(p, F.array(*map(F.lit, way)), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    r = 1.0 - dot
    return F.greatest(F.lit(0.0) if least is None else least, r if most is None else F.least(most, r))


def fit_rates(members: DataFrame, targets: list[float], least: Column | None = None, most: Column | None = None, steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[list[float], list[float]]:
    """The ``way`` for ``rate`` and the domain totals that it gives over ``members`` (n_tokens, p); ``targets`` are token totals.

    Least squares by projected gradient with lazy projection: the way w adds up all steps, and the rates are 1 - p . w
    put back within their bounds. A step is M (totals - targets). With M the inverse of the second moments of p over the
    tokens of all documents that the bounds leave free, no step raises the residual (as weighed by that M). The moments
    of the documents strictly inside their bounds give longer steps, which are taken as long as they pay. The fit ends
    when the targets are met or, where bounds or posteriors don't allow it, when a step gains nothing more;
    RuntimeError after ``steps``.
    """
    k = len(targets)
    p, weight = [F.col("p")[d] for d in range(k)], F.col("n_tokens").cast("double")
    low = F.lit(0.0) if least is None else least
    free = F.lit(True) if most is None else low < most
    inside = (F.col("rate") > low) & (F.lit(True) if most is None else F.col("rate") < most)
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    sums = [F.sum(F.col("rate") * weight * p[d]).alias(f"s{d}") for d in range(k)]
    moments = [F.sum(F.when(c, weight) * p[a] * p[b]).alias(f"{n}{a}_{b}") for n, c in (("i", inside), ("f", free)) for a, b in pairs]

    def look(way: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Totals, moments of the documents strictly inside their bounds and of all free ones, and all tokens."""
        r = members.withColumn("rate", rate(F.col("p"), way.tolist(), least, most)).agg(F.sum(weight).alias("all"), *sums, *moments).first()
        of = lambda n: np.array([[r[f"{n}{min(a, b)}_{max(a, b)}"] or 0.0 for b in range(k)] for a in range(k)])
        return np.array([r[f"s{d}"] or 0.0 for d in range(k)]), of("i"), of("f"), float(r["all"] or 1.0)

    way = np.zeros(k)
    totals, inner, outer, scale = look(way)
    ridge = np.eye(k) * 1e-9 * scale
    safe = np.linalg.inv(outer + ridge)
    longer = True
    for _ in range(steps):
        error = totals - np.array(targets)
        if np.abs(error).max() <= tolerance * scale:
            return way.tolist(), totals.tolist()
        longer = longer and inner.any()
        then = way + (np.linalg.solve(inner + ridge, error) if longer else safe @ error)
        found = look(then)
        left = found[0] - np.array(targets)
        if left @ safe @ left < (error @ safe @ error) * (1 - GAIN):
            way, totals, inner, longer = then, found[0], found[1], True
        elif longer:
            longer = False  # once more from here, with a step that is short enough
        else:
            return way.tolist(), totals.tolist()
    raise RuntimeError(f"rates did not settle in {steps} steps")


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str | None = None, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """(id, n_tokens, domain, p, rate, copies) for every row of ``docs``.

    ``weights`` are the domains' target shares of tokens. The total is such that the domain ``anchor`` keeps its tokens
    (None: that the tokens of all stay as many). ``copies`` is the rate rounded up or down at random, by a hash of the
    id, so that its expectation is the rate; rows that repeat an id are rounded alike. A null or empty text has no
    tokens and a posterior like any other. Without labels posteriors are flat. If no rates meet the targets, the nearest
    totals are kept. Only the named columns are read; an empty table gives an empty result.
    """
    return _mixed(docs, labels, weights, anchor, id_col, text_col, labelled, [])


def resample(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str | None = None, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """The rows of ``docs`` that ``mix`` would keep, once each, so that unique documents stay unique.

    Rates are fitted within the bounds that this sets: 1 at most, and 1 for all documents whose likeliest domain is
    ``anchor``. If the targets can't be met within them, the nearest totals are. Null and empty texts, null and repeated
    ids and ties are treated as in ``mix``; all columns are carried, whatever their names; an empty table stays empty.
    """
    found = _mixed(docs, labels, weights, anchor, id_col, text_col, labelled, docs.columns)
    return found.where(F.col("_mix.copies") > 0).select(*(F.col(f"_row.`{c}`") for c in docs.columns))


def _mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float], anchor: str | None, id_col: str, text_col: str, labelled: int, carried: list[str]) -> DataFrame:
    """The columns of ``mix``; with ``carried`` a struct _row of these and a struct _mix, at rates bounded as in ``resample``."""
    domains = list(weights)
    model = fit(docs, labels, domains, id_col, text_col, labelled)
    members = cut(model.posteriors(_shape(docs, id_col, text_col, carried), carried))  # computed once, as it is used often
    compact = members.select("id", "n_tokens", "p")
    have = compact.agg(*(F.coalesce(F.sum(F.col("n_tokens") * F.col("p")[d]), F.lit(0.0)).alias(f"s{d}") for d in range(len(domains)))).first()
    share = {d: w / sum(weights.values()) for d, w in weights.items()}
    total = sum(have) if anchor is None else have[domains.index(anchor)] / share[anchor]
    top = F.element_at(_strings(domains), F.array_position("p", F.array_max("p")).cast("int"))
    least, most = (F.when(top == anchor, 1.0).otherwise(0.0) if anchor else F.lit(0.0), F.lit(1.0)) if carried else (None, None)
    way, _ = fit_rates(compact, [total * share[d] for d in domains], least, most)
    luck = F.pmod(F.xxhash64("id", F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    rated = members.withColumn("rate", rate(F.col("p"), way, least, most))
    copies = F.floor(F.col("rate") + luck).alias("copies")
    if carried:
        return rated.select("_row", F.struct(top.alias("domain"), copies).alias("_mix"))
    return rated.select("id", "n_tokens", top.alias("domain"), "p", "rate", copies)
