"""Aggregates that dashboards and reports read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quantiles
from .events import seconds
from .vocabulary import sized


def coverage(rows: DataFrame, by: list[str], distinct: list[str], flags: dict[str, Column]) -> DataFrame:
    """Rows, distinct values and the percentage of rows with each flag, by group."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows"), *(F.count_distinct(c).alias(f"n_{c}") for c in distinct), *(F.round(100 * F.avg(F.coalesce(f, F.lit(False)).cast("int")), 4).alias(f"pct_{n}") for n, f in flags.items())
    )


def quantile_table(rows: DataFrame, by: list[str], value: str, at: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """Mean, linear quantiles and maximum by group."""
    q = rows.groupBy(*by).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.max(value).alias("max"))
    q = quantiles.beside(q, rows, by, {"q": (value, at)})
    return q.select(*by, "n", "mean", *(F.round(F.col("q")[i], 6).alias(f"p{round(100 * x)}") for i, x in enumerate(at)), "max")


def ecdf(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Share of rows at or below each distinct value; counts are summed before the running total."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by)
    up = w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(*by, value, "n", F.round(F.sum("n").over(up) / F.sum("n").over(w), 9).alias("ecdf"))


def group_share(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """Counts of ``key`` and its percentage of the group."""
    counts = rows.groupBy(*by, key).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(*by)), 6))


def top_n(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def hourly(rows: DataFrame, by: list[str], time: str, shift_hours: int = 7) -> tuple[DataFrame, DataFrame]:
    """Mean count a day for each local hour and for each weekday (1: Monday): counts a day first, then their mean."""
    t = F.col(time).cast("timestamp") + F.expr(f"INTERVAL {int(shift_hours)} HOURS")
    local = rows.select(*by, F.to_date(t).alias("day"), F.hour(t).alias("hour"), (F.weekday(t) + 1).alias("dow"))
    hours = local.groupBy(*by, "day", "hour").agg(F.count("*").alias("n")).groupBy(*by, "hour").agg(F.round(F.avg("n"), 6).alias("mean_rows"), F.count("*").alias("days"))
    days = local.groupBy(*by, "day", "dow").agg(F.count("*").alias("n")).groupBy(*by, "dow").agg(F.round(F.avg("n"), 6).alias("mean_rows"), F.count("*").alias("days"))
    return hours, days


def drift(old: DataFrame, new: DataFrame, on: list[str]) -> DataFrame:
    """Keys that only one of the two has: (on, change: new or dropped)."""
    a, b = old.select(*on).distinct(), new.select(*on).distinct()
    return b.join(a, on, "left_anti").withColumn("change", F.lit("new")).union(a.join(b, on, "left_anti").withColumn("change", F.lit("dropped")))


def share_shift(rows: DataFrame, period: str, key: str, n: int) -> DataFrame:
    """The ``n`` largest changes of a key's share from the first period to the last."""
    share = group_share(rows, [period], key)
    ends = rows.agg(F.min(period).alias("first"), F.max(period).alias("last"))
    at = lambda c: F.sum(F.when(F.col(period) == F.col(c), F.col("pct")).otherwise(0.0))
    both = share.join(F.broadcast(ends)).groupBy(key).agg(F.round(at("first"), 6).alias("first_pct"), F.round(at("last"), 6).alias("last_pct"))  # ends: one row
    return both.withColumn("delta", F.round(F.col("last_pct") - F.col("first_pct"), 6)).orderBy(F.abs("delta").desc(), key).limit(n)


def grid_fill(counts: DataFrame, dims: list[str], value: str) -> DataFrame:
    """Every combination of the dimensions' values, 0 where ``counts`` has none. Dimensions are small by nature."""
    grid = counts.select(dims[0]).distinct()
    for d in dims[1:]:
        grid = grid.join(sized(counts.select(d).distinct()))
    return grid.join(counts, dims, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def kpi(rows: DataFrame, scope: str, sums: dict[str, str], distinct: list[str]) -> DataFrame:
    """Totals by ``scope`` and over all (scope: all), from one pass of grouping sets."""
    out = rows.rollup(scope).agg(F.grouping(scope).alias("_all"), F.count("*").alias("rows"), *(F.round(F.sum(c), 4).alias(n) for n, c in sums.items()), *(F.count_distinct(c).alias(f"n_{c}") for c in distinct))
    return out.withColumn("scope", F.when(F.col("_all") == 1, "all").otherwise(F.col(scope))).drop("_all", scope)


def weighted_rates(rows: DataFrame, by: list[str], weight: str, rates: list[str]) -> DataFrame:
    """Means of rates weighted by how many each row stands for; null where nothing does."""
    n = F.sum(weight)
    return rows.groupBy(*by).agg(n.alias(weight), *(F.round(F.sum(F.col(r) * F.col(weight)) / F.nullif(n, F.lit(0)), 6).alias(r) for r in rates))


def explode_flags(rows: DataFrame, flags: str, separator: str = "|") -> DataFrame:
    """Counts of the single flags in a column of joined ones."""
    one = F.explode(F.split(F.col(flags), f"\\{separator}")).alias("flag")
    return rows.where(F.coalesce(flags, F.lit("")) != "").select(one).groupBy("flag").agg(F.count("*").alias("n"))


def customer_metrics(rows: DataFrame, customer: str, time: str, kind: str) -> DataFrame:
    """Rows, kinds, active months, median hours between rows, rows an active month, by customer."""
    t = F.col(time).cast("timestamp")
    gaps = rows.withColumn("_h", seconds(t, F.lag(t).over(Window.partitionBy(customer).orderBy(t))) / 3600)
    months = F.count_distinct(F.date_trunc("month", t))
    out = gaps.groupBy(customer).agg(F.count("*").alias("rows"), F.count_distinct(kind).alias("kinds"), months.alias("months"), F.round(F.count("*") / months, 4).alias("per_month"))
    out = quantiles.beside(out, gaps, [customer], {"_q": ("_h", (0.5,))}, dear=True)
    return out.select(customer, "rows", "kinds", "months", F.round(F.col("_q")[0], 4).alias("median_gap_h"), "per_month")


def post_anchor(rows: DataFrame, key: str, time: str, what: str, anchor: Column, edges_h: list[float]) -> DataFrame:
    """What happens after each key's first anchor, by bucket of elapsed hours: rows, distinct keys, share of the cohort.

    The anchor is found by a window minimum over the key, so rows aren't joined with themselves.
    """
    t = F.col(time).cast("timestamp")
    first = F.min(F.when(anchor, t)).over(Window.partitionBy(key))
    after = rows.withColumn("_a", first).where(F.col("_a").isNotNull())
    size = after.agg(F.count_distinct(key).alias("cohort"))
    hours = seconds(t, F.col("_a")) / 3600
    bucket = F.lit(None).cast("int")
    for i in range(len(edges_h) - 1, -1, -1):
        bucket = F.when(F.col("_h") <= edges_h[i], i).otherwise(bucket)
    out = after.withColumn("_h", hours).where("_h > 0").withColumn("bucket", bucket).where("bucket is not null")
    return out.groupBy(what, "bucket").agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys")).join(F.broadcast(size)).select(what, "bucket", "rows", "keys", F.round(100 * F.col("keys") / F.col("cohort"), 6).alias("pct_cohort"))


def keep_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def chronological_holdout(rows: DataFrame, session: str, time: str, test: float) -> DataFrame:
    """``rows`` with split: the sessions that began last are test, ceil(share * n) of them, at least one and not all."""
    starts = rows.groupBy(session).agg(F.min(time).alias("_start"))
    n = starts.count()
    if n < 2:
        raise ValueError("a holdout needs two sessions at least")
    size = min(max(1, -int(-(n * test) // 1)), n - 1)
    late = _last(starts, session, "_start", size, n).select(session, F.lit("test").alias("split"))
    return rows.join(late, session, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def _last(rows: DataFrame, key: str, by: str, size: int, n: int, slack: float = 0.005) -> DataFrame:
    """The ``size`` of ``n`` rows that are last by (by, key). Only those near the cut are ranked, the rest is told by its value alone."""
    share = 1 - size / n
    near = [max(0.0, share - slack), min(1.0, share + slack)]
    lo, hi = rows.agg(F.percentile_approx(by, near, 10_000).alias("q")).first()["q"]
    above, about = rows.agg(F.count_if(F.col(by) > hi), F.count_if(F.col(by).between(lo, hi))).first()
    if not above <= size <= above + about:  # the estimate is off; rank them all
        return rows.orderBy(F.col(by).desc(), F.col(key).desc()).limit(size)
    some = rows.where(F.col(by).between(lo, hi)).orderBy(F.col(by).desc(), F.col(key).desc()).limit(size - above)
    return rows.where(F.col(by) > hi).union(some)


def stratified_sample(rows: DataFrame, stratum: str, key: str, cap: int) -> DataFrame:
    """At most ``cap`` rows: one a stratum at least, the rest in proportion, largest fractions first, ties by name.

    Within a stratum rows are taken in the order of a hash of ``key``. ValueError if there are more strata than ``cap``.
    """
    sizes = rows.groupBy(stratum).agg(F.count("*").alias("n"))
    k, total = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if k > cap:
        raise ValueError(f"{k} strata need a cap of {k} at least")
    if total <= cap:
        return rows
    rest = F.col("n") - 1
    exact = (cap - k) * rest / F.lit(max(1, total - k))
    quota = sizes.withColumn("base", F.floor(exact)).withColumn("frac", exact - F.floor(exact))
    left = cap - k - quota.agg(F.sum("base")).first()[0]
    quota = quota.join(quota.orderBy(F.col("frac").desc(), stratum).limit(left).select(stratum, F.lit(1).alias("extra")), stratum, "left")
    quota = quota.select(stratum, (1 + F.col("base") + F.coalesce("extra", F.lit(0))).alias("quota"))
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(stratum).orderBy(F.xxhash64(key), key)))
    return ranked.join(quota, stratum).where("_n <= quota").drop("_n", "quota")


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A uniform sample of ``n`` rows that doesn't depend on the layout: those of the smallest hashes."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def stability_index(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Population stability: (key, p, q, psi) with shares p of ``old`` and q of ``new``, both at least 1e-6."""
    a = old.groupBy(key).agg(F.count("*").alias("a"))
    b = new.groupBy(key).agg(F.count("*").alias("b"))
    both = a.join(b, key, "full_outer")
    totals = both.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    share = lambda n, t: F.greatest(F.coalesce(n, F.lit(0)) / F.coalesce(t, F.lit(1)), F.lit(1e-6))
    out = both.join(F.broadcast(totals)).select(key, share(F.col("a"), F.col("ta")).alias("p"), share(F.col("b"), F.col("tb")).alias("q"))
    return out.withColumn("psi", (F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p")))


def between(rows: DataFrame, column: str, first: str | None, last: str | None) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; an open end has no bound, and without that column all rows stay.

    What is no date is left out once there is a bound. On a partition column the scan is pruned.
    """
    if column not in rows.columns or first is None and last is None:
        return rows
    day = F.col(column) if rows.schema[column].dataType.typeName() == "date" else F.try_to_date(F.col(column).cast("string"))
    for bound, keep in ((first, lambda b: day >= b), (last, lambda b: day <= b)):
        rows = rows if bound is None else rows.where(keep(F.lit(bound).cast("date")))
    return rows
