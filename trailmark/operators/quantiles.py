"""Exact quantiles of all groups at once, by selection: intervals of values that hold the wanted ranks are narrowed.

Each round counts the rows of every interval in ``BINS`` bins and keeps the bins that hold a rank, with their least and
greatest value and the number of rows below. Counts are combined before the shuffle, so a round moves bins, not rows. Once
an interval has few rows, or one value, the rows in it are counted by value and the ranks are read off. No buffer ever
holds a group's values, and a group may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import kept
from .ranges import join_same
from .vocabulary import sized

BINS = 1024
#: An interval of at most so many rows is not narrowed further.
FEW = 65_536
_RANGE = "struct<lo:double,hi:double,below:bigint,n:bigint,ranks:array<bigint>>"


def _place(v: Column, lo: Column, hi: Column, curved: bool) -> Column:
    """The bin of a value between ``lo`` and ``hi``: rises with the value, by its logarithm if ``curved``."""
    bend = (lambda x: F.signum(x) * F.log1p(F.abs(x))) if curved else (lambda x: x * 0.5)
    wide = bend(hi) > bend(lo)
    straight = (v * 0.5 - lo * 0.5) / F.nullif(hi * 0.5 - lo * 0.5, F.lit(0.0))
    share = F.when(wide, (bend(v) - bend(lo)) / F.nullif(bend(hi) - bend(lo), F.lit(0.0))).otherwise(straight)
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS).cast("int"), F.lit(BINS - 1))


def exact(rows: DataFrame, by: list[str], value: str | Column, at: tuple[float, ...], name: str = "q", dear: bool = False) -> DataFrame:
    """(by, n, ``name``): for each group the number of its values and an array of the quantiles ``at``, with linear interpolation.

    Values are taken as doubles; nulls, NaN and infinite ones are left out, and groups that have no other are absent.
    Null groups are groups. ``rows`` are read once for each round; with ``dear`` they are computed and written once first.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    keyed = rows.select(F.struct(*by, F.lit(0).alias("_")).alias("_k"), v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf")))
    keyed = kept(keyed) if dear else keyed
    last = F.col("n") - 1
    wanted = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(last * q).cast("long"), F.ceil(last * q).cast("long")) for q in at))))
    ends = keyed.groupBy("_k").agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    state = kept(ends.select("_k", "n", F.array(F.struct("lo", "hi", F.lit(0).cast("long").alias("below"), "n", wanted.alias("ranks"))).cast(f"array<{_RANGE}>").alias("r")))
    open_ = lambda x: (x["n"] > FEW) & (x["lo"] < x["hi"])
    inside = lambda x: (x["lo"] <= F.col("_v")) & (F.col("_v") <= x["hi"])
    curved = True
    while state.where(F.exists("r", open_)).limit(1).count():
        wide = state.where(F.exists("r", open_)).select("_k", F.filter("r", open_).alias("r"))
        hit = keyed.join(sized(wide), "_k").withColumn("x", F.get(F.filter("r", inside), 0)).where("x is not null")
        bins = hit.groupBy("_k", F.col("x.lo").alias("from"), _place(F.col("_v"), F.col("x.lo"), F.col("x.hi"), curved).alias("bin"), F.col("x.below").alias("below"), F.col("x.ranks").alias("ranks"))
        bins = bins.agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        earlier = F.sum("n").over(Window.partitionBy("_k", "from").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))  # at most BINS rows
        bins = bins.withColumn("below", F.col("below") + F.coalesce(earlier, F.lit(0)))
        bins = bins.withColumn("ranks", F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))).where(F.size("ranks") > 0)
        narrowed = bins.groupBy("_k").agg(F.collect_list(F.struct("lo", "hi", "below", "n", "ranks").cast(_RANGE)).alias("more"))
        joined = state.join(narrowed, "_k", "left")
        state = kept(joined.select("_k", "n", F.when(F.col("more").isNull(), F.col("r")).otherwise(F.concat(F.filter("r", lambda x: ~open_(x)), "more")).alias("r")))
        curved = False
    found = keyed.join(sized(state.select("_k", "r")), "_k").withColumn("x", F.get(F.filter("r", inside), 0)).where("x is not null")
    counts = found.groupBy("_k", F.col("x.lo").alias("from"), "_v").agg(F.count("*").alias("n"), F.max("x.below").alias("below"))
    earlier = F.sum("n").over(Window.partitionBy("_k", "from").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))  # at most FEW rows
    counts = counts.withColumn("below", F.col("below") + F.coalesce(earlier, F.lit(0)))
    every = sized(state.select("_k", F.flatten(F.transform("r", lambda x: x["ranks"])).alias("ranks")))
    ranks = counts.join(every, "_k").select("_k", "_v", F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n"))).alias("ranks")).where(F.size("ranks") > 0)
    values = ranks.groupBy("_k").agg(F.map_from_entries(F.flatten(F.collect_list(F.transform("ranks", lambda r: F.struct(r, F.col("_v")))))).alias("m"))
    low, high = (lambda q: F.element_at("m", F.floor(last * q).cast("long"))), (lambda q: F.element_at("m", F.ceil(last * q).cast("long")))
    between = lambda q: low(q) + (high(q) - low(q)) * (last * q - F.floor(last * q))
    out = state.select("_k", "n").join(values, "_k").withColumn(name, F.array(*(between(q) for q in at)))
    return out.select(*(F.col(f"_k.{c}").alias(c) for c in by), "n", name)


def one(rows: DataFrame, by: list[str], value: str | Column, q: float, name: str, dear: bool = False) -> DataFrame:
    """(by, ``name``): one quantile of each group."""
    return exact(rows, by, value, (q,), "_q", dear).select(*by, F.col("_q")[0].alias(name))


def beside(groups: DataFrame, rows: DataFrame, by: list[str], wanted: dict[str, tuple[str | Column, tuple[float, ...]]], dear: bool = False) -> DataFrame:
    """``groups`` (a row a group) with an array of quantiles of ``rows`` for each (name: (value, at)); null where there is no value."""
    for name, (value, at) in wanted.items():
        found = exact(rows, by, value, at, name, dear).drop("n")
        groups = join_same(groups, found, by) if by else groups.join(F.broadcast(found), how="left")  # one row
    return groups
