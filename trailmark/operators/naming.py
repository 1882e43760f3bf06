"""Names for clusters: token evidence, the cascade from feature to module, carrying names to a new model, reviewed tables."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import BOS, EOS, MISSING, NOISE
from .vocabulary import sized

#: Last parts of targets that only navigate or dismiss, so that they say nothing of their own.
GENERIC_TARGETS = (
    "btn_back", "back", "backbutton", "handleback", "pop_back", "adsview", "view_os_noti", "popup", "pop_up_close", "close", "show", "button", "buttons", "body", "tab", "more", "null",
    "unknown", "<missing>", "nav_home", "nav_payement", "nav_payment", "nav_profile", "nav_support", "nav_promotion", "call_api_get_action",
)


def evidence_text(token: Column) -> Column:
    """What a token says: a view its screen; an action its target, or its screen where the target is generic.

    Marks of start and end and missing screens say nothing; a token of another make-up stands for itself.
    """
    rest = F.regexp_extract(token, r"^[^@]*@(.*)$", 1)
    screen, target = F.substring_index(rest, "#", 1), F.regexp_extract(rest, r"#(.*)$", 1)
    generic = F.lower(F.substring_index(target, "/", -1)).isin(*GENERIC_TARGETS)
    said = F.when(F.startswith(token, F.lit("action@")) & F.contains(rest, F.lit("#")), F.when(generic, screen).otherwise(target)).otherwise(rest)
    said = F.when(token.isin(BOS, EOS), "").when(~F.contains(token, F.lit("@")), token).otherwise(said)
    return F.when(said == MISSING, "").otherwise(said)


def deepest_match(tokens: DataFrame, token: str, patterns: dict[str, str]) -> DataFrame:
    """(token, node): the pattern whose match ends last, then is longest; null where none matches or two are as deep.

    Each distinct token is matched once.
    """
    compiled = {k: re.compile(p, re.IGNORECASE) for k, p in patterns.items()}

    @F.pandas_udf("string")
    def match(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            found = sorted(((m.end(), m.end() - m.start(), k) for k, p in compiled.items() for m in p.finditer(text or "")), reverse=True)
            return found[0][2] if found and (len(found) == 1 or found[0][:2] != found[1][:2] or found[0][2] == found[1][2]) else None

        return texts.map(one)

    distinct = tokens.select(token).distinct()
    return distinct.withColumn("node", match(evidence_text(F.col(token))))


def evidence_scores(grams: DataFrame, nodes: DataFrame) -> DataFrame:
    """(platform, cluster, node, score, rows, coverage) from n-grams (platform, cluster, rank, ngram, lift, mass) and their tokens' nodes.

    A row's weight is mass * max(ln(1 + lift), 0.1), split evenly over the distinct nodes of its tokens.
    """
    each = grams.select("platform", "cluster", "rank", "lift", "mass", F.explode(F.array_distinct(F.split("ngram", " "))).alias("token")).join(nodes, "token").where("node is not null")
    own = each.select("platform", "cluster", "rank", "lift", "mass", "node").distinct()
    share = F.count("*").over(Window.partitionBy("platform", "cluster", "rank"))
    weighed = own.withColumn("w", F.col("mass") * F.greatest(F.log1p("lift"), F.lit(0.1)) / share)
    totals = grams.groupBy("platform", "cluster").agg(F.sum("mass").alias("total"))
    out = weighed.groupBy("platform", "cluster", "node").agg(F.sum("w").alias("score"), F.count("*").alias("rows"), F.sum("mass").alias("mass"))
    return out.join(totals, ["platform", "cluster"]).select("platform", "cluster", "node", "score", "rows", (F.col("mass") / F.col("total")).alias("coverage"))


def cascade(scores: DataFrame, clusters: DataFrame, least_rows: int = 2, least_mass: float = 0.15, least_share: float = 0.60) -> DataFrame:
    """A node for each cluster: its best feature if that has enough rows, mass and share, else submodule, else module.

    Nodes are ids like ``M01.02.03``; a level is named by its prefix (9, 6 or 3 characters). Noise is never named.
    """
    out = clusters.select("platform", "cluster").distinct()
    for level, size in (("feature", 9), ("submodule", 6), ("module", 3)):
        at = scores.where(F.length("node") >= size).groupBy("platform", "cluster", F.substring("node", 1, size).alias("node")).agg(F.sum("score").alias("score"), F.sum("rows").alias("rows"), F.sum("coverage").alias("coverage"))
        w = Window.partitionBy("platform", "cluster")
        best = at.withColumn("share", F.col("score") / F.sum("score").over(w)).withColumn("r", F.row_number().over(w.orderBy(F.col("score").desc(), "node"))).where("r = 1")
        good = best.where((F.col("rows") >= least_rows) & (F.col("coverage") >= least_mass) & (F.col("share") >= least_share))
        out = out.join(good.select("platform", "cluster", F.col("node").alias(level), F.round("share", 4).alias(f"{level}_share")), ["platform", "cluster"], "left")
    named = F.col("cluster") != NOISE
    first = lambda *cs: F.coalesce(*(F.col(c) for c in cs))
    return out.select(
        "platform", "cluster", F.when(named, first("feature", "submodule", "module")).alias("node"),
        F.when(~named, "noise").when(F.col("feature").isNotNull(), "feature").when(F.col("submodule").isNotNull(), "submodule").when(F.col("module").isNotNull(), "module").otherwise("unclassified").alias("level"),
        F.when(named, first("feature_share", "submodule_share", "module_share")).alias("share"), F.when(named & F.col("feature").isNotNull(), "high").when(named & first("submodule", "module").isNotNull(), "medium").otherwise("low").alias("confidence"),
    )


def carry_names(pairs: DataFrame, names: DataFrame, coverage: float = 0.5, share: float = 0.7) -> DataFrame:
    """Names of an old model for a new one's clusters, from ``pairs`` (new, old, n) and ``names`` (old, taxonomy_id).

    With enough of a cluster's rows in named old clusters: the leading old cluster, else the leading id, submodule or
    module, each strictly ahead and with ``share`` of the covered rows; else it is up for review. Otherwise it is new.
    """
    total = pairs.groupBy("new").agg(F.sum("n").alias("sampled"))
    covered = pairs.where(F.col("old") != NOISE).join(names, "old")
    out = total.join(covered.groupBy("new").agg(F.sum("n").alias("covered")), "new", "left").withColumn("coverage", F.coalesce("covered", F.lit(0)) / F.col("sampled"))
    steps = (("old_cluster", F.col("old").cast("string"), 0), ("taxonomy_id", F.col("taxonomy_id"), 0), ("submodule", F.substring("taxonomy_id", 1, 6), 6), ("module", F.substring("taxonomy_id", 1, 3), 3))
    for step, key, least in steps:
        counts = covered.where(F.length("taxonomy_id") >= least).groupBy("new", key.alias("k")).agg(F.sum("n").alias("n"), F.min("taxonomy_id").alias("id"))
        w = Window.partitionBy("new").orderBy(F.col("n").desc(), "k")
        lead = counts.withColumn("r", F.row_number().over(w)).withColumn("second", F.lead("n").over(w)).where("r = 1")
        ahead = F.coalesce(F.col("n") > F.col("second"), F.lit(True))
        out = out.join(lead.select("new", (F.col("id") if step == "old_cluster" else F.col("k")).alias(step), F.col("n").alias(f"{step}_n"), ahead.alias(f"{step}_ahead")), "new", "left")
    enough = F.col("coverage") >= coverage
    ok = {s: enough & F.col(f"{s}_ahead") & (F.col(f"{s}_n") / F.col("covered") >= share) for s, _, _ in steps}
    step, node = F.when(enough, "review").otherwise("new"), F.col("taxonomy_id")
    for s in [s for s, _, _ in steps][::-1]:
        step, node = F.when(ok[s], s).otherwise(step), F.when(ok[s], F.col(s)).otherwise(node)
    return out.select("new", F.round("coverage", 4).alias("coverage"), step.alias("step"), node.alias("taxonomy_id"))


def apply_names(rows: DataFrame, cluster: str, names: DataFrame, strict: bool = False) -> DataFrame:
    """``rows`` with the columns of ``names`` (cluster, ...); unknown clusters take the noise row's, or raise if ``strict``."""
    columns = [c for c in names.columns if c != "cluster"]
    clean = rows.drop(*columns)
    if strict and not (lost := clean.select(F.col(cluster).alias("cluster")).distinct().join(names, "cluster", "left_anti").where(F.col("cluster") != NOISE)).isEmpty():
        raise ValueError(f"clusters without a name: {[r[0] for r in lost.limit(5).collect()]}")
    noise = names.where(F.col("cluster") == NOISE).select(*(F.col(c).alias(f"_n_{c}") for c in columns)).limit(1)
    out = clean.join(sized(names.withColumnRenamed("cluster", "_c")), F.col(cluster) == F.col("_c"), "left").join(F.broadcast(noise), how="left")  # a model's clusters; one row
    return out.select(*clean.columns, *(F.when(F.col("_c").isNull(), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in columns))


def validate_taxonomy(leaves: DataFrame) -> DataFrame:
    """(problem, taxonomy_id, n): blank levels, ids and paths that occur twice. Expects taxonomy_id, family, submodule, detail."""
    path = F.concat_ws(" | ", "family", "submodule", "detail")
    blank = leaves.where((F.coalesce(F.trim("family"), F.lit("")) == "") | (F.coalesce(F.trim("taxonomy_id"), F.lit("")) == "")).select(F.lit("blank_level").alias("problem"), "taxonomy_id", F.lit(1).cast("long").alias("n"))
    ids = leaves.groupBy("taxonomy_id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_id"), "taxonomy_id", "n")
    paths = leaves.groupBy(path.alias("p")).agg(F.count("*").alias("n"), F.min("taxonomy_id").alias("taxonomy_id")).where("n > 1").select(F.lit("duplicate_path"), "taxonomy_id", "n")
    return blank.union(ids).union(paths)


def edit_taxonomy(leaves: DataFrame, edits: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Taxonomy after ``edits``, named clusters after it, and an audit of what changed.

    All have taxonomy_id, family, submodule, detail; ``edits`` also deleted. Leaves are put in or replaced by id, deleted
    ones go; clusters of a changed leaf are renamed, those of a deleted one are marked for review. Equal edits change nothing.
    """
    levels = ["family", "submodule", "detail"]
    old = leaves.select("taxonomy_id", F.struct(*levels).alias("old"))
    new = edits.select("taxonomy_id", F.struct(*levels).alias("new"), F.coalesce("deleted", F.lit(False)).alias("deleted"))
    both = old.join(new, "taxonomy_id", "full_outer")
    kind = F.when(F.col("deleted") & F.col("old").isNotNull(), "delete").when(F.col("deleted"), None).when(F.col("old").isNull(), "insert").when(F.col("new").isNotNull() & (F.col("old") != F.col("new")), "update")
    audit = both.withColumn("change", kind).where("change is not null").select("taxonomy_id", "change", "old", "new")
    after = both.where(~F.coalesce("deleted", F.lit(False))).select("taxonomy_id", F.coalesce("new", "old").alias("l")).select("taxonomy_id", "l.*")
    clusters = named.join(audit.select("taxonomy_id", "change", F.col("new").alias("_to")), "taxonomy_id", "left")
    clusters = clusters.select(*(F.when(F.col("change") == "update", F.col(f"_to.{c}")).otherwise(F.col(c)).alias(c) if c in levels else F.col(c) for c in named.columns), (F.coalesce(F.col("change") == "delete", F.lit(False))).alias("needs_review"))
    return after, clusters, audit


def named_catalog(names: DataFrame, rows: DataFrame, cluster: str, platform: str) -> DataFrame:
    """Each named cluster of ``names`` (cluster, ...) with the platform, its number of ``rows`` and its share of those in named clusters; absent clusters have 0."""
    counts = rows.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("size"))
    out = names.join(counts, "cluster", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("long")))
    total = F.greatest(counts.agg(F.coalesce(F.sum("size"), F.lit(0))).scalar(), F.lit(1))
    return out.withColumns({"share": F.round(F.col("size") / total, 8), "platform": F.lit(platform)})


def label_columns(rows: DataFrame, english: bool = True) -> DataFrame:
    """``rows`` with type_label and family_label: journey_type and business_family, in English their codes where there are any, else a dash."""
    of = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    kind, family = F.coalesce(of("journey_type"), F.lit("-")), F.coalesce(of("business_family"), F.lit("-"))
    if english:
        kind, family = F.coalesce(of("journey_type_en"), kind), F.initcap(F.replace(F.coalesce(of("business_family_code"), family), F.lit("_"), F.lit(" ")))
    return rows.withColumns({"type_label": kind, "family_label": family})


def shared_level(evidence: DataFrame, cluster: str, node: str) -> DataFrame:
    """(cluster, node, level, agreed): the deepest level of the taxonomy on which all of a cluster's nodes agree.

    Nodes are ids like ``M01.02.03``; the levels are their prefixes of 9, 6 and 3 characters. A prefix is agreed on if its
    least and its greatest are the same and no node is shorter, so ties decide nothing and only two values a level and
    cluster are kept. Null nodes say nothing; a cluster without a node, or whose nodes share no module, has none.
    """
    known = evidence.groupBy(cluster)
    sizes = {"feature": 9, "submodule": 6, "module": 3}
    prefix = lambda n: F.substring(node, 1, n)
    one = lambda n: F.when((F.min(F.length(node)) >= n) & (F.min(prefix(n)) == F.max(prefix(n))), F.min(prefix(n)))
    found = known.agg(*(one(n).alias(level) for level, n in sizes.items()), F.count(node).alias("agreed"))
    level = F.lit("unclassified")
    for name in reversed(sizes):
        level = F.when(F.col(name).isNotNull(), name).otherwise(level)
    return found.select(F.col(cluster).alias("cluster"), F.coalesce(*sizes).alias("node"), level.alias("level"), "agreed")


def reviewed(tokens: DataFrame, rules: DataFrame, hubs: tuple[str, ...] = ()) -> DataFrame:
    """(cluster, node, source) of clusters from their ``tokens`` (cluster, token) by reviewed ``rules`` (token, node).

    Tokens of ``hubs`` (home pages and the like) lead everywhere, so their rules count only where a cluster has no other
    rule. All of a cluster's rules together give the deepest level that they share (``shared_level``); source is rule, hub
    if only hubs spoke, or none.
    """
    hits = tokens.select("cluster", "token").distinct().join(rules.select("token", "node").distinct(), "token", "left")
    hub = F.col("token").isin(*hubs) & F.col("node").isNotNull() if hubs else F.lit(False)
    hits = hits.withColumns({"own": F.when(~hub, F.col("node")), "hub": F.when(hub, F.col("node"))})
    speaks = hits.groupBy("cluster").agg(F.count("own").alias("n_own"), F.count("hub").alias("n_hub"))
    chosen = hits.join(speaks, "cluster").select("cluster", F.when(F.col("n_own") > 0, F.col("own")).otherwise(F.col("hub")).alias("node"))
    found = shared_level(chosen, "cluster", "node").join(speaks, "cluster")
    return found.select("cluster", "node", "level", F.when(F.col("n_own") > 0, "rule").when(F.col("n_hub") > 0, "hub").otherwise("none").alias("source"))
