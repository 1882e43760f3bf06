"""How filters of a corpus act on each other: every order of them, step by step, by a recursive common table expression.

Documents are reduced to cells: for each part of the corpus and each set of filters that fail (a mask of bits) the number
of documents, of good and of toxic ones. The recursion never sees a document. It starts from all masks with no filter
applied, extends each prefix of filters by each unused letter, joins what that letter does to each mask under the bits
applied so far, and carries the bits on; its rows depend on the number of filters alone (five: 10,432). Each level holds
what its step removes, keeps and finds removed already; joined to the cells and summed, that is one row a part and prefix.

Nothing gathers a group of equal texts: the first of each text is found by a grouped minimum that is combined before the
shuffle, and the others are what is left of the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import SPACE, cut

#: More filters than this have more rows in the recursion than Spark allows by default (a million).
MOST_FILTERS = 6
#: The limits of the query's filters.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 100, 80, 10, "[#$%&*|]"
COUNTS = ("n", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """The conditions A to D of a text (not null) under which it fails: few words, few distinct words, capitals, symbols."""
    words = F.filter(F.split(F.translate(text, SPACE[1:], " " * (len(SPACE) - 1)), " "), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS, "B": 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > UPPER_PERCENT * F.length(text).cast("long"), "D": text.rlike(SYMBOLS),
    }


def cells(documents: DataFrame, labels: DataFrame, filters: dict[str, Column], id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail; the bit after the last is set for copies.

    A copy has the text of a document with a smaller id. Null texts count as empty, null parts as the empty string; rows
    without an id are no copies and make none. Rows that repeat an id are documents of their own, none a copy of the
    other. A document is good or toxic if any row of ``labels`` (doc_id, quality, toxic) says so. Columns of other names
    don't matter. A text is held as its array of words while it is judged, about ten times its length.
    """
    said = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    mask = sum((F.coalesce(f, F.lit(False)).cast("int") * (1 << i) for i, f in enumerate(filters.values())), F.lit(0))
    body = F.coalesce(F.col(text), F.lit(""))
    judged = documents.select(F.col(id).alias("_doc"), F.coalesce(F.col(part), F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(body, 256)).alias("h"))
    told = judged.join(said, F.col("_doc") == F.col("_id"), "left").select("_doc", "part", "mask", "h", *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS[1:]))
    kinds = ["part", "mask", "good", "toxic"]
    rows = cut(told.groupBy("h", "_doc", *kinds).agg(F.count("*").alias("n")))
    first = rows.where(F.col("_doc").isNotNull()).groupBy("h", "_doc").agg(F.collect_list(F.struct(*kinds, "n")).alias("same"))
    first = first.groupBy("h").agg(F.min_by("same", "_doc").alias("same")).select(F.inline("same"))
    first = first.union(rows.where(F.col("_doc").isNull()).select(*kinds, "n"))
    copy = F.lit(1 << len(filters))
    signed = lambda df, mask, sign: df.select("part", mask.alias("mask"), (sign * F.col("n")).alias("n"), *(sign * F.col("n") * F.col(c) for c in COUNTS[1:]))
    plain, marked = F.col("mask"), F.col("mask") + copy
    moved = signed(rows, marked, F.lit(1)).union(signed(first, marked, F.lit(-1))).union(signed(first, plain, F.lit(1))).toDF("part", "mask", *COUNTS)
    return moved.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in COUNTS)).where("n > 0")


def walk(spark: SparkSession, letters: str) -> DataFrame:
    """(prefix, step, letter, bit, mask, removed, kept, redundant): what each extension of each prefix does to each mask."""
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"between one and {MOST_FILTERS} filters with letters of their own")
    bits = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE masks AS (SELECT CAST(id AS int) AS mask FROM range({1 << len(letters)})),
        letters(letter, bit) AS (VALUES {bits}),
        cells AS (
          SELECT a.mask AS applied, l.letter, l.bit, m.mask, (m.mask & a.mask) = 0 AND (m.mask & l.bit) <> 0 AS removed,
            (m.mask & (a.mask | l.bit)) = 0 AS kept, (m.mask & a.mask) <> 0 AND (m.mask & l.bit) <> 0 AS redundant
          FROM masks a, letters l, masks m WHERE (a.mask & l.bit) = 0
        ),
        walk(prefix, applied, step, letter, bit, mask, removed, kept, redundant) AS (
          SELECT '', 0, 0, '', 0, mask, false, true, false FROM masks
          UNION ALL
          SELECT concat(w.prefix, c.letter), w.applied | c.bit, w.step + 1, c.letter, c.bit, c.mask, c.removed, c.kept, c.redundant
          FROM walk w JOIN cells c ON c.applied = w.applied AND c.mask = w.mask
        )
        SELECT prefix, step, letter, bit, mask, removed, kept, redundant FROM walk WHERE step > 0""")


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order of all ``letters`` and step, from ``counted`` as ``cells`` gives it; bit i is letter i.

    kept, removed, redundant (fails here, removed before), unique_fails (fails this filter alone), good_lost and toxic_lost
    (removed here), shapley (removed by this step's filter, summed over all orders). No cells, no rows.
    """
    steps = cut(walk(counted.sparkSession, letters))
    total = lambda condition, count="n": F.sum(F.when(condition, F.col(count)).otherwise(0)).cast("long")
    each = counted.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "letter")  # a table of fixed size
    each = each.agg(
        total(F.col("kept")).alias("kept"), total(F.col("removed")).alias("removed"), total(F.col("redundant")).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(F.col("removed"), "good").alias("good_lost"), total(F.col("removed"), "toxic").alias("toxic_lost"),
    )
    ends = F.factorial(F.lit(len(letters)) - F.col("step"))  # orders that begin with the prefix
    shapley = each.groupBy("part", "letter").agg(F.sum(F.col("removed") * ends).cast("long").alias("shapley"))
    orders = steps.where((F.col("step") == len(letters)) & (F.col("mask") == 0)).select(F.col("prefix").alias("filter_order"))
    orders = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("at")).withColumn("prefix", F.substring("filter_order", F.lit(1), F.col("at")))
    rows = each.join(F.broadcast(orders), "prefix").join(shapley, ["part", "letter"])
    return rows.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
