"""The trie of conversations' prefixes, from whole sequences: equal ones are one, leaves are what is no one's prefix.

Turns are numbered by one global sort, dealt in ranges, so a conversation of any length is spread over tasks. The key of a
prefix is made of sums of hashes of (place, role, text): sums are added up by windows over chunks of a conversation, and
the sums of earlier chunks are added to later ones. Identical conversations then collapse into one sequence with a
weight, its smallest member and the digest of its members' ids. Proper prefixes of sequences, taken away from all
sequences by an anti join, leave the leaves. Nodes are groups of the sequences' prefixes, with weights summed.

Sums over a subtree need no walk: a node's text counts once for each conversation in all sequences below, which are sums
along each sequence, less once for the node itself. Each node belongs to the sequence of its smallest member, a sequence
owns all its nodes from some depth on, so what it owns below a node is the smaller of what is below and what it owns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import cut

#: Turns of a chunk; ids in one piece of an end list.
CHUNK, PIECE = 4096, 4096
_SUMS = ("s0", "s1", "s2", "s3")
_WORD = r"[^ \t-\r]+"


def said() -> tuple:
    """(role, text, what): role and text without nulls, and the digest of both."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return role, text, F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, what, words): turns numbered from 0 in each conversation, by turn (null first), then role and text.

    ``what`` is a digest of role and text, words the number of words of the text; null roles and texts are empty. Turns
    without a conversation are left out; repeated rows are turns of their own.
    """
    role, text, what = said()
    id, turn, at = F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.monotonically_increasing_id()
    rows = turns.where(id.isNotNull()).select(id.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), at.alias("_at"))
    asc = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("_at")]
    dealt = rows.repartitionByRange(*asc).sortWithinPartitions(*asc)
    words = F.regexp_count("text", F.lit(_WORD)).cast("long")
    kept = cut(dealt.select("conv_id", what.alias("what"), words.alias("words"), F.spark_partition_id().alias("part"), at.alias("_at")))
    # only a conversation that crosses a border has a second part: fewer rows than there are partitions
    parts = kept.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    later = F.broadcast(parts.withColumn("before", before).where(F.col("before").isNotNull()).select("conv_id", "part", "before"))
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("_at")) - 1
    return kept.withColumn("own", own).join(later, ["conv_id", "part"], "left").select("conv_id", (F.col("own") + F.coalesce("before", F.lit(0))).alias("pos"), "what", "words")


def rebuilt(turns: DataFrame, period: int = 20, most: int = 4) -> DataFrame:
    """``turns`` (as ``numbered`` gives them) with the head of each conversation replaced, and a row of pos -1 for each.

    Of conversation c the first h turns, h = crc32(c as text) % ``most``, are those of conversation c - c % ``period``: all
    it has if they are fewer, none if it doesn't exist.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % most
    source = c - c % period
    heads = turns.where((c == source) & (F.col("pos") < most - 1)).groupBy(c.alias("source")).agg(F.array_sort(F.collect_list(F.struct("pos", "what", "words"))).alias("head"))
    each = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(c, h.alias("h"), source.alias("source"))
    taken = each.join(heads, "source", "left").select(c, "h", F.coalesce(F.filter("head", lambda x: x["pos"] < F.col("h")), F.array().cast("array<struct<pos:bigint,what:binary,words:bigint>>")).alias("head"))
    front = taken.select(c, F.inline("head"))
    none = taken.select(c, F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("binary").alias("what"), F.lit(0).cast("long").alias("words"))
    lengths = taken.select(c, F.col("h").alias("own_from"), F.size("head").cast("long").alias("at"))
    tail = turns.join(lengths, "conv_id").where(F.col("pos") >= F.col("own_from")).select(c, (F.col("pos") - F.col("own_from") + F.col("at")).alias("pos"), "what", "words")
    return front.unionByName(tail).unionByName(none)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, up, what, words, so_far): every prefix of every conversation, with its key and its parent's.

    ``turns`` has rows (conv_id, pos, what, words), pos gapless from 0, and one of pos -1 for each conversation. ``words``
    counts the last turn's words, ``so_far`` those of all.
    """
    digest = F.md5(F.concat(F.coalesce("what", F.lit(b"")), F.col("pos").cast("string").cast("binary")))
    limb = lambda i: F.when(F.col("pos") < 0, F.lit(0)).otherwise(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long"))
    rows = turns.withColumns({"chunk": F.floor(F.col("pos") / CHUNK), **{s: limb(i) for i, s in enumerate(_SUMS)}})
    sums = [*_SUMS, "words"]
    chunks = rows.groupBy("conv_id", "chunk").agg(*(F.sum(s).alias(f"_{s}") for s in sums))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", *(F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}") for s in sums))
    here = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.withColumns({f"{s}_": F.sum(s).over(here) for s in sums}).join(chunks, ["conv_id", "chunk"])
    total = {s: F.col(f"{s}_") + F.col(f"_{s}") for s in sums}
    key = lambda pos, cs: F.unhex(F.md5(F.concat_ws(",", pos.cast("string"), *(c.cast("string") for c in cs))))
    return whole.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), key(F.col("pos"), [total[s] for s in _SUMS]).alias("key"),
        F.when(F.col("pos") >= 0, key(F.col("pos") - 1, [total[s] - F.col(s) for s in _SUMS])).alias("up"), "what", "words", total["words"].alias("so_far"),
    )


def ends(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the ids of each key, in order, joined by commas.

    Ids are put into pieces by range where they are, so that what meets for one key is a list of long strings; it
    streams through the digest, which by its nature reads them in order, and is never held.
    """
    pieces = members.groupBy("key", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(F.collect_list("conv_id").alias("ids"))
    pieces = pieces.select("key", "piece", F.array_join(F.transform(F.array_sort("ids"), lambda i: i.cast("string")), ",").alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["key", "ends_sha256"])

    in_order = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return in_order.mapInArrow(digests, "key binary, ends_sha256 string")


def nodes(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``turns``, the root included; ``turns`` as ``prefixes`` takes them.

    key, up (the parent's key), what (the digest of the last turn, see ``with_texts``), conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256. No conversations, no nodes; conversations without turns are members of the root alone.
    """
    all_ = cut(prefixes(turns))
    last = all_.groupBy("conv_id").agg(F.max_by(F.struct("key", "so_far"), "depth").alias("end")).select("conv_id", "end.key", F.col("end.so_far").alias("total"))
    last = cut(last)
    sequences = last.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.max("total").alias("total"))
    inner = all_.where("up is not null").select(F.col("up").alias("key")).distinct()
    leaves = sequences.join(inner, "key", "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    sequences = cut(sequences.join(leaves, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(0).cast("long"))).withColumnRenamed("key", "full"))
    weighted = cut(all_.join(sequences, "conv_id"))
    same = [F.max(c).alias(c) for c in ("depth", "up", "what", "words")]
    plain = weighted.groupBy("key").agg(F.min("conv_id").alias("conv_id"), *same, F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"))
    plain = cut(plain)
    owned = plain.groupBy("conv_id").agg(F.sum("words").alias("owned"))
    below = F.col("total") - F.col("so_far") + F.col("words")
    saved = weighted.join(owned, "conv_id", "left").groupBy("key").agg(F.sum(F.col("weight") * below - F.least(below, F.coalesce("owned", F.lit(0)))).alias("saved_tokens"))
    children = plain.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("n_children"))
    out = plain.join(saved, "key").join(children, "key", "left").join(ends(last.select("key", "conv_id")), "key", "left")
    above = plain.select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return out.join(above, "up", "left").select(
        "key", "up", "what", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def with_texts(found: DataFrame, turns: DataFrame) -> DataFrame:
    """``found`` nodes with role and text of their last turn, from the ``turns`` (conv_id, turn, role, text); null at the root."""
    role, text, what = said()
    return found.join(turns.select(what.alias("what"), role.alias("role"), text.alias("text")).dropDuplicates(["what"]), "what", "left")
