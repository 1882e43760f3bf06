"""Best-fit packing of tokenized documents by a linear grouping scheme.

How documents fit depends on their lengths alone, so packing works on the histogram of lengths (one count for each
length up to the capacity, however many documents there are):

1. lengths above ``capacity / small`` are cut into ``groups`` groups of equal counts and rounded up to the largest of
   their group (linear grouping, Fernandez de la Vega and Lueker);
2. the configurations (how many of each rounded length go in one sequence) are optimised by column generation;
3. the actual lengths take the slots of their group, in order, so that sequences of one make-up stay in one run;
4. all that is left is put, longest first, into the tightest remaining space (best fit).

The plan is a list of runs: equal sequences, with a place for every number within a length. Documents are numbered
within their length by a distributed rank and join the plan; the plan's size depends on capacity and groups only.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut, ranked

CAPACITY, END = 4096, 1
#: Groups of large lengths, and the share of the capacity (one over) up to which a length is small: tried in turn.
SCHEMES = ((8, 4), (16, 4), (16, 8), (32, 8))
#: Words whose ids a worker keeps (beyond that those not met lately are given up), and bytes that are tokenized at once.
CACHE, SLICE = 600_000, 8 << 20
#: The steps before the vocabulary under which ids of a text are those of its words in order.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def by_words(spec: dict) -> bool:
    """Whether a tokenizer file has the steps above, then plain BPE, and special tokens that start with ``<`` and hold no space."""
    before, split, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, dict(spec.get("model") or {})
    plain = {"dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"}
    return (
        before.get("normalizers") == NORMALIZERS
        and split.get("pretokenizers") == [{"type": "Split", "pattern": SPLIT, "behavior": "Removed", "invert": True}, BYTES]
        and model.get("type") == "BPE" and not any(model.get(k) for k in plain)
        and all(t["content"][:1] == "<" and len(t["content"].split()) == 1 and not (t["normalized"] or t["lstrip"] or t["rstrip"]) for t in spec.get("added_tokens", []))
    )


class WordTokenizer:
    """Ids of texts. If ``by_words`` holds for the tokenizer, words are encoded once and kept; else whole texts are encoded.

    A word goes through the tokenizer's own steps: normalizer, split into pieces, ids of each piece. Letters of Latin-1
    (which are composed and have lower-case letters of one character) before ASCII punctuation are such pieces, so
    these words skip the first two steps.
    """

    _latin = re.compile("[\0-\xff]*")
    _marks = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"  # without ' (short forms) and < (special tokens)

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_words = by_words(json.load(f))
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        spelt = lambda c: "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c))
        self.spelling = {k: spelt(chr(k)) for k in range(128, 256) if self.by_words and chr(k).isalpha()}  # bytes as the vocabulary spells them

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _piece(self, piece: str) -> bytes:
        """Ids of what the tokenizer's split gives out as one piece."""
        if (ids := self.pieces.get(piece)) is None:
            ids = self.pieces[piece] = np.array([t.id for t in self.tokenizer.model.tokenize(piece)], dtype="<u4").tobytes()
        return ids

    def _learn(self, words: list[str]) -> None:
        normal, split, alone = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str, []
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        piece, latin, marks, spelling = self._piece, self._latin.fullmatch, self._marks, self.spelling
        for w in words:
            a = w.rstrip(marks)
            if a.isascii() and (a.isalpha() or not a):
                ids = piece(a.lower()) if a else b""
                self.words[w] = ids + piece(w[len(a) :]) if len(a) < len(w) else ids
            elif a.isalpha() and latin(a):
                ids = piece(a.lower().translate(spelling))
                self.words[w] = ids + piece(w[len(a) :]) if len(a) < len(w) else ids
            elif "<" in w:
                alone.append(w)
            else:
                self.words[w] = b"".join([self._piece(p) for p, _ in split(normal(w))])
        self.words.update(zip(alone, self._alone(alone)))

    def _ids(self, distinct: list[str]) -> list[bytes]:
        """Ids of each of the distinct words of a slice."""
        if len(self.words) > CACHE // 2:
            self.words, self.older = {}, self.words
        words, older = self.words, self.older
        missing = [w for w in distinct if w not in words]
        words.update({w: older[w] for w in missing if w in older})
        missing = [w for w in missing if w not in older]
        self._learn(missing)
        out = list(map(words.__getitem__, distinct))
        for w in missing:
            if len(w) > 64:  # scripts without spaces make long words, which seldom come back
                del words[w]
        return out

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For one slice of ``texts`` (strings) after the other: the ids of its texts, and where each text's end."""
        ends, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)), 0
        while at < len(texts):
            past = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
            part = pc.fill_null(texts.slice(at, past - at), "")
            at = past
            if not self.by_words:
                each = self._alone(part.to_pylist())
                yield np.frombuffer(b"".join(each), dtype="<u4"), np.cumsum([len(x) // 4 for x in each])
                continue
            split = pc.ascii_split_whitespace(part)  # at ASCII white space; the tokenizer knows the rest
            coded = split.flatten().dictionary_encode()
            each = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            which, size = coded.indices.to_numpy(), np.fromiter(map(len, each), dtype=np.int64, count=len(each)) // 4
            ids, first = np.frombuffer(b"".join(each), dtype="<u4"), np.cumsum(size) - size
            size = size[which]
            past_word = np.concatenate([[0], np.cumsum(size)])
            at_id = np.repeat((first[which] - past_word[:-1]).astype(np.int32), size)  # a slice has far fewer than 2^31 ids
            at_id += np.arange(len(at_id), dtype=np.int32)
            yield ids[at_id], past_word[np.cumsum(pc.list_value_length(split).to_numpy())]


@functools.cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and ``end``, cut at ``capacity``.

    Null and empty texts are ``end`` alone. Repeated rows and ids, null ones among them, give the same pieces each time.
    Only the named columns are read, whatever others are called; of an empty table nothing comes.
    """
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            k = -1
            for ids, ends in encode(b.column(1)):
                begin, raw = 0, ids.tobytes()
                for past in ends.tolist():
                    k += 1
                    own = raw[4 * begin : 4 * past] + last
                    begin = past
                    for p, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at : at + 4 * capacity]
                        row.append(k)
                        piece.append(p)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            columns = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Few-size configurations and how often to use each, rounded down; by column generation (Gilmore and Gomory).

    The linear program's basis has one column for each size; the column to enter is the most valuable knapsack
    filling under the basis's prices. What rounding down leaves over is for the caller to place.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(counts, dtype=float)
    inverse = np.linalg.inv(basis)
    use = inverse @ need
    for _ in range(40 * k):
        prices = np.ones(k) @ inverse
        best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for s, i in sorted((s, i) for i, s in enumerate(sizes)):  # unbounded knapsack, one size at a time, a chain of steps of s
            if prices[i] > 1e-12:
                for at in range(s, capacity + 1, s):
                    w = min(s, capacity + 1 - at)
                    better = best[at - s : at - s + w] + prices[i] > best[at : at + w] + 1e-12
                    best[at : at + w][better] = best[at - s : at - s + w][better] + prices[i]
                    took[at : at + w][better] = i
        at = int(np.argmax(best))
        if best[at] <= 1 + 1e-7:
            break
        column = np.zeros(k)
        while at > 0 and took[at] >= 0:
            column[took[at]] += 1
            at -= sizes[took[at]]
        moved = inverse @ column
        ratio = np.where(moved > 1e-9, use / np.where(moved > 1e-9, moved, 1), np.inf)
        leaves = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaves]):
            break
        basis[:, leaves] = column
        inverse = np.linalg.inv(basis)
        use = np.maximum(inverse @ need, 0)
    return [(tuple(int(round(x)) for x in basis[:, j]), int(use[j] + 1e-6)) for j in range(k) if use[j] + 1e-6 >= 1]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, schemes: tuple[tuple[int, int], ...] = SCHEMES) -> list[tuple[int, int, int, int, int, int]]:
    """The plan of fewest sequences of those that ``schemes`` give; see ``plan_by``."""
    return min((plan_by(histogram, capacity, groups, small) for groups, small in schemes), key=sequences)


def sequences(rows: list[tuple[int, int, int, int, int, int]]) -> int:
    """How many sequences a plan has."""
    return max((sequence + (past - first - 1) // each + 1 for _, first, past, sequence, each, _ in rows), default=0)


def plan_by(histogram: dict[int, int], capacity: int, groups: int, small: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where each document goes: rows (length, first, past, sequence, each, offset).

    Number r within its length, first <= r < past, lies in sequence + (r - first) // each, at
    offset + (r - first) % each * length. Counts may be of any size; the number of rows doesn't depend on them.
    """
    left = {s: n for s, n in sorted(histogram.items(), reverse=True) if n > 0}
    taken: dict[int, int] = defaultdict(int)
    rows, runs, made = [], [], 0  # runs: (space left in each, first sequence, how many)

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        rows.append((length, taken[length], taken[length] + n, sequence, each, offset))
        taken[length] += n
        left[length] -= n

    if over := [s for s in left if s > capacity or s < 1]:
        raise ValueError(f"no sequence holds {over[0]} tokens")
    if left.get(capacity):
        n = left[capacity]
        put(capacity, n, 0, 1, 0)
        made = n
    large = [s for s in left if left[s] and s > capacity // small]
    total = sum(left[s] for s in large)
    members: list[list[int]] = []
    seen = 0
    for s in large:  # descending; a group closes once it holds its share of the count
        if not members or seen * groups >= len(members) * total:
            members.append([])
        members[-1].append(s)
        seen += left[s]
    tops, counts = [g[0] for g in members], [sum(left[s] for s in g) for g in members]
    for config, times in sorted(configurations(tops, counts, capacity), key=lambda c: (-c[1], c[0])):
        times = min([times, *(sum(left[s] for s in members[g]) // a for g, a in enumerate(config) if a)])
        open_ = [(made, times, 0)] if times else []  # sequences of this configuration with equal contents so far
        made += times
        for g, slots in enumerate(config):
            for _ in range(slots):
                split = []
                for first, n, used in open_:
                    while n:
                        s = next(s for s in members[g] if left[s])
                        m = min(n, left[s])
                        put(s, m, first, 1, used)
                        split.append((first, m, used + s))
                        first, n = first + m, n - m
                open_ = split
        runs += [(capacity - used, first, n) for first, n, used in open_ if used < capacity]
    by_space: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for space, first, n in runs:
        by_space[space].append((first, n))
    for s in [s for s in left if left[s]]:
        spaces = [x for x in by_space if x >= s and by_space[x]]
        heapify(spaces)
        while left[s]:
            if not spaces:
                n = -(-left[s] // (capacity // s))
                by_space[capacity].append((made, n))
                made += n
                spaces = [capacity]
            space = spaces[0]
            first, n = by_space[space].pop()
            if not by_space[space]:
                heappop(spaces)
                del by_space[space]
            each = space // s
            full = min(n, left[s] // each)
            filled = [(full, each)] if full else []
            if full < n and left[s] > full * each:
                filled.append((1, left[s] - full * each))  # the last sequence takes fewer
            for m, k in filled:
                put(s, m * k, first, k, capacity - space)
                if space > k * s:
                    by_space[space - k * s].append((first, m))
                first, n = first + m, n - m
            if n:
                by_space[space].append((first, n))
    return rows


def pack(tokenized: DataFrame, id_col: str = "id", capacity: int = CAPACITY, schemes: tuple[tuple[int, int], ...] = SCHEMES, per_task: int = 1_000_000) -> DataFrame:
    """``tokenized`` (id, piece, start, length, ids_crc32) with sequence_id and offset; lengths are 1 to ``capacity``.

    Each row gets a place of its own, repeated rows and null ids as well; rows that are equal in all columns share out
    their places in any order. Of an empty table nothing comes. Other columns are left out, whatever they are called.
    """
    spark, names = tokenized.sparkSession, ["piece", "start", "length", "ids_crc32"]
    tokenized = cut(tokenized.select(F.col(id_col).alias("id"), *names))
    counts = {r["length"]: r["count"] for r in tokenized.groupBy("length").count().collect()}  # at most one row a length
    places = np.array(sorted(plan(counts, capacity, schemes)), dtype=np.int64).reshape(-1, 6)  # bounded by the capacity and the numbers of groups
    past = places[:, 0] << 44 | places[:, 2]
    row = ranked(tokenized, "length", ["id", "piece", "start", "ids_crc32"], "number", sum(counts.values()), per_task)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The run that a row's number within its length falls into, by bisection."""
        for b in batches:
            length, number = b.column(3).to_numpy(), b.column(5).to_numpy()
            _, first, _, sequence, each, offset = places[np.searchsorted(past, length << 44 | number, side="right")].T
            found = (sequence + (number - first) // each, offset + (number - first) % each * length)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *map(pa.array, found)], names=schema.names)

    schema = T.StructType([*tokenized.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    placed = row.select("id", *names, "number").mapInArrow(place, schema)
    return placed if id_col == "id" else placed.withColumnRenamed("id", id_col)
