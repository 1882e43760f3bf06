"""Neighbours, the conversation trie and the filter audit against brute force, on awkward tables."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmark.llm import conversation_trie, filter_audit, neighbours, queries

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    """Exact lists: usable distinct rows, padded, all candidates but the query's own id."""
    ok = [(i, np.array([*v], float)) for i, v in {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}]
    width = max((len(v) for _, v in ok), default=0)
    ids, x = [i for i, _ in ok], np.array([np.pad(v, (0, width - len(v))) for _, v in ok])
    out = {}
    for i, v in ok:
        if i % every == 0:
            best = sorted((-float(np.dot(x[j], np.pad(v, (0, width - len(v))))), ids[j]) for j in range(len(ids)) if ids[j] != i)[:k]
            out[i] = [(j, -s) for s, j in best]
    return out


def found(spark, rows, k, every=3, schema="vec_id long, embedding array<float>"):
    got = neighbours.nearest(spark.createDataFrame(rows, schema), lambda i: i % every == 0, k).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("kind", ["isotropic", "clustered", "lengths"])
def test_neighbours_recall_over_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "BLOCK", 100)  # many blocks, rounds and query chunks
    monkeypatch.setattr(neighbours, "QUERIES", 64)
    rng = np.random.default_rng(7)
    x = rng.standard_normal((900, 24))
    if kind == "clustered":
        x = rng.standard_normal((12, 24))[rng.integers(0, 12, 900)] * 3 + 0.3 * x
    if kind == "lengths":
        x *= np.exp(rng.standard_normal((900, 1)))
    x = x.astype(np.float32)
    x[300:600] = x[5]  # a third of all rows is one vector
    rows = [(int(i), [float(f) for f in v]) for i, v in enumerate(x)]
    got, want = found(spark, rows, 20), brute(rows, 20, 3)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    exact = {i: np.array(v) for i, v in rows}
    for q, list_ in got.items():
        assert all(s == pytest.approx(float(exact[i] @ exact[q]), rel=1e-12, abs=1e-12) for i, s in list_)
        assert list_ == sorted(list_, key=lambda p: (-p[1], p[0]))


def test_neighbours_on_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5]), (3, [-1.0, -0.0]), (6, [-1.0, 0.0]), (9, None), (12, [0.0, 0.0]), (15, [nan, 1.0]), (18, [inf, 1.0]), (21, [None, 1.0]), (None, [1.0, 1.0]), (24, []), (4, [1.0, 1.0]), (4, [2.0, 2.0])]
    got, want = found(spark, rows, 3), {}
    for q, v in ((0, (1, 0)), (3, (-1, 0))):
        want[q] = sorted(((i, float(np.dot(np.pad(np.array(w, float), (0, 2 - len(w))), v))) for i, w in {(i, tuple(w)) for i, w in rows if i in (0, 1, 2, 3, 4, 6) and w} if i != q), key=lambda p: (-p[1], p[0]))[:3]
    assert {q: got[q] for q in want} == want
    both = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda i: i == 4, 3).collect()
    assert len(both) == 6 and all(r.vec_id != 4 for r in both)  # an id with two vectors asks with both
    assert found(spark, [], 3) == {} and found(spark, [(0, None), (3, [0.0])], 3) == {}
    assert found(spark, [(0, [1.0])], 3) == {} and found(spark, [(0, [1.0]), (3, [2.0])], 3) == {0: [(3, 2.0)], 3: [(0, 2.0)]}
    named = spark.createDataFrame([(0, [1.0], 1, "x", 2.0), (3, [1e30], 2, "y", 3.0)], "vec_id long, embedding array<double>, v int, h string, score double")
    assert {(r.query_id, r.vec_id): r.score for r in neighbours.nearest(named, lambda i: i % 3 == 0, 2).collect()} == {(0, 3): 1e30, (3, 0): 1e30}


def test_threshold_follows_the_binomial_tail():
    rng = np.random.default_rng(0)
    inside = (np.abs(rng.standard_normal((20_000, neighbours.PROJECTIONS))) <= neighbours.HALF_WIDTH).sum(axis=1)
    assert np.mean(inside < neighbours.threshold()) <= neighbours.MISS + 0.004


CONV = "conv_id long, turn long, role string, text string"


def trie(rows, period=20, most=4):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in by.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - int(np.fmod(c, period)), [])[:h] + own[c][h:])
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    words = lambda k: len(re.findall(r"[^ \t-\r]+", k[-1][1])) if k else 0
    below = lambda k: [k, *itertools.chain.from_iterable(map(below, kids.get(k, [])))]
    out = set()
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(k))))
        sub = below(k)
        out.add((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(kids.get(k, [])), sum(x not in kids for x in sub), sum((len(nodes[x]) - 1) * words(x) for x in sub), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def grown(spark, rows, schema=CONV):
    turns = conversation_trie.numbered(spark.createDataFrame(rows, schema))
    got = conversation_trie.nodes(conversation_trie.rebuilt(turns))
    return got, [tuple(r) for r in got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


@pytest.mark.parametrize("chunk", [4096, 2])
def test_trie_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversation_trie, "CHUNK", chunk)
    monkeypatch.setattr(conversation_trie, "PIECE", 7 if chunk == 2 else 4096)
    rnd = random.Random(chunk)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hi there", "hi", "", None, "a b  c\td"])) for c in [*range(0, 60), 103, 117, -4] for t in range(rnd.choice([1, 1, 2, 4, 9]))]
    rows += [(c, t, "user", "the same words") for c in range(200, 260) for t in range(3)]  # copies of one conversation
    rows += [(5, None, "user", "first of all"), (6, 0, "user", "tie"), (6, 0, "user", "tie"), (7, 0, "b", "x"), (7, 0, "a", "y"), (None, 1, "user", "lost")]
    rnd.shuffle(rows)
    _, got = grown(spark, rows)
    assert len(got) == len(set(got)) and set(got) == trie(rows)


def test_trie_of_a_long_conversation_and_of_none(spark):
    rows = [(40, t, "user", f"w{t % 7} x") for t in range(3000)] + [(41, t, "user", f"w{t % 7} x") for t in range(2000)] + [(42, 0, "user", "y " * 100_000)]
    nodes, got = grown(spark, rows)
    by = {(r[0], r[1]): r for r in got}
    assert len(got) == 1 + 3000 + len(trie([rows[-1], *rows[:3]])) - 1 - 3  # 41 is a prefix of 40; 42 adds what it adds
    assert by[40, 3000][4:7] == (0, 1, 0) and by[40, 2000][3] == 2 and by[40, 1][3] >= 2
    assert grown(spark, [])[1] == []
    wide, got = grown(spark, [(1, 0, "user", "a b", "k", 5)], CONV + ", key string, depth int")
    texts = conversation_trie.with_texts(wide, spark.createDataFrame([(1, 0, "user", "a b")], CONV)).collect()
    assert set(got) == trie([(1, 0, "user", "a b")]) and {(r.depth, r.text) for r in texts} <= {(0, None), (1, "a b")}


DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def audited(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, bad = {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, x in labels if x == 1} - {None}
    rows = []
    for i, t, lang in docs:
        t, w = t or "", re.findall(r"[^ \t-\r]+", t or "")
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        rows.append((lang or "", {c for c, x in fails.items() if x}, i in good, i in bad))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left, gone = mine, []
            for step, c in enumerate(order, 1):
                cut = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                out.append([part, order, step, len(left), len(cut), sum(c in r[1] for r in gone), sum(r[1] == {c} for r in mine), sum(r[2] for r in cut), sum(r[3] for r in cut)])
                shapley[part, c] = shapley.get((part, c), 0) + len(cut)
                gone += cut
    return {(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out}


def test_filter_audit_against_brute_force(spark):
    rnd = random.Random(1)
    plain = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", "short", plain, plain + " $", "Ä" * 9 + "A", ("UP " * 60) + plain, "x " * 300, plain.upper(), " \t\n\x0b", "long " + "é" * 70_000 + plain]
    docs = [(i, rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in range(150)]
    docs += [(7, docs[7][1], docs[7][2]), (7, docs[7][1], "fr"), (8, "another", "en"), (None, plain, "en"), (None, "short", None)] + [(i, "copied", "en") for i in range(200, 260)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 260, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    counted = filter_audit.cells(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), filter_audit.text_filters(F.coalesce("text", F.lit(""))))
    got = [tuple(r) for r in filter_audit.audit(counted, "ABCDE").collect()]
    assert len(got) == len(set(got)) and set(got) == audited(docs, labels)


def test_filter_audit_bounds_and_empty_tables(spark, tmp_path):
    empty = filter_audit.cells(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS), {"A": F.col("text") == ""})
    assert filter_audit.audit(empty, "AE").count() == 0
    for wrong in ("", "AA", "ABCDEFG"):
        with pytest.raises(ValueError):
            filter_audit.walk(spark, wrong)
    clash = spark.createDataFrame([(1, "a", "en", 1, "h", 3)], DOCS + ", mask int, h string, n int")
    got = filter_audit.audit(filter_audit.cells(clash, spark.createDataFrame([], LABELS), {"A": F.col("text") == "a"}), "AE").collect()
    assert {(r.filter_order, r.step, r.kept, r.removed) for r in got} == {("AE", 1, 0, 1), ("AE", 2, 0, 0), ("EA", 1, 1, 0), ("EA", 2, 0, 1)}


def test_neighbour_query_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, got = brute(rows, 20, 20), {}
    for r in queries.QUERIES["op12_collision_counting"](spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.97 * sum(map(len, want.values()))
