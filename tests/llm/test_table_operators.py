"""Sharding, substring dedup, mixing, media, packing and the pipeline on small fixtures."""

import hashlib
import json
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trailmark.llm import mixing, ogg, packing, quality_classifier, quality_rules, queries, secrets, sharding, simhash, substring_dedup
from trailmark.llm._shared import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, ("en", "de", None)[k % 3], f"s{k % 4}", len(t or ""), "x", "y") for k, (i, t) in enumerate(rows)], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_shards_hold_equal_bytes(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(900)] + [(1000 + i, "the same text again and again") for i in range(400)] + [(2000, None), (2001, ""), (None, "x"), (5, "five"), (5, "five")]
    got = sharding.shard(table(spark, rows), 8).toPandas()
    assert len(got) == len(rows) and set(got.shard) == set(range(8))
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((None if np.isnan(i) else int(i), s, c) for i, s, c in zip(got.id, got["size"], got.text_crc32)) == want
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() < 0.1 * sizes.mean()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    few = got.groupby("text_crc32").agg(n=("size", "sum"), shards=("shard", "nunique"))
    assert (few[few.n <= sizes.mean()].shards == 1).all()  # copies stay together if a shard can hold them
    assert sharding.shard(table(spark, rows).where("false"), 8).count() == 0
    assert sharding.shard(table(spark, rows[:3]), 8).count() == 3
    alike = sharding.shard(table(spark, [(k % 3 or None, "one text") for k in range(400)]), 8).toPandas()
    assert len(alike) == 400 and alike.groupby("shard")["size"].sum().max() < 1.5 * alike["size"].sum() / 8  # no shard could hold them all


def slow_tree(points, room, extent, first=0):
    """Shard of each point (coordinates, weight): exact weighted medians along the widest dimension, one node at a time."""
    if len(room) == 1:
        return {p: first for p in points}
    half, t = len(room) // 2, sharding.TIE_BITS
    width = [(max(p[0][d] for p in points) >> t) - (min(p[0][d] for p in points) >> t) if points else 0 for d in range(2)]
    d = max(range(2), key=lambda k: width[k] / max(1, extent[k]))
    goal, below, left = sum(p[1] for p in points) * sum(room[:half]) / sum(room), 0, set()
    for p in sorted(points, key=lambda p: p[0][d]):
        if below + p[1] >= goal and not goal - below >= below + p[1] - goal:
            break
        left.add(p)
        below += p[1]
        if below >= goal:
            break
    return slow_tree([p for p in points if p in left], room[:half], extent, first) | slow_tree([p for p in points if p not in left], room[half:], extent, first + half)


def test_tree_has_exact_weighted_medians(spark):
    rng = random.Random(7)
    points = [((rng.randrange(1 << 20) << 31 | rng.getrandbits(31), rng.choice([5, 80, 900]) << 31 | rng.getrandbits(31)), rng.randint(1, 300)) for _ in range(500)]
    room = [100.0, 100.0, 40.0, 100.0, 0.0, 100.0, 90.0]
    df = spark.createDataFrame([(k, *x, w) for k, (x, w) in enumerate(points)], "k int, a long, b long, size long")
    tree = sharding.build(df, room, ["a", "b"], tolerance=0)
    got = {points[r.k]: r.s for r in df.select("k", sharding._choose(tree, lambda n: n.first).alias("s")).collect()}
    extent = [(max(p[0][d] for p in points) >> 31) - (min(p[0][d] for p in points) >> 31) for d in range(2)]
    assert got == slow_tree(points, room, extent)


def test_codes_are_middles_of_shares(spark):
    rows = [(None, 10), ("a", 30), ("b", 20), ("c", 40)]
    got = {r.v: r.code / (1 << 20) for r in sharding.ordered_codes(spark.createDataFrame(rows, "v string, w long"), "v", "w").collect()}
    assert all(abs(got[v] - x) < 1e-4 for v, x in ((None, 0.05), ("a", 0.25), ("b", 0.5), ("c", 0.8)))
    where, room = sharding.place_whole([50, 70, 20], 3, 100)
    assert where == [1, 0, 2] and room == [30, 50, 80]


def test_ranks_are_gapless(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), (F.col("id") % 1000).alias("v"))
    got = ranked(rows, "k", ["v"], "n", 5000, per_task=100).toPandas()
    assert all(sorted(g.n) == list(range(len(g))) for _, g in got.groupby("k")) and len(got) == 5000


def slow_spans(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = 1
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone])))
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist())))
    return out


@pytest.mark.parametrize("bucket", [4096, 1])
def test_substrings_against_brute_force(spark, bucket):
    rng = random.Random(2)
    passage, other = prose(rng, 12), prose(rng, 9)
    texts = [prose(rng, rng.randint(0, 40)) for _ in range(30)] + [prose(rng, 5) + passage + prose(rng, 5) for _ in range(12)] + [other + prose(rng, 3) + other, "a" * 300, "ab" * 100, "", prose(rng, 3) + "é" * 40, "é" * 45 + "x"]
    texts += texts[:3]
    rows = list(enumerate(texts)) + [(500, None), (None, texts[4]), (None, "alone without an id " * 2), (7, "again the same id"), (7, "again the same id"), (7, "the same id, another text")]
    want = slow_spans([(t or "").encode() for _, t in rows], 30)
    got = substring_dedup.dedup(table(spark, rows), length=30, gram=10, bucket=bucket).collect()
    expected = Counter((i, len((t or "").encode()), str(w)) for (i, t), w in zip(rows, want))
    assert Counter((r.id, r.n_bytes, str([(s.start, s.end) for s in r.spans])) for r in got) == expected
    for r in got:
        text = ((dict(rows[:-6]).get(r.id) if r.id is not None and r.id != 7 else None) or "").encode()
        if text:
            keep = b"".join(text[a:b] for a, b in zip([0, *(s.end for s in r.spans)], [*(s.start for s in r.spans), len(text)]))
            assert bytes(r.kept) == keep
    assert substring_dedup.dedup(table(spark, rows).where("false")).count() == 0


def test_block_finds_repeats_and_anchors_cover_windows():
    rng = random.Random(3)
    for _ in range(150):
        length = rng.choice([3, 5, 8])
        blocks = [bytes(rng.choice(b"ab\0c"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        count = Counter(c[i : i + length] for c in blocks for i in range(len(c) - length + 1))
        assert [x.tolist() for x in substring_dedup.repeated_starts(blocks, length)] == [[i for i in range(len(c) - length + 1) if count[c[i : i + length]] > 1] for c in blocks]
    raw = prose(rng, 900).encode()
    raw += raw[100:900] + b"a" * 500
    first, last, anchor, _ = substring_dedup.anchors(raw)
    assert first[0] == 0 and last[-1] == len(raw) - 200 and (first[1:] == last[:-1] + 1).all() and len(first) < len(raw) / 10 + 400
    seen = {}
    for a, b, h in zip(first, last, anchor):
        assert all(seen.setdefault(raw[p : p + 200], h) == h for p in range(a, b + 1))


def test_mixing_reaches_its_targets(spark):
    rng = random.Random(4)
    make = {"clean": lambda: prose(rng, 40), "low": lambda: prose(rng, 30).upper() + " !!!", "toxic": lambda: prose(rng, 30) + " idiot clown"}
    kinds = [rng.choice(["clean"] * 6 + ["low"] * 2 + ["toxic"] * 2) for _ in range(600)]
    rows = [(i, make[k]()) for i, k in enumerate(kinds)] + [(700, None), (701, ""), (None, "no id"), (702, "w " * 40000)]
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(kinds) if i % 2] + [(9999, "low"), (1, None)], "id long, domain string")
    weights = {"clean": 0.9, "low": 0.06, "toxic": 0.04}
    docs = table(spark, rows)
    got = mixing.mix(docs, labels, weights, anchor="clean").toPandas()
    assert len(got) == len(rows) and (got.rate >= 0).all()
    p, n = np.array(got.p.tolist()), got.n_tokens.to_numpy()
    assert np.allclose(p.sum(1), 1)
    totals = (p * (n * got.rate.to_numpy())[:, None]).sum(0)
    assert np.allclose(totals / totals.sum(), list(weights.values()), atol=0.01)
    assert totals[0] == pytest.approx((p[:, 0] * n).sum(), rel=0.01)
    found = dict(zip(got.id, got.domain))
    assert sum(found[i] == k for i, k in enumerate(kinds) if i % 2 == 0) > 0.9 * 300
    kept = {r.doc_id for r in mixing.resample(docs, labels, weights, anchor="clean").collect()}
    assert all(i in kept for i, d in found.items() if d == "clean" and i == i)
    assert len([i for i, k in enumerate(kinds) if k == "toxic" and i in kept]) < 0.8 * kinds.count("toxic")
    flat = mixing.mix(docs, labels.where("false"), weights).first()
    assert np.allclose(flat.p, 1 / 3)
    assert mixing.mix(docs.where("false"), labels, weights).count() == 0


def slow_rates(p, n, targets, low, high):
    """Projected gradient on all rates at once, for very many steps; the residual in the metric of the whole table."""
    free = low < high
    metric = np.linalg.inv((p[free] * n[free, None]).T @ p[free] + np.eye(p.shape[1]) * 1e-9 * n.sum())
    r = np.ones(len(n))
    for _ in range(5000):
        r = np.clip(r - p @ (metric @ ((p * (n * r)[:, None]).sum(0) - targets)), low, high)
    error = (p * (n * r)[:, None]).sum(0) - targets
    return r, float(error @ metric @ error), metric


@pytest.mark.parametrize("bounded", [False, True])
@pytest.mark.parametrize("shares", [(0.6, 0.2, 0.2), (0.97, 0.02, 0.01), (0.4, 0.1, 0.9)])
def test_rates_are_those_of_nonnegative_least_squares(spark, bounded, shares):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([3, 0.6, 0.4], 400)
    n = rng.integers(1, 300, 400).astype(float)
    targets = n.sum() * np.array(shares)
    low = np.where(bounded & (p.argmax(1) == 0), 1.0, 0.0)
    members = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, p array<double>")
    bounds = (F.when(F.array_max("p") == F.col("p")[0], 1.0).otherwise(0.0), F.lit(1.0)) if bounded else (None, None)
    way, totals = mixing.fit_rates(members, targets.tolist(), *bounds)
    got = np.array([r.rate for r in members.select(mixing.rate(F.col("p"), way, *bounds).alias("rate")).collect()])
    assert (got >= low - 1e-12).all() and (not bounded or got.max() <= 1)
    assert np.allclose(totals, (p * (n * got)[:, None]).sum(0))
    _, best, metric = slow_rates(p, n, targets, low, np.full(400, 1.0 if bounded else np.inf))
    error = np.array(totals) - targets
    assert np.abs(error).max() <= 1e-4 * n.sum() or error @ metric @ error <= best * 1.05 + 1e-6 * n.sum()
    with pytest.raises(RuntimeError, match="settle"):
        mixing.fit_rates(members, targets.tolist(), *bounds, steps=0)


def test_mixing_plan_is_native(spark):
    docs, labels = table(spark, [(0, "a b"), (1, "C D!!")]), spark.createDataFrame([(0, "clean"), (1, "low")], "id long, domain string")
    plan = mixing.mix(docs, labels, {"clean": 0.5, "low": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ogg_round_trips_and_checks(spark):
    rng = random.Random(5)
    texts = [None, "", "x", "é" * 100, prose(rng, 100), "b" * 192, "c" * 193, "d" * 70000, prose(rng, 60000)]
    got = {r.doc_id: r for r in ogg.digest(ogg.read_media(ogg.to_media(table(spark, list(enumerate(texts)) + [(50, "x")])))).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        body = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-16:]))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == ogg.digest_of(t)
        assert f"seconds={len(body) / 8000:.6f}" in r.feature
    assert got[50][1:] == got[2][1:]
    media = ogg.encode(ogg.padded("some text " * 2000))
    bad = [None, b"", media[:-1], media[:40] + b"!" + media[41:], media.replace(b"OggS", b"OggX", 1), media[len(media) // 2 :]]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bad)] + [(9, media)], "id int, media binary")
    rows = rows.withColumn("payload", F.lit("clashing name"))
    assert {r.id for r in ogg.read_media(rows).where("error is null").collect()} == {9}

    def slow_crc(data):
        r = 0
        for x in data:
            r ^= x << 24
            for _ in range(8):
                r = (r << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if r & 0x80000000 else r << 1
        return r

    assert ogg.checksum(b"page of bytes") == slow_crc(b"page of bytes")


def test_times_of_packets_and_foreign_streams(spark):
    flac = b"\x7fFLAC\x01\x00\x00\x02fLaC\x00\x00\x00\x22" + b"\0" * 10 + (44100 << 4).to_bytes(3, "big") + b"\0" * 20
    heads = {
        "opus": ([b"OpusHead\x01\x02" + (312).to_bytes(2, "little") + b"\0" * 7, b"OpusTags"], 48000, 312), "vorbis": ([b"\x01vorbis\0\0\0\0\x02" + (22050).to_bytes(4, "little") + b"\0" * 14, b"\x03vorbis", b"\x05vorbis"], 22050, 0),
        "flac": ([flac, b"\x84", b"\x81"], 44100, 0),
    }
    for codec, (head, rate, skipped) in heads.items():
        packets = [(h, 0) for h in head] + [(bytes([k]) * (30 if k % 3 else 9000), 960 * (k + 1)) for k in range(12)]
        s = ogg.decode(b"".join(ogg.pages(7, packets)))[7]
        assert (s.codec, s.rate, s.headers) == (codec, rate, len(head)) and [p for p, _ in packets] == s.packets
        assert np.allclose(s.times(), [(960 * (k + 1) - skipped) / rate for k in range(12)])
    assert ogg.decode(b"".join(ogg.pages(7, [(b"unknown", 0), (b"x", 5)])))[7].times() == []
    rows = spark.createDataFrame([(None, "x"), (None, "x"), (1, None)], "doc_id long, text string").withColumn("media", F.lit("clashing name"))
    got = ogg.digest(ogg.read_media(ogg.to_media(rows)))
    assert got.count() == 3 and got.distinct().count() == 2 and ogg.read_media(ogg.to_media(rows.where("false"))).count() == 0


def best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [b for b in range(len(bins)) if bins[b] >= x]
        if fit:
            bins[min(fit, key=lambda b: bins[b])] -= x
        else:
            bins.append(capacity - x)
    return len(bins)


@pytest.mark.parametrize("capacity,make", [(100, lambda r: r.randint(1, 100)), (100, lambda r: min(100, int(r.lognormvariate(3, 1)) + 1)), (64, lambda r: r.choice([33, 32, 31, 20, 5, 1])), (10, lambda r: 3)])
def test_plans_place_everything_once_and_pack_tight(capacity, make):
    rng = random.Random(capacity)
    lengths = [make(rng) for _ in range(3000)]
    seen, sequences = Counter(), defaultdict(list)
    for length, first, past, sequence, each, offset in packing.plan(Counter(lengths), capacity):
        for r in range(first, past):
            seen[length, r] += 1
            sequences[sequence + (r - first) // each].append((offset + (r - first) % each * length, length))
    assert seen == Counter((s, i) for s, n in Counter(lengths).items() for i in range(n))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.03 * best_fit(lengths, capacity) + 1
    with pytest.raises(ValueError, match="no sequence"):
        packing.plan({capacity + 1: 1}, capacity)
    assert packing.plan({}, capacity) == []


def tokenizer_file():
    pytest.importorskip("tokenizers")
    try:
        return queries.tokenizer_path()
    except ImportError:
        pytest.skip("no tokenizer files")


def test_packed_pieces_hold_the_tokenizers_ids(spark):
    path = tokenizer_file()
    rng = random.Random(6)
    texts = [None, "", " \n", "Hello, world! it's <|endoftext|> A1b2 été ﬁ\u00a0x\x85y\u3000z don't'll\x1cq", "ΣΑΣ İı ǅ Ⅷ ³ e\u0301 !!!a,,b", prose(rng, 6000), "漢字" * 300] + [prose(rng, rng.randint(1, 300)) for _ in range(60)]
    rows = list(enumerate(texts)) + [(3, "a repeated id"), (3, "a repeated id"), (None, "none")]
    got = packing.pack(packing.pieces(table(spark, rows), path)).toPandas()
    encode = pytest.importorskip("tokenizers").Tokenizer.from_file(path).encode
    want, total = Counter(), 0
    for i, t in rows:
        ids = encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for k in range(0, len(ids), 4096):
            want[i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], dtype="<u4").tobytes())] += 1
    assert Counter((None if np.isnan(r.id) else int(r.id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096
    assert got.sequence_id.nunique() <= total / 4096 + 2
    assert packing.pack(packing.pieces(table(spark, rows).where("false"), path)).count() == 0


def test_ids_of_letters_that_come_apart():
    """Every character whose class may change on the way (lower case, composition), beside letters and punctuation."""
    path = tokenizer_file()
    words = packing.WordTokenizer(path)
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    moved = [c for c in every if c.lower() != c or unicodedata.normalize("NFC", c) != c or unicodedata.combining(c)] + every[:0x3000:7] + every[0x3000::97]
    texts = [x for c in moved for x in (f"a{c}.", f"{c}! b{c}c,", f"'{c}\u0301 {c}<|endoftext|>")] + ["AL\u0130. geldi AL\u0130, VEL\u0130! x", "\u03a3\u0391\u03a3. \u03a3"]
    got = [ids[a:b].tolist() for ids, ends in words(pa.array(texts)) for a, b in zip([0, *ends], ends)]
    want = [e.ids for e in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert words.by_words and [t for t, g, w in zip(texts, got, want) if g != w] == []


def test_other_tokenizers_get_whole_texts(monkeypatch):
    path = tokenizer_file()
    with open(path) as f:
        spec = json.load(f)
    assert packing.by_words(spec)
    for change in ({"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": spec["model"] | {"dropout": 0.1}}, {"added_tokens": [spec["added_tokens"][0] | {"content": "a b"}]}):
        assert not packing.by_words(spec | change)
    monkeypatch.setattr(packing, "by_words", lambda spec: False)
    monkeypatch.setattr(packing, "SLICE", 50)
    whole, texts = packing.WordTokenizer(path), ["some words, a few", None, "", "x" * 200, "\u0130. y"]
    monkeypatch.undo()
    split = packing.WordTokenizer(path)
    of = lambda t: [ids[a:b].tolist() for ids, ends in t(pa.array(texts)) for a, b in zip([0, *ends], ends)]
    assert not whole.by_words and of(whole) == of(split)


def test_packing_with_clashing_names_nulls_and_repeats(spark):
    rows = spark.createDataFrame([(k % 3 or None, 0, 0, 1 + k % 7, 5, 1, 2, 3, 4, 5, "x", "y") for k in range(200)], "id int, piece int, start long, length long, ids_crc32 long, first long, past long, each long, base long, number long, sequence string, _bucket string")
    got = packing.pack(rows, capacity=10).toPandas()
    assert len(got) == 200 and list(got.columns) == ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 10


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "secrets", "mixing", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        n = docs.count()
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns and 0 < docs.count() <= n
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.STAGES[0][1](spark, docs.where("false"), sf_dir).count() == 0


ROWWISE = {
    "simhash": lambda docs, labels: simhash.near_duplicates(docs), "secrets": lambda docs, labels: secrets.find_secrets(docs), "quality": lambda docs, labels: quality_rules.judge(docs),
    "classifier": lambda docs, labels: quality_classifier.score(docs, labels.select("id", (F.col("domain") == "clean").cast("int").alias("label"))), "shards": lambda docs, labels: sharding.shard(docs, 4).drop("shard", "slot"),
    "substrings": lambda docs, labels: substring_dedup.dedup(docs), "mixing": lambda docs, labels: mixing.mix(docs, labels, {"clean": 0.7, "low": 0.3}), "ogg": lambda docs, labels: ogg.read_media(ogg.to_media(docs)),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_operators_keep_every_row(spark, name):
    """Null and repeated ids, repeated rows, null and empty texts, clashing names, empty tables: a result for each row, equal ones for equal rows."""
    rng = random.Random(3)
    kind = "doc_id long, text string, lang string, source string, _at string, node string, id string, fp string, size string, tag string, stats string"
    texts = [prose(rng, 30) if i % 2 else prose(rng, 30).upper() for i in range(12)]
    rows = [(i, t, None, None, *"abcdefg") for i, t in enumerate(texts)] + [(None, None, None, "s", *"abcdefg"), (None, "", None, "s", *"abcdefg"), (2, texts[2], None, None, *"abcdefg"), (2, texts[2], None, None, *"abcdefg"), (None, texts[4], None, None, *"abcdefg")]
    docs = spark.createDataFrame(rows, kind)
    labels = spark.createDataFrame([(i, "clean" if i % 2 else "low") for i in range(12)] + [(None, "low")], "id long, domain string")
    got = ROWWISE[name](docs, labels)
    shown = Counter(str(r) for r in got.collect())
    assert sum(shown.values()) == len(rows) and max(shown.values()) == 3  # three rows are equal
    assert ROWWISE[name](docs.where("false"), labels).count() == 0


def test_stages_take_nulls_repeats_ties_clashing_names_and_empty_tables(spark, sf_dir):
    import corpus_pipeline

    rng = random.Random(12)
    kind = "doc_id long, text string, lang string, source string, _at string, node string, _row string, id string, fp string"
    texts = [prose(rng, 40) for _ in range(20)]
    rows = [(i, t, None, "s", "a", "b", "c", "d", "e") for i, t in enumerate([*texts, texts[0], texts[0], None, "", " \n"])] + [(None, texts[1], "en", None, *"abcde"), (None, prose(rng, 40), "en", None, *"abcde"), (3, texts[3], "en", None, *"abcde"), (50, prose(rng, 60000), "en", None, *"abcde")]
    docs = spark.createDataFrame(rows, kind)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.where("false"), sf_dir)
        assert empty.count() == 0, name
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns == empty.columns, name
        got = [(r.doc_id, r.text) for r in out.collect()] if name != "packing" else [(r.doc_id, None) for r in out.collect()]
        ids = Counter(i for i, _ in got)
        if name == "quality rules":  # texts without words go
            assert ids == Counter(r[0] for r in rows if r[1] and r[1].strip())
        elif name == "near-duplicates":  # one of each text, and one without words
            assert sorted((t or "").strip()[:20] for _, t in got) == sorted({(r[1] or "").strip()[:20] for r in rows}) and ids[0] == ids[22] == ids[3] == 1
        elif name == "secrets":
            assert Counter(got) == Counter((r[0], r[1]) for r in rows)
        elif name == "mixing":
            assert set(ids) <= {r[0] for r in rows} and len(got) <= len(rows)
        else:
            assert set(ids) == {r[0] for r in rows} and ids[None] == 2 and ids[3] == 2 and ids[50] > 1


def test_every_query_runs_on_whole_tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    others = {"op11_conversation_trie", "op12_collision_counting", "op13_filter_audit"}  # no row a document: test_search_and_audit.py
    for name, query in queries.QUERIES.items():
        if name in others:
            continue
        out = query(spark, sf_dir)
        n = out.count()
        assert n >= rows if name.startswith("op10") else n == (spark.read.parquet(f"{sf_dir}/pages.parquet").count() if name.startswith("op4") else rows), name


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    duck = pytest.importorskip("duckdb").connect()
    for t in ("documents", "pages", "labels", "conversations"):
        duck.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
