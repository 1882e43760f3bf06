"""Texts of several hundred thousand characters: whole results, also across the borders of what is worked on at once."""

import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from trailmark.llm import quality_classifier, quality_rules, sharding, simhash, substring_dedup


def long_rows(n=60_000):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for _ in range(2)]
    border = substring_dedup.CHUNK
    passage = "".join(rng.choice("qrstuvwxyz ") for _ in range(700))
    near = texts[0][: border - 350] + passage + texts[0][border + 350 :]
    rows = [(0, near), (1, texts[1][:90_000] + passage + texts[1][90_000:]), (2, "short and plain, with enough words to be kept by the rules of quality")]
    return rows, passage


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")


def test_repeats_across_the_border_of_a_chunk_go(spark):
    rows, passage = long_rows()
    assert len(rows[0][1]) > substring_dedup.CHUNK + 1000
    got = {r.id: [(s.start, s.end) for s in r.spans] for r in substring_dedup.dedup(table(spark, rows)).collect()}
    raw = [t.encode() for _, t in rows]
    count = Counter(t[i : i + 200] for t in raw for i in range(len(t) - 199))
    for (i, _), t in zip(rows, raw):
        gone, spans = [p for p in range(len(t) - 199) if count[t[p : p + 200]] > 1], []
        for p in gone:
            if spans and p <= spans[-1][1]:
                spans[-1] = (spans[-1][0], p + 200)
            else:
                spans.append((p, p + 200))
        assert got[i] == spans
    assert any(b - a >= len(passage) for a, b in got[0])


def test_facts_fingerprints_scores_and_shards_of_long_texts(spark):
    rows, _ = long_rows()
    judged = {r.id: r for r in quality_rules.judge(table(spark, rows), facts=True).collect()}
    prints = {r.id: r.fp % 2**64 for r in simhash.near_duplicates(table(spark, rows)).collect()}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        again = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        assert (judged[i].n_words, judged[i].word_chars, judged[i].n_repeat_words) == (len(words), sum(map(len, words)), len(again))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(len(words) - 2)]
        assert prints[i] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "id long, label int")
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(table(spark, rows), labels).collect())
    placed = sharding.shard(table(spark, rows), 2).groupBy("shard").agg(F.sum("size").alias("size")).collect()
    assert sum(r["size"] for r in placed) == sum(len(t.encode()) + 16 for _, t in rows)
