"""Importance resampling against a plain count over word lists."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from shelfcast.llm import resampling


def grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s = Counter(bucket(g) for _, t in docs for g in grams(t)[1])
    t_ = Counter(bucket(g) for t in target for g in grams(t)[1])
    big_s, big_t = sum(s.values()), sum(t_.values())
    gain = {b: math.floor(1000 * math.log((t_[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    rows = []
    for i, text in docs:
        n, g = grams(text)
        weight = sum(gain[bucket(x)] for x in g)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    drawn = {id(r): k + 1 for k, r in enumerate(able[:5 * len(able) // 100])}
    return sorted(((*r[:4], drawn.get(id(r))) for r in rows), key=str)


def run(spark, docs, target):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, rank int, one string")
    target = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    return sorted((tuple(r) for r in resampling.resample(docs, target).collect()), key=str)


def test_matches_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcÀé0ZK", k=rng.randint(1, 6))) for _ in range(80)]
    docs = [(0, None), (1, ""), (2, " .,- "), (3, "one"), (4, "One  TWO"), (None, "a b " * 30), (5, "word " * 4000)]
    docs += [(10 + i, rng.choice([" ", "-", "\n. "]).join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(300)]
    docs += [docs[20], docs[21], docs[20]]
    target = [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(20)] + [None]
    assert run(spark, docs, target) == brute(docs, target)


def test_empty_tables(spark):
    assert run(spark, [], ["a"]) == []
    docs = [(i, "some words here " * 8) for i in range(40)]
    assert run(spark, docs, []) == brute(docs, [])


def test_given_documents(spark):
    base = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{base}/benchmark.parquet").collect()]
    got = run(spark, docs, target)
    assert got == brute(docs, target) and sum(r[4] is not None for r in got) > 5


@pytest.mark.parametrize("text", ["", "a", "a b", "a  b,c", "x" * 100_000, "é à ü"])
def test_features_count_every_run(text):
    n, g = grams(text)
    words, buckets = resampling.features(text)
    assert words == n and sorted(zlib.crc32(x.encode()) % 10000 for x in g) == buckets.tolist()
