"""SimHash near-duplicates against brute force, and the component rounds against union-find."""

import random

import numpy as np
import pytest
import xxhash

from shelfcast.llm import simhash
from shelfcast.llm.graph import components


def brute_fingerprint(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", (text or ""))]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, radius=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)]
    texts = [None, "", " \t\n", "One", "one", "one  two", "É é", "x" * 50_000, "a b " * 4000]
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.randint(1, 300))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append("\u000b".join(copy).upper() if rng.random() < .2 else " ".join(copy))
    docs = spark.createDataFrame([(i + 10, t, "clash", -1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, fp string, a long")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    roots = brute_components(fps)
    assert len(got) == len(texts)
    for i, fp in enumerate(fps):
        assert got[i + 10].fingerprint == f"{fp:016x}", texts[i]
        assert got[i + 10].component_id == roots[i] + 10
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "p q r"), (None, "p q r"), (5, None)], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(odd).collect()) \
        == [(-1, -1), (-1, -1), (5, 5)]


@pytest.mark.parametrize("postings", [2, 12])
def test_long_postings_lose_no_link(spark, monkeypatch, postings):
    monkeypatch.setattr(simhash, "POSTINGS", postings)
    rng = np.random.default_rng(5)
    bases = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    fps = {int(b) for b in bases}
    for b in bases:
        for _ in range(25):
            flip = sum(1 << int(x) for x in rng.choice(24 if rng.random() < .5 else 64, rng.integers(1, 6), replace=False))
            fps.add(int(b) ^ flip)
    fps = sorted(fps)
    known = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {r.node: r.root for r in components(simhash.links(known)).collect()}
    roots = brute_components(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    for i in range(len(fps)):
        for j in range(i):
            same = got.get(signed[i], signed[i]) == got.get(signed[j], signed[j])
            assert same == (roots[i] == roots[j])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
