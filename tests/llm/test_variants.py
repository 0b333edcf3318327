"""Spelling variants against all pairs."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from shelfcast.llm import variants


def brute_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(docs):
    n = brute_words(docs)
    near = {w: [] for w in n}
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    for size, same in by_size.items():
        for a, b in itertools.chain(itertools.combinations(same, 2), itertools.product(same, by_size.get(size + 1, []))):
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=str)


def run(spark, docs):
    frame = spark.createDataFrame([(i, t, 3, "x") for i, t in docs], "doc_id bigint, text string, n int, word string")
    return sorted((tuple(r) for r in variants.grouped(frame).collect()), key=str)


@pytest.mark.parametrize("letters", ["ab", "abcdeéÀß", "abcdefghijklmnopqrstuvwxyzäöü"])
def test_matches_all_pairs(spark, letters):
    rng = random.Random(len(letters))
    words = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(60)]
    for w in list(words):                                      # neighbours and neighbours of neighbours
        for _ in range(4):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            words.append(w)
    docs = [(0, None), (1, ""), (None, "Hello hello HELLO helo"), (2, "1 , 2"), (3, "aaaaa aaaaaa " * 500), (3, "aaaaa aaaaaa " * 500)]
    docs += [(10 + i, " ".join(w.upper() if rng.random() < .1 else w for w in rng.choices(words, [1 / (1 + k) for k in range(len(words))], k=120)))
             for i in range(40)]
    got = run(spark, docs)
    assert got == brute(docs)
    assert sum(r[4] for r in got) > 0


def test_chains_of_forms_end_in_the_root(spark):
    text = " ".join(["abcdefgh"] * 3 + ["abcdefgx"] * 6 + ["abcdefyx"] * 12 + ["abcdezyx"] * 24 + ["abcdezyxw"] * 48)
    got = {r[0]: r[2] for r in run(spark, [(1, text)])}
    assert got == {r[0]: r[2] for r in brute([(1, text)])}


def test_no_join_goes_through_the_driver(spark, monkeypatch):
    """Spark takes unfolded keys for far smaller than they are; so no join may be a broadcast, whatever its limit."""
    plans, written = [], variants.written

    def noted(df, name):
        plans.append(df)
        return written(df, name)
    monkeypatch.setattr(variants, "written", noted)
    text = " ".join(["abcdefgh"] * 3 + ["abcdefgx"] * 6 + ["abcdefyx"] * 12)
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    plans.append(variants.grouped(frame))
    names = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert sum("SortMergeJoin" in x for x in names) >= 4
    assert not any("Broadcast" in x for x in names)


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, "short a b c")]) == []


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    docs = [(r.doc_id, r.text) for r in rows]
    assert run(spark, docs) == brute(docs)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(2)
    for _ in range(500):
        places = sorted(rng.sample(range(12), rng.randint(3, 6)))
        prefix = [(p, f"g{rng.randint(0, 4)}") for p in places]
        cost = {f"g{k}": (k, rng.randint(1, 9)) for k in range(5)}
        options = [cost[a[1]][1] + cost[b[1]][1] for a, b in itertools.combinations(prefix, 2) if abs(a[0] - b[0]) >= 2]
        one, two = variants.pivots_of(prefix, cost)
        assert two[0] - one[0] >= 2 and cost[one[1]][1] + cost[two[1]][1] == min(options)
