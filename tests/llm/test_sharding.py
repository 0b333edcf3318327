"""Sharding: near-equal bytes, gapless slots, equal texts together unless a group overfills a range."""

import zlib
from collections import Counter, defaultdict

import pytest

from conftest import SF_MID
from shelfcast.llm import sharding


def check(rows, texts):
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    content = defaultdict(set)
    for d, t in texts:
        content[d].add((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    slots, size = defaultdict(list), Counter({s: 0 for s in range(16)})
    for r in rows:
        assert (r.size, r.text_crc32) in content[r.doc_id] and r.law == "bytes" and r.grown_shard is None
        assert 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


def test_shards_of_whole_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    size = check(sharding.shard_documents(docs).collect(), texts)
    assert max(size.values()) - min(size.values()) <= 2 * max(len(t.encode()) + 1 for _, t in texts)
    assert sorted(map(tuple, sharding.shard_documents(docs).collect()), key=str) == sorted(
        map(tuple, sharding.shard_documents(docs.repartition(3)).collect()), key=str)


def test_hot_group_is_split_and_small_groups_stay(spark):
    texts = [(i, "hot copy " * 20) for i in range(2000)]
    texts += [(10_000 + i, f"text {i // 3} " * (5 + i % 40)) for i in range(4000)]
    texts = [(d, t if d < 10_000 else f"group {(d - 10_000) // 3} " * 20) for d, t in texts]
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, shard int")
    rows = sharding.shard_documents(docs).collect()
    size = check(rows, texts)
    assert max(size.values()) <= 1.1 * sum(size.values()) / 16
    by_text = defaultdict(set)
    text_of = dict(texts)
    for r in rows:
        by_text[text_of[r.doc_id]].add(r.shard)
    assert len(by_text["hot copy " * 20]) > 4
    assert sum(len(s) > 1 for t, s in by_text.items() if t[0] == "g") <= 16


def test_ranges_left_overfull_are_reported(spark, monkeypatch):
    texts = [(i, f"text {i} " * (400 if i % 50 == 0 else 2)) for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(sharding, "KEYS", 1)                 # coarse samples leave uneven ranges
    monkeypatch.setattr(sharding, "ROUNDS", 0)
    with pytest.warns(UserWarning, match="key ranges stay overfull"):
        check(sharding.shard_documents(docs).collect(), texts)


@pytest.mark.parametrize("rows", [[], [(1, "only")], [(None, None), (None, None), (2, ""), (2, "x" * 100_000), (2, "x" * 100_000)]])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(sharding.shard_documents(docs).collect(), rows)


def test_write_shards(spark):
    docs = spark.createDataFrame([(i, f"t{i}" * 9, "en") for i in range(300)] + [(5, "t5" * 9, "en")], "doc_id long, text string, lang string")
    back = spark.read.parquet(sharding.write_shards(docs))
    assert back.count() == 301 and sorted(back.columns) == ["doc_id", "lang", "shard", "text"]
