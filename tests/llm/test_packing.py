"""Packing: every id in one piece, gapless sequences, ids of the tokenizer itself; the linear program on known cases."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF_MID
from shelfcast.llm import cutting_stock, packing
from shelfcast.llm.cutting_stock import solve
from shelfcast.llm.queries import tokenizer_path

EDGES = [None, "", " \n", "It's they're x'''s 12³", "a\xa0b\x85c ÀÉß", "ﬁ é combining é", "<|endoftext|> hi", "日本語 Σας ΟΔΟΣ",
         "'S 'T''re", "a_b__c!!'s", "\x1c\x1d a\x00b", "½ cup µm ºC ª ÿ×÷ß", "word " * 9000, "x" * 20000, "!" * 9000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, tokenizer, capacity=4096):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(texts)
    for doc, parts in pieces.items():
        ids = np.asarray(tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(sequences), sum(r.length for r in rows)


def test_pack_edges(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, 5, "c") for i, t in enumerate(EDGES)], "doc_id long, text string, length int, ids string")
    check(packing.pack_documents(docs, tokenizer_path()).collect(), dict(enumerate(EDGES)), tokenizer)
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).count() == 0
    twice = spark.createDataFrame([(None, "same text"), (None, "same text"), (3, "same text")], "doc_id long, text string")
    got = packing.pack_documents(twice, tokenizer_path(), with_ids=True)
    rows = got.collect()
    assert len(rows) == 3 and sorted(r.offset for r in rows) == [0, rows[0].length, 2 * rows[0].length]
    whole = packing.sequences(got).collect()
    assert len(whole) == 1 and whole[0].n_tokens * 4 == len(whole[0].ids)


def test_pack_whole_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sequences, tokens = check(packing.pack_documents(docs, tokenizer_path()).collect(), texts, tokenizer)
    assert sequences * 4096 <= tokens * 1.02 + 4096


def test_cutting_stock_meets_demand():
    rng = np.random.default_rng(0)
    for widths, capacity in (([3, 5, 7], 10), ([64], 64), ([1], 64), (sorted(rng.choice(np.arange(1, 65), 20, False)), 64)):
        widths = np.asarray(widths)
        demand = rng.integers(1, 500, len(widths))
        patterns = solve(widths, demand, capacity)
        assert (sum(c * t for c, t in patterns) == demand).all()
        assert all((c * widths).sum() <= capacity for c, _ in patterns)
        lower = -(-(widths * demand).sum() // capacity)
        assert sum(t for _, t in patterns) <= max(lower * 1.05 + len(widths), demand.sum())
    # 44 of 44 + 55, and of 3 x 33: the optimum leaves nothing over
    assert sum(t for _, t in solve(np.asarray([33, 44, 55]), np.asarray([300, 100, 100]), 99)) == 200
    assert solve(np.asarray([], int), np.asarray([], int), 64) == []


def test_patterns_claim_every_rank_once():
    patterns = [(np.asarray([2, 0, 1]), 3), (np.asarray([0, 4, 0]), 2), (np.asarray([1, 1, 1]), 1)]
    taken = defaultdict(list)
    for j, first, stop, copies, sequence in packing.slots(patterns):
        for rank in range(first, stop):
            taken[j].append((rank, sequence + (rank - first) // copies))
    assert [len(taken[j]) for j in range(3)] == [7, 9, 4]
    for j in range(3):
        assert [r for r, _ in sorted(taken[j])] == list(range(len(taken[j])))


def test_early_end_of_pricing_is_reported(monkeypatch):
    monkeypatch.setattr(cutting_stock, "MAX_COLUMNS", 1)
    widths, demand = np.asarray([3, 5, 7, 11]), np.asarray([40, 30, 20, 10])
    with pytest.warns(UserWarning, match="pricing ended"):
        patterns = solve(widths, demand, 20)
    assert (sum(times * column for column, times in patterns) == demand).all()
    assert all(column @ widths <= 20 for column, _ in patterns)
