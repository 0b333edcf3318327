"""The corpus pipeline, stage by stage, against plain versions of each decision."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from shelfcast.llm import pii, toxicity
from shelfcast.llm.common import written
from shelfcast.llm.queries import tokenizer_path
from test_simhash import brute_components, brute_fingerprint
from test_spans import brute_base, similar


def plain_words(text):
    return re.findall(r"\w+", (text or "").lower())


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append(docs)
    return out


def test_stage_names_and_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "pii", "packing"]
    assert all(r.columns == results[0].columns and r.dtypes == results[0].dtypes for r in results[:-1])


def test_toxicity_stage(spark, results):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = toxicity.fit(results[0], labels, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    slot, kept = model.slots(), {r.doc_id for r in results[1].collect()}
    for r in results[0].collect():
        z = model.bias + model.weights[toxicity.present(r.text, slot)].sum()
        assert (r.doc_id in kept) == (1 / (1 + np.exp(-z)) < 0.3)


def test_dedup_stage(results):
    rows = sorted(results[1].collect(), key=lambda r: r.doc_id)
    roots = brute_components([brute_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in results[2].collect()) == sorted({rows[i].doc_id for i in roots})
    assert set(results[2].collect()) <= set(rows)


def test_decontamination_stage(spark, results):
    items = [plain_words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    items = [i for i in items if i]
    shingles = {tuple(i[k:k + 5]) for i in items for k in range(max(1, len(i) - 4))}
    clean = set()
    for r in results[2].collect():
        words = plain_words(r.text)
        if not any(tuple(words[k:k + 5]) in shingles for k in range(len(words))) or not any(
                similar(words, i) >= 0.8 for i in items):
            clean.add(r)
    assert set(results[3].collect()) == clean and 0 < len(clean) < results[2].count()


def test_pii_stage(results):
    before, after = ({r.doc_id: r for r in results[i].collect()} for i in (3, 4))
    assert before.keys() == after.keys()
    spans = {r.doc_id: r.spans for r in pii.find(results[3], "doc_id").collect()}
    for d, r in after.items():
        out, at, text = [], 0, before[d].text
        for s in spans[d]:
            if s.start >= at:
                out += [text[at:s.start], pii.LABELS[s.kind] if s.kind < 4 else "" if s.action == "remove" else "[WORD]"]
            at = max(at, s.end)
        assert r.text == "".join(out) + text[at:] and r.n_chars == len(r.text)
        assert (r.text == text) == (not spans[d]) and len([s for s in spans[d] if s.kind < 4]) == len(brute_base(text))


def test_packing_stage(results):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts, seen = {r.doc_id: r.text for r in results[4].collect()}, Counter()
    for r in results[5].collect():
        ids = np.asarray(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        seen[r.doc_id] += r.length
        assert r.doc_tokens == len(ids)
    assert seen == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}


def test_odd_rows_in_every_stage(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
            (2, "x" * 150_000, None, "s", 5), (3, "same words here now", "en", None, 1), (3, "other words over there", "en", None, 1),
            (4, "same words here now", "en", "s", 1), (None, "a third thing entirely different", "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 as content_hash", "2 as row_key", "'c' as spans", "3 as fp")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(
        [(1, ""), (2, "x" * 150_000), (3, "same words here now"), (3, "other words over there"),
         (None, "a third thing entirely different")], key=str)
    for name, stage in corpus_pipeline.STAGES:
        if name == "simhash_dedup":
            continue
        out = stage(spark, docs, SF_SMALL)
        if name == "packing":
            assert out.where("start = 0").count() == len(rows)
        else:
            assert out.count() == len(rows) and out.columns == docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
