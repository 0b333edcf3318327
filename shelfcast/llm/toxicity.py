"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Fitting uses a bounded, documented sample of labelled documents (``SAMPLE``),
chosen by hash: Spark counts in how many toxic and other documents each hashed
n-gram occurs, the strongest ``FEATURES`` by |log-count ratio| x sqrt(documents)
are kept, and a logistic regression is fitted on the binary features times their
ratios. Scoring maps every document once; a text is never cut.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import labelled, ready, written

SAMPLE = 12_000
ORDERS = (3, 4, 5)
BUCKET_BITS = 20
FEATURES = 4096
#: A feature must occur in this many sampled documents; smoothing of the counts; ridge penalty.
MIN_DOCS, SMOOTH, RIDGE = 5, 0.5, 3.0
STEPS = 250
THRESHOLD = 0.3
#: Characters hashed at once: bounds a worker's memory, n-grams across the joints are kept.
BLOCK = 1 << 18


def gram_blocks(text: str | None):
    """Bucket numbers of all n-grams of the lower-cased, space-padded text, in blocks."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    overlap = max(ORDERS) - 1
    for low in range(0, max(1, len(codes) - overlap), BLOCK):
        part = codes[low:low + BLOCK + overlap]
        mixed = np.zeros(len(part), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if len(part) < n:
                break
            mixed = mixed[:len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1:] + np.uint64(1)
            if n in ORDERS:
                yield ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def present(text: str | None, slot: np.ndarray) -> np.ndarray:
    """Sorted distinct features of a text; ``slot`` maps a bucket to its feature or -1."""
    found = [s[s >= 0] for s in (slot[b] for b in gram_blocks(text))]
    return np.unique(np.concatenate(found)) if found else np.empty(0, slot.dtype)


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def slots(self) -> np.ndarray:
        slot = np.full(1 << BUCKET_BITS, -1, np.int32)
        slot[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        return slot


def logistic(rows: np.ndarray, cols: np.ndarray, scale: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Adam over a sparse binary matrix with column scales; weights and bias."""
    n, k = len(label), len(scale)
    value, v, bias = scale[cols], np.zeros(k), math.log((label.sum() + .5) / (n - label.sum() + .5))
    m1, m2 = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, STEPS + 1):
        z = np.bincount(rows, weights=v[cols] * value, minlength=n) + bias
        r = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) / n
        g = np.append(np.bincount(cols, weights=r[rows] * value, minlength=k) + RIDGE * v / k, r.sum())
        m1, m2 = .9 * m1 + .1 * g, .999 * m2 + .001 * g * g
        move = .05 * (m1 / (1 - .9 ** t)) / (np.sqrt(m2 / (1 - .999 ** t)) + 1e-9)
        v, bias = v - move[:k], bias - move[k]
    return v * scale, float(bias)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on labelled documents whose label row passes ``keep``; a single class gives a constant score."""
    train = written(labelled(docs.sparkSession, docs, labels, label, keep, sample, "toxicity"), "toxicity-sample")
    totals = dict(train.groupBy("label").count().collect())
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    prior = math.log((pos + .5) / (neg + .5))
    if not pos or not neg:
        return Model(np.empty(0, np.int64), np.empty(0), prior)

    def count(batches):
        tally = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tally[y, np.unique(np.concatenate(list(gram_blocks(text)) or [np.empty(0, np.int64)]))] += 1
        used = np.flatnonzero(tally.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, *tally[:, used].astype(np.int64))],
                                         names=["bucket", "n", "p"])

    counted = (train.select("text", "label").mapInArrow(count, "bucket bigint, n bigint, p bigint")
               .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("p").alias("p")))
    ratio = F.log((F.col("p") + SMOOTH) / (pos + 2 * SMOOTH)) - F.log((F.col("n") + SMOOTH) / (neg + 2 * SMOOTH))
    best = (counted.filter(F.col("p") + F.col("n") >= MIN_DOCS).withColumn("r", ratio)
            .orderBy(F.desc(F.abs("r") * F.sqrt(F.col("p") + F.col("n"))), "bucket").limit(FEATURES).collect())
    model = Model(np.asarray([x.bucket for x in best], np.int64), np.asarray([x.r for x in best], float), prior)

    def rows_of(batches):
        slot = model.slots()
        for batch in batches:
            ids = [present(t, slot).astype("<i4").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(ids, pa.binary())], names=["label", "ids"])

    got = train.select("text", "label").mapInArrow(rows_of, "label int, ids binary").collect()
    label_of = np.asarray([r.label for r in got], float)
    parts = [np.frombuffer(r.ids, "<i4") for r in got]
    at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    model.weights, model.bias = logistic(at, np.concatenate(parts), model.weights, label_of)
    return model


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` and (score, predicted) of every document; a null text counts as empty."""
    bias, weights = model.bias, model.weights

    def mapped(batches):
        slot = model.slots()
        for batch in batches:
            z = np.asarray([bias + weights[present(t, slot)].sum() for t in batch.column(0).to_pylist()], float)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                names=[*batch.schema.names[1:], "score", "predicted"])

    picked = docs.select("text", *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:]]
    return picked.mapInArrow(mapped, ", ".join([*fields, "score double", "predicted int"]))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    ``held_out`` is a condition on doc_id; its rows teach nothing. Null ids are
    not held out and never learned from; null and empty texts get the score of
    a text without features; repeated rows are scored alike; an empty table
    gives an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    held = F.coalesce(held_out, F.lit(False))
    model = fit(docs, labels, ~held)
    return score(docs.select("text", "doc_id"), model, "doc_id").select(
        "doc_id", held.alias("held_out"), "score", "predicted")
