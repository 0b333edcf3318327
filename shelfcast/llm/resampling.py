"""Importance resampling towards a target distribution: hashed n-gram counts, log ratios, Gumbel draws without replacement.

Features are all runs of 1 to 3 consecutive words. A text's separators are
collapsed to single spaces; ``regex.finditer(overlapped=True)`` then starts
a match at every word (boundary lookarounds keep it from starting or ending
inside one) and emits the spans of the words of the longest run that starts there; their CRC-32,
carried on from word to word, picks the buckets of its one to three runs. The buckets of a document are written once; the counts of
the corpus and of the target are sums over all their features, and a document's weight is the
sum of its features' gains. A seeded Gumbel value added to the weight and a
distributed rank turn the weights into a draw without replacement.

A null text has no words. Null ids count as empty text in the draw and come
first among ties. Repeated rows are separate rows with equal scores. An empty
corpus gives an empty result, an empty target gives T = 0. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.prefix import global_running_sum
from shelfcast.llm.common import ready, written

BUCKETS = 10_000
LONGEST = 3
SEED, PERCENT, LEAST_WORDS = 42, 5, 20

#: Lower-cases A-Z and turns every separator byte into a space; bytes of longer code points stay.
FOLD = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
             else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
SPACES = regex.compile(rb" {2,}")
#: From a word's start: the word, and the next two with the space before them, if the text holds them.
RUNS = regex.compile(rb"(?<= )([^ ]++)( [^ ]++)?+( [^ ]++)?+(?= )")


def collapsed(text: str | None) -> bytes:
    """The words of a text, lower-cased and joined by single spaces."""
    return SPACES.sub(b" ", (text or "").encode("utf-8", "surrogatepass").translate(FOLD)).strip(b" ")


def features(text: str | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words and the sorted buckets of all n-grams, repeats included."""
    line = collapsed(text)
    words = line.count(b" ") + 1 if line else 0
    crc32, crc = zlib.crc32, []
    for match in RUNS.finditer(b" " + line + b" ", overlapped=True):
        first, second, third = match.groups()
        crc.append(run := crc32(first))
        if second:
            crc.append(run := crc32(second, run))
            if third:
                crc.append(crc32(third, run))
    return words, np.sort(np.array(crc, np.uint32) % buckets).astype(np.uint16)


def featurised(texts: DataFrame, ids: Column, name: str, buckets: int = BUCKETS) -> DataFrame:
    """row, doc_id, n_words, n_features and the buckets (as differences, so that they compress) of every text."""
    def mapped(batches):
        for batch in batches:
            got = [features(t, buckets) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([w for w, _ in got], pa.int64()),
                 pa.array([len(b) for _, b in got], pa.int64()),
                 pa.array([np.diff(b, prepend=np.uint16(0)).tobytes() for _, b in got], pa.binary())],
                names=["row", "doc_id", "n_words", "n_features", "steps"])

    rows = texts.select(F.monotonically_increasing_id().alias("row"), ids.cast("bigint").alias("doc_id"), "text")
    return written(rows.mapInArrow(mapped, "row bigint, doc_id bigint, n_words bigint, n_features bigint, steps binary"), name)


def buckets_of(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, np.uint16), dtype=np.int64)


def totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows: one vector a task, summed by Spark (``buckets`` rows reach the driver)."""
    def mapped(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for steps in batch.column(0).to_pylist():
                counts += np.bincount(buckets_of(steps), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    summed = found.select("steps").mapInArrow(mapped, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """row, doc_id, n_words, n_features and weight of every document."""
    def mapped(batches):
        for batch in batches:
            weight = [int(gain[buckets_of(s)].sum()) for s in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(weight, pa.int64())],
                                             names=["row", "doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(mapped, "row bigint, doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) with u from the first 32 bits of sha256(seed:doc_id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document.

    Of the N documents with at least ``least_words`` words the floor(percent N / 100)
    highest scores are drawn and ranked from 1; all others have a null rank.
    Ties go to the smaller id, then the smaller weight and feature count.
    """
    ready(docs.sparkSession)
    found = featurised(docs, F.col("doc_id"), "resample-features", buckets)
    wanted = featurised(target, F.lit(None), "resample-target", buckets)
    gain = gains(totals(found, buckets), totals(wanted, buckets))
    scored = written(weighted(found, gain).withColumn("score", (F.col("weight") + gumbel(seed)).cast("bigint")),
                     "resample-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = [F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("row")]
    ranked = global_running_sum(able.withColumn("one", F.lit(1).cast("bigint")), order, "one", "rank").drop("one")
    both = (ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
            .unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))))
    return both.select("doc_id", "n_features", "weight", "score", "rank")
