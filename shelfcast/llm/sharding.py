"""Sharding by sampled splitters (law ``bytes``).

1. ``measured``: one narrow row per document (size, hashes); written once.
2. ``splitters``: a size-weighted sample of the keys, drawn by hash; its weighted
   quantiles are the boundaries of many fine ranges of the key space. The key is
   (hash of the text, hash of the row), so equal texts are neighbours. A boundary
   inside a group of equal texts is moved to the group's start unless the group
   alone overfills a range; then the group stays cut, by the row hash.
3. Exact bytes per fine range are measured; overfull ranges are sampled again,
   at a finer rate, and subdivided.
4. Neighbouring ranges become shards by their running bytes.

Only the bounded key sample and one row per fine range reach the driver.
"""

from __future__ import annotations

import uuid
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import dealt_rank, ready, written
from shelfcast.session import scratch_path

SHARDS = 16
#: Fine ranges for each shard, and sampled keys for each fine range.
RANGES, KEYS = 64, 64
#: A fine range over this multiple of its due bytes is subdivided.
OVERFULL = 1.5
ROUNDS = 4


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32 and the two key hashes; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text).cast("bigint") + 1).alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h1"),
                       F.xxhash64(F.lit(7), "doc_id", text).alias("h2"))


def key_bytes(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Keys as 16 big-endian bytes whose byte order is the order of (h1, h2)."""
    pairs = np.stack([np.asarray(h1, np.int64), np.asarray(h2, np.int64)], axis=1)
    return (pairs.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view("S16").ravel()


def lookup(df: DataFrame, edges: np.ndarray, values: np.ndarray, out: str) -> DataFrame:
    """Add ``out`` = values[number of edges at or below the row's key]; one bounded array goes to the tasks."""
    @F.pandas_udf("int")
    def place(h1: pd.Series, h2: pd.Series) -> pd.Series:
        keys = key_bytes(h1.to_numpy(), h2.to_numpy())
        return pd.Series(values[np.searchsorted(edges, keys, side="right")])

    return df.withColumn(out, place("h1", "h2"))


def sample_edges(keys: DataFrame, due: float) -> np.ndarray:
    """Boundaries about ``due`` bytes apart, from a sample in which a row's chance is its size x KEYS / due."""
    step = due / KEYS
    chance = F.pmod(F.xxhash64(F.lit(11), "h2"), F.lit(1 << 30)) / float(1 << 30)
    drawn = (keys.filter(chance < F.col("size") / step)
             .select("h1", "h2", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("w"))).toPandas()
    if drawn.empty:
        return np.empty(0, "S16")
    drawn = drawn.sort_values(["h1", "h2"])
    h1, h2, w = (drawn[c].to_numpy() for c in ("h1", "h2", "w"))
    end = np.cumsum(w)
    picks = np.unique(np.searchsorted(end, np.arange(due, end[-1], due)))
    picks = picks[picks < len(h1)]
    group = drawn.groupby("h1")["w"].transform("sum").to_numpy()
    h2 = np.where(group > due, h2, np.iinfo(np.int64).min)      # light groups stay whole
    return np.unique(key_bytes(h1[picks], h2[picks]))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Null ids and texts, repeated rows and empty tables are kept as they are
    (an empty table gives an empty result); other columns are ignored. A warning
    counts the ranges that ``ROUNDS`` subdivisions leave overfull beside their
    longest row; the result is whole all the same, with shards less equal.
    """
    ready(docs.sparkSession)
    keys = written(measured(docs), "shard-keys")
    total, rows = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    edges = np.empty(0, "S16")
    if total:
        due = total / (shards * RANGES)
        edges = sample_edges(keys, due)
        for left in range(ROUNDS, -1, -1):
            numbered = lookup(keys, edges, np.arange(len(edges) + 1, dtype=np.int32), "range")
            full = {r: (b, most) for r, b, most in
                    numbered.groupBy("range").agg(F.sum("size"), F.max("size")).collect()}
            over = [r for r, (b, most) in full.items() if b > OVERFULL * due and most < b]
            if not over:
                break
            more = edges
            if left:
                inside = numbered.filter(F.col("range").isin(over))
                more = np.unique(np.concatenate([edges, sample_edges(inside, due / 4)]))
            if len(more) == len(edges):
                rest = [b - most for b, most in (full[r] for r in over) if b - most > OVERFULL * due]
                if rest:
                    warnings.warn(f"{len(rest)} of {len(full)} key ranges stay overfull, the largest with "
                                  f"{max(rest) / due:.1f} times its due bytes beside its longest row")
                break
            edges = more
        got = np.zeros(len(edges) + 1)
        for r, (b, _) in full.items():
            got[r] = b
        middle = np.cumsum(got) - got / 2
        owner = np.minimum(middle * shards // total, shards - 1).astype(np.int32)
    else:
        owner = np.zeros(1, np.int32)
    placed = lookup(keys, edges, owner, "shard")
    ranked = dealt_rank(placed, ["shard"], ["h1", "h2", "doc_id", "size", "text_crc32"], "slot", rows)
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS) -> str:
    """Write the documents as one folder per shard (``shard=k``); returns the path."""
    path = path or scratch_path(docs.sparkSession, f"llm/shards-{uuid.uuid4().hex}")
    placed = shard_documents(docs, shards).select("doc_id", "text_crc32", "shard").distinct()
    body = docs.withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit(""))))
    joined = body.alias("d").join(placed.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
                                  & (F.col("d.text_crc32") == F.col("p.text_crc32")))
    joined.select("d.*", "p.shard").drop("text_crc32").write.partitionBy("shard").parquet(path)
    return path
