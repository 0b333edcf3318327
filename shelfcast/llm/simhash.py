"""SimHash near-duplicates through a byte-position index with count filtering.

Two 64-bit fingerprints within 3 bits agree in at least 5 of their 8 bytes. The
index keys are positional bytes taken three at a time, in the eight triples that
lie inside {0,1,2,3} or inside {4,5,6,7}: any five of the eight positions hold
one of them, so every linked pair meets under a key. For the pairs of a key's
postings the shared positional bytes are tallied, pairs reaching the guaranteed
five are kept, and their bit distance is verified.

Postings longer than POSTINGS go on to longer keys (the triple and two more
bytes; a linked pair shares two of the other five). Postings that are still too
long are linked through masks: with five bytes equal, two fingerprints within
3 bits become equal once the right 3 of the remaining 24 bits are blanked, and at
most 8 fingerprints share such a masked value. So no step forms all pairs of a
large group, and no link is lost.

Only distinct fingerprints are indexed; each posting list gives a spanning
forest of its links, which is enough for the components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ready, written
from shelfcast.llm.graph import components

SHINGLE, RADIUS = 3, 3
#: Longest posting list whose pairs are tallied in one place.
POSTINGS = 2048
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
#: Shingle hashes whose bits are summed at once.
CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, repeats included; no word: 0."""
    words = (text or b"").lower().split()               # bytes: A-Z only, split at 20 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(shingle, len(words))
    at, to = starts[:len(words) - span + 1].tolist(), ends[span - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, len(at), CHUNK):
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(at[low:low + CHUNK], to[low:low + CHUNK])),
                             np.uint64, len(at[low:low + CHUNK]))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(at), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep`` and fp (the fingerprint as a signed long) of every row."""
    def mapped(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column(0).to_pylist()), np.uint64,
                              batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps.view(np.int64))],
                                             names=[*batch.schema.names[1:], "fp"])

    picked = docs.select(F.col("text").cast("binary"), F.col("doc_id").cast("bigint"), *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:]]
    return picked.mapInArrow(mapped, ", ".join([*fields, "fp bigint"]))


def _bytes_at(fp, positions) -> F.Column:
    mask = sum(0xFF << (8 * p) for p in positions)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _postings(fps: DataFrame, keys: list[tuple[int, ...]]) -> DataFrame:
    """(k, v, fp): each fingerprint under each key's positional bytes."""
    entries = [F.struct(F.lit(i).cast("short").alias("k"), _bytes_at(F.col("fp"), key).alias("v"))
               for i, key in enumerate(keys)]
    return fps.select("fp", F.inline(F.array(*entries)))


def _sized(postings: DataFrame, groups: list[str]) -> DataFrame:
    """Postings with more than one member, and their length ``n``."""
    sizes = postings.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return written(postings.join(sizes, groups), "postings")


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links inside one posting list (at most POSTINGS long): tally bytes, keep, verify."""
    need = 8 - radius
    left = np.arange(len(fps))
    edges = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            xor = fps[left] ^ fps[at]
            shared = (xor.view(np.uint8).reshape(-1, 8) == 0).sum(1)
            near = (shared >= need) & (np.bitwise_count(xor) <= radius)
            if near.any():
                edges += [(int(fps[at]), int(x)) for x in fps[left[near]]]
                queue += left[near].tolist()
                left = left[~near]
    return edges


def _linked(short: DataFrame, groups: list[str], radius: int) -> DataFrame:
    """Edges inside each short posting list; the lists themselves are bounded by POSTINGS."""
    def mapped(batches):
        for batch in batches:
            edges = [e for fps in batch.column(0).to_pylist() for e in _forest(np.asarray(fps, np.int64).view(np.uint64), radius)]
            a, b = (np.asarray(x, np.uint64).view(np.int64) for x in (zip(*edges) if edges else ((), ())))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    lists = short.groupBy(*groups).agg(F.collect_list("fp").alias("fps")).select("fps")
    return lists.mapInArrow(mapped, "a bigint, b bigint")


def _masked(postings: DataFrame, free: list[int], groups: list[str]) -> DataFrame:
    """Edges of fingerprints that agree outside 3 blanked bits of the bytes ``free``; at most 8 share a mask."""
    bits = [8 * p + i for p in free for i in range(8)]
    flips = [sum(1 << b for b in three) for three in combinations(bits, 3)]
    signed = [~f & ((1 << 64) - 1) for f in flips]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in signed])
    spread = (postings.withColumn("mask", F.explode(masks))
              .withColumn("rest", F.col("fp").bitwiseAND(F.col("mask"))))
    groups_of = spread.groupBy(*groups, "mask", "rest").agg(F.collect_set("fp").alias("fps"), F.min("fp").alias("b"))
    return groups_of.filter("size(fps) > 1").select(F.explode("fps").alias("a"), "b").filter("a <> b")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) edges between distinct fingerprints (column fp) whose components are those of all pairs within ``radius``."""
    if radius != 3:
        raise ValueError("the index keys guarantee radius 3")
    first = _sized(_postings(fps, TRIPLES), ["k", "v"])
    edges = _linked(first.filter(F.col("n") <= POSTINGS), ["k", "v"], radius)
    long = first.filter(F.col("n") > POSTINGS)
    if long.isEmpty():
        return edges
    fives = sorted({tuple(sorted(t + two)) for t in TRIPLES for two in combinations(sorted(set(range(8)) - set(t)), 2)})
    second = _sized(_postings(long.select("fp").distinct(), fives), ["k", "v"])
    edges = edges.unionByName(_linked(second.filter(F.col("n") <= POSTINGS), ["k", "v"], radius))
    longer = second.filter(F.col("n") > POSTINGS)
    for k in [r[0] for r in longer.select("k").distinct().collect()]:            # at most the 56 keys
        free = sorted(set(range(8)) - set(fives[k]))
        edges = edges.unionByName(_masked(longer.filter(F.col("k") == k), free, ["k", "v"]))
    return edges


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint (hex), component_id, the group's root and the columns ``keep`` for every row.

    A null, empty or wordless text has fingerprint zero and is linked like any
    other. component_id is the least non-null doc_id reachable (null if there is
    none); root tells groups apart in any case. Repeated rows stay; an empty
    table gives an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    rows = written(fingerprints(docs, shingle, keep), "fingerprints")
    known = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    rooted = components(links(known.select("fp"), radius)).withColumnRenamed("node", "fp")
    marked = known.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = marked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(marked.select("fp", "root").join(ids, "root").select("fp", "root", "component_id"),
                    "named-fingerprints")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                         "component_id", "root", *keep)
