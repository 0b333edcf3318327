"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact weighted-shingle similarity.

For every document the positions whose word shingle occurs in some benchmark
item are found first. A window as long as an item can reach the similarity only
if it holds at least t (s + s') / (1 + t) such positions (s, s' shingles of item
and window), so the other windows are skipped without loss. Each remaining
window gets a 64-bit SimHash of its weighted shingles. Items within ``RADIUS``
bits are found through eight one-byte blocks: at most 23 differing bits leave a
block with at most 2, and each item is stored under all bytes within 2 bits of
its own, so the index misses no fingerprint inside the radius. Candidates are
verified by the exact weighted similarity (multiset Jaccard, a shingle weighs
as often as it occurs). Similarity 0.8 is expected about 10 bits apart, the
radius lies more than four standard deviations beyond it.

The benchmark is sent to the tasks in blocks of about ``BLOCK_ITEMS`` items and
``BLOCK_BYTES`` bytes of text. One block is looked for in the pass over the documents.
Of a larger benchmark, all shingles go into one bit filter (Spark builds it; at most
``FILTER_MOST`` bits), and one pass over the documents keeps the suspects: those with a window that has
enough shingles in the filter. The filter misses no shingle, so no document is lost; a full filter only lets
more through. The blocks, one after the other, meet the suspects alone.
Documents are never shuffled.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fresh, ready, written
from shelfcast.session import scratch_path

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
BLOCK_ITEMS, BLOCK_BYTES = 4096, 16 << 20
#: Bits of the shingle filter: so many for each shingle, 16 MB at most; bits set by one shingle.
FILTER_BITS, FILTER_MOST, PROBES = 32, 1 << 27, 4
#: Word positions looked at together: bounds the bit sums of very long texts.
SPAN = 1 << 14
WORD = re.compile(r"\w+")
_NEAR = [[b for b in range(256) if (a ^ b).bit_count() <= RADIUS // 8] for a in range(256)]


def _mix(parts: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` neighbouring numbers."""
    out = np.zeros(max(0, len(parts) - k + 1), np.uint64)
    for i in range(k):
        out = (out ^ parts[i:len(parts) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[str], k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` neighbouring words."""
    numbers = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    return _mix(numbers + np.uint64(1), k)


def _starts(hit: np.ndarray, k: int, n: int, size: int, similarity: float) -> np.ndarray:
    """Where a window of ``size`` words has enough hit positions to reach the similarity to an item of ``n`` words."""
    shingles = size - k + 1
    need = math.ceil(similarity * (n - k + 1 + shingles) / (1 + similarity) - 1e-9)
    held = np.concatenate([[0], np.cumsum(hit)])
    return np.flatnonzero(held[shingles:] - held[:-shingles] >= need)


def _sums(hashes: np.ndarray) -> np.ndarray:
    """Running counts of set bits, one row more than hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def _prints(ones: np.ndarray, size: int) -> np.ndarray:
    return np.packbits(ones * 2 > size, axis=1, bitorder="little").view("<u8").ravel()


class Finder:
    """An index over one block of items [(item_id, text)]; items without words are left out."""

    def __init__(self, items, similarity: float = SIMILARITY, shingle: int = SHINGLE):
        self.similarity = similarity
        self.vocabulary: dict[str, int] = {}
        self.items = []                                       # (item_id, words, k, shingles, fingerprint)
        self.lengths = defaultdict(set)                       # k -> lengths of items with k-word shingles
        self.blocks = defaultdict(list)                       # (length, block, byte) -> item numbers
        codes = defaultdict(set)
        for item_id, text in items:
            words = WORD.findall((text or "").lower())
            if not words:
                continue
            k, n = min(shingle, len(words)), len(words)
            ids = np.asarray([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64)
            codes[k].update(_mix(ids, k).tolist())
            hashes = _hashes(words, k)
            fp = int(_prints(_sums(hashes)[-1:], len(hashes))[0])
            for block in range(8):
                for byte in _NEAR[fp >> (8 * block) & 255]:
                    self.blocks[n, block, byte].append(len(self.items))
            self.lengths[k].add(n)
            self.items.append((item_id, n, k, Counter(hashes.tolist()), fp))
        self.codes = {k: np.sort(np.fromiter(c, np.uint64, len(c))) for k, c in codes.items()}

    def matches(self, text: str | None) -> list[tuple]:
        """(item_id, similarity, start, end) of each contained item: its best window, in code points."""
        words = WORD.findall((text or "").lower())
        if not words or not self.items:
            return []
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        best: dict[int, tuple] = {}
        for k, codes in self.codes.items():
            if len(words) < k:
                continue
            at = _mix(ids, k)
            hit = codes[np.minimum(np.searchsorted(codes, at), len(codes) - 1)] == at
            if not hit.any():
                continue
            for n in self.lengths[k]:
                size = min(n, len(words))
                self._windows(words, hit, k, n, size, best)
        if not best:
            return []
        places = [m.span() for m in WORD.finditer(text.lower())] if len(text.lower()) != len(text) else \
            [m.span() for m in WORD.finditer(text)]
        return [(self.items[i][0], sim, places[w][0], places[w + size - 1][1])
                for i, (sim, w, size) in sorted(best.items())]

    def _windows(self, words, hit, k, n, size, best) -> None:
        shingles = size - k + 1
        starts = _starts(hit, k, n, size, self.similarity)
        low = 0
        while low < len(starts):
            first = starts[low]
            high = int(np.searchsorted(starts, first + SPAN))
            part = starts[low:high]
            hashes = _hashes(words[first:part[-1] + size], k)
            sums = _sums(hashes)
            local = part - first
            fps = _prints(sums[local + shingles] - sums[local], shingles).tolist()
            for w, fp in zip(local.tolist(), fps):
                seen = {i for block in range(8) for i in self.blocks.get((n, block, fp >> (8 * block) & 255), ())}
                window = None
                for i in seen:
                    _, _, _, counts, item_fp = self.items[i]
                    if (fp ^ item_fp).bit_count() > RADIUS:
                        continue
                    window = window or Counter(hashes[w:w + shingles].tolist())
                    both = sum((counts & window).values())
                    similarity = both / (counts.total() + shingles - both)
                    if similarity >= self.similarity and (i not in best or similarity > best[i][0]):
                        best[i] = (similarity, int(first) + w, size)
            low = high


def _places(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The bits of every shingle in a filter of ``bits`` (a power of two), a row for each probe."""
    first = hashes ^ np.uint64(k * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    step = (first >> np.uint64(32)) | np.uint64(1)
    return np.stack([(first + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)])


class Filter:
    """All shingles of a benchmark as set bits, and the (shingle words, words) of its items."""

    def __init__(self, masks: np.ndarray, sizes: list[tuple[int, int]], similarity: float = SIMILARITY):
        self.masks, self.bits, self.similarity = masks, len(masks) * 64, similarity
        self.lengths = defaultdict(list)
        for k, n in sizes:
            self.lengths[k].append(n)

    def suspect(self, text: str | None) -> bool:
        """Whether a window of the text has enough shingles in the filter; never false if it matches an item."""
        words = WORD.findall((text or "").lower())
        for k, lengths in self.lengths.items():
            if len(words) < k:
                continue
            at = _places(_hashes(words, k), k, self.bits)
            hit = np.bitwise_and.reduce(self.masks[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1), axis=0)
            if hit.any() and any(len(_starts(hit, k, n, min(n, len(words)), self.similarity)) for n in lengths):
                return True
        return False


def shingle_filter(benchmark: DataFrame, similarity: float = SIMILARITY) -> Filter:
    """The filter of a whole benchmark: its words of 64 bits are combined in Spark, at most FILTER_MOST / 64 reach the driver."""
    def shingled(text):
        words = WORD.findall((text or "").lower())
        return words, min(SHINGLE, len(words))

    def sized(batches):
        for batch in batches:
            seen = Counter((k, len(w)) for w, k in map(shingled, batch.column(0).to_pylist()) if w)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in seen], pa.int32()), pa.array([x[1] for x in seen], pa.int64()),
                                              pa.array(seen.values(), pa.int64())], names=["k", "n", "items"])

    texts = benchmark.select("text")
    sizes = texts.mapInArrow(sized, "k int, n bigint, items bigint").groupBy("k", "n").agg(F.sum("items").alias("items")).collect()
    shingles = sum((r.n - r.k + 1) * r["items"] for r in sizes)
    bits = min(FILTER_MOST, 1 << max(6, (FILTER_BITS * shingles).bit_length()))

    def marked(batches):
        for batch in batches:
            for words, k in map(shingled, batch.column(0).to_pylist()):
                if words:
                    at = _places(_hashes(words, k), k, bits).ravel()
                    slot, group = np.unique(at >> np.uint64(6), return_inverse=True)
                    mask = np.zeros(len(slot), np.uint64)
                    np.bitwise_or.at(mask, group, np.uint64(1) << (at & np.uint64(63)))
                    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(mask.view(np.int64))],
                                                     names=["slot", "mask"])

    got = texts.mapInArrow(marked, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    masks = np.zeros(bits // 64, np.uint64)
    masks[got["slot"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64).view(np.uint64)
    return Filter(masks, sorted((r.k, r.n) for r in sizes), similarity)


def _chosen(df: DataFrame, test, wanted: bool) -> DataFrame:
    """The rows whose text gives ``wanted`` in the test; ``test()`` makes it, once a task."""
    where = df.columns.index("text")

    def mapped(batches):
        passes = test()
        for batch in batches:
            yield batch.filter(pa.array([passes(t) == wanted for t in batch.column(where).to_pylist()], pa.bool_()))

    return df.mapInArrow(mapped, df.schema)


def _parts(benchmark: DataFrame) -> int:
    rows, size = benchmark.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    if rows <= BLOCK_ITEMS and (size or 0) <= BLOCK_BYTES:
        return 1
    return max(2, math.ceil(rows / BLOCK_ITEMS * 1.2), math.ceil(size / BLOCK_BYTES * 1.2))


def _blocks(benchmark: DataFrame, parts: int):
    """The items in bounded blocks, by hash; each is read from its own folder."""
    spark = benchmark.sparkSession
    path = scratch_path(spark, f"llm/benchmark-{uuid.uuid4().hex}")
    items = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("block"))
    items.repartition("block").write.partitionBy("block").parquet(path)
    stored = spark.read.schema(items.schema).parquet(path)
    for number in range(parts):
        yield [(r.item_id, r.text) for r in stored.filter(F.col("block") == number).collect()]


def _found(rows: DataFrame, sent, similarity: float) -> DataFrame:
    """The matches of (key, text) rows with the items of one block."""
    def mapped(batches):
        finder = Finder(sent.value, similarity)
        for batch in batches:
            rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for m in finder.matches(t)]
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=["key", "item_id", "similarity", "start", "end"])

    return rows.mapInArrow(mapped, "key bigint, item_id bigint, similarity double, start bigint, end bigint")


def _found_in_blocks(suspects: DataFrame, benchmark: DataFrame, parts: int, similarity: float) -> DataFrame:
    """``_found`` for every block in turn; a block leaves the executors when its matches are written."""
    out = None
    for items in _blocks(benchmark, parts):
        sent = suspects.sparkSession.sparkContext.broadcast(items)
        part = written(_found(suspects, sent, similarity), "contaminated")
        sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, start, end) for every document and benchmark item found in it.

    Clean documents give no row. Null or wordless texts and items match nothing;
    repeated documents and items give a row each; a document shorter than an item
    is one window; empty tables give an empty result; other columns are ignored.
    """
    context = ready(docs.sparkSession).sparkContext
    parts, rows = _parts(benchmark), docs.select(F.col("doc_id").cast("bigint").alias("key"), "text")
    if parts == 1:
        items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
        found = _found(rows, context.broadcast(items), similarity)
    else:
        seen = context.broadcast(shingle_filter(benchmark, similarity))
        suspects = written(_chosen(rows, lambda: seen.value.suspect, True), "suspects")
        found = _found_in_blocks(suspects, benchmark, parts, similarity)
    return found.withColumnRenamed("key", "doc_id")


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; all columns stay.

    With several blocks the documents are read twice: for the suspects, which
    are numbered and written, and for the others, which stay as they are.
    """
    context = ready(docs.sparkSession).sparkContext
    parts = _parts(benchmark)
    if parts == 1:
        sent = context.broadcast([tuple(r) for r in benchmark.select("item_id", "text").collect()])

        def matcher():
            finder = Finder(sent.value, similarity)
            return lambda text: bool(finder.matches(text))

        return _chosen(docs, matcher, False)
    seen = context.broadcast(shingle_filter(benchmark, similarity))
    key = fresh(docs, "suspect")
    suspects = written(_chosen(docs, lambda: seen.value.suspect, True).withColumn(key, F.monotonically_increasing_id()), "suspects")
    found = _found_in_blocks(suspects.select(F.col(key).alias("key"), "text"), benchmark, parts, similarity)
    stay = suspects.join(found.select(F.col("key").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
    return _chosen(docs, lambda: seen.value.suspect, False).unionByName(stay)
