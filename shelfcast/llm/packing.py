"""Packing documents into sequences of at most 4096 tokens by cutting stock.

``token_pieces`` tokenises every document once and cuts it into pieces: full
sequences and one remainder. The pieces with their ids are a written table.
``pack`` then works on lengths only: the exact histogram of piece lengths (at
most one row per class, so bounded) goes through the column generation of
``cutting_stock``; its whole-numbered patterns claim ranked pieces of each class
by arithmetic on running counts, so no sequence is built by a scan.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import dealt_rank, ready, written
from shelfcast.llm.cutting_stock import solve

CAPACITY = 4096
#: Lengths are rounded up to this many tokens for the patterns (at most CAPACITY / GRAIN classes).
GRAIN = 16
END_ID = 2
#: Words whose ids one worker remembers at most.
CACHE_WORDS = 800_000

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, "
          "text_crc32 bigint")

# The pre-tokens of word_bpe_49k.json, for lower-case Latin-1 text.
LATIN_TOKENS = ("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]"
                "|[^\\t\\n\\x0b\\x0c\\r \\x85\\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    The vocabulary's splitter is context-free, so a pre-token's ids never depend
    on its neighbours: Latin-1 text is split here and each word's ids are looked
    up, new words being encoded by the tokenizer itself. Any other text, and any
    text with the marker of a special token, goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)                   # the same model, for words already split
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words: dict[str, bytes] = {}
        self.split = re.compile(LATIN_TOKENS).findall
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)       # ids that end a pre-token
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole([text])[0]
        if "<|" in text:
            return self.whole([text])[0]
        tokens = self.split(text.lower())
        words = self.words
        try:
            return b"".join([words[t] for t in tokens])
        except KeyError:
            pass
        if len(words) > CACHE_WORDS:
            words.clear()
        new = [t for t in set(tokens) if t not in words]
        words.update(zip(new, self.each(new)))
        return b"".join([words[t] for t in tokens])

    def each(self, new: list[str]) -> list[bytes]:
        """The ids of each pre-token: encoded in one text, where every pre-token closes with one ending id."""
        joined = self.plain.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0]
        ids = np.asarray(joined.ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(new):
            return self.whole(new)
        data, at = ids.tobytes(), 0
        out = []
        for stop in (4 * stops).tolist():
            out.append(data[at:stop])
            at = stop
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ids of the text and then END_ID, cut every ``capacity`` ids."""
    def cut(batches):
        enc = encoder(tokenizer)
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                ids = enc.ids(text) + end
                check = zlib.crc32(text.encode())
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, at // 4, len(part) // 4, part, zlib.crc32(part), len(ids) // 4, check))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
                                                    "text_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def slots(patterns: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, copies a sequence, first sequence): which ranks each pattern claims."""
    claimed: dict[int, int] = {}
    out, sequence = [], 0
    for column, times in patterns:
        for j in np.flatnonzero(column):
            copies, first = int(column[j]), claimed.get(int(j), 0)
            claimed[int(j)] = first + copies * times
            out.append((int(j), first, first + copies * times, copies, sequence))
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Add sequence_id and offset to every piece; ``pieces`` must be a written table.

    Lengths are at most ``capacity``. Repeated rows are separate pieces; null
    ids are ordinary values.
    """
    spark = pieces.sparkSession
    classed = pieces.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = sorted((r[0], r[1]) for r in classed.groupBy("class").count().collect())   # at most capacity / grain
    widths = np.asarray([c for c, _ in histogram], np.int64)
    demand = np.asarray([n for _, n in histogram], np.int64)
    claims = [(int(widths[j]), *rest) for j, *rest in slots(solve(widths, demand, capacity // grain))]
    claimed = spark.createDataFrame(claims, "class int, first bigint, stop bigint, copies bigint, sequence bigint")
    by_class = claimed.groupBy("class").agg(F.array_sort(F.collect_list(
        F.struct("stop", "first", "copies", "sequence"))).alias("claims"))      # one row per class: bounded
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "text_crc32"]
    ranked = dealt_rank(classed, ["class"], order, "rank", int(demand.sum()))
    claim = F.element_at(F.filter("claims", lambda c: c["stop"] > F.col("rank")), 1)
    placed = (ranked.join(F.broadcast(by_class), "class").withColumn("c", claim)
              .withColumn("sequence_id", F.expr("c.sequence + (rank - c.first) div c.copies"))
              .drop("c", "claims"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)                                          # at most ``capacity`` pieces
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))
            .drop("class", "rank"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN,
                   with_ids: bool = False) -> DataFrame:
    """Pack all documents: one row per piece with its place, and its ids if asked for.

    A null text counts as empty (only END_ID); empty and repeated texts and null
    ids are packed like any other; an empty table gives an empty result. Other
    columns are ignored.
    """
    ready(docs.sparkSession)
    pieces = written(token_pieces(docs, tokenizer, capacity), "pieces")
    narrow = [c for c in pieces.columns if with_ids or c != "ids"]
    return pack(pieces.select(*narrow), capacity, grain).drop("text_crc32")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids binary, n_tokens) from ``pack_documents(with_ids=True)``: the training file itself."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))             # bounded by the capacity
    return packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"), "n_tokens")
