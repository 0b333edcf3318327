"""Secrets: base spans by pattern, and weak candidates linked by what stands near them.

Each text is scanned once for parts of credentials. Strong parts (assignments,
access keys, long hexadecimal runs) are the base spans. Weak candidates are
``id`` (a named account or client identifier), ``key`` (a long token that mixes
cases and digits) and ``endpoint`` (a service address); alone they mean nothing.
Parts have a role: identifier, secret or endpoint. A weak candidate is reported
only if a part with a complementary role stands within ``SCOPE`` characters in
the same text and does not overlap it: identifiers need a secret, keys need an
identifier or an endpoint, endpoints need a secret. So no text completes itself.

The linking is an interval join over all documents: parts are dealt to cells of
SCOPE characters, a candidate looks into its own and the neighbouring cells, so
a cell holds a bounded number of parts whatever the text's length.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ready, written

# Kinds in the order of a digest, base patterns, weak patterns and roles.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
BASE = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HINT = re.compile(r"pass|secret|token|key", re.IGNORECASE)
LONG_HEX = re.compile(r"[0-9a-f]{24}")
WEAK_ID = re.compile(r"""\b(?:client|account|access|tenant|user)[_-]?(?:id|name)?["']?\x20?[:=]\x20?["']?[A-Za-z0-9_.@-]{4,}""",
                     re.IGNORECASE | re.ASCII)
WEAK_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]{4,}", re.ASCII)
SECRET, IDENTIFIER, PLACE = "secret", "identifier", "endpoint"
ROLES = {"assign": SECRET, "hex": SECRET, "key": SECRET, "access": IDENTIFIER, "id": IDENTIFIER, "endpoint": PLACE}
NEEDS = {"id": (SECRET,), "key": (IDENTIFIER, PLACE), "endpoint": (SECRET,)}

SCOPE = 200
PART = "struct<start:int,kind:int,end:int>"


def parts_of(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, weak) spans (start, kind, end) of a whole text, sorted; weak ones overlap no base span."""
    text = text or ""
    base = []
    if HINT.search(text):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if LONG_HEX.search(text):
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    weak = []
    if ":" in text or "=" in text:
        weak += [(m.start(), 3, m.end()) for m in WEAK_ID.finditer(text)]
    weak += [(m.start(), 4, m.end()) for m in WEAK_KEY.finditer(text)
             if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])]
    if "://" in text:
        weak += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    base.sort()
    covered = sorted((s, e) for s, _, e in base)
    return base, sorted(w for w in weak if not _touches(covered, w))


def _touches(covered: list[tuple[int, int]], part: tuple[int, int, int]) -> bool:
    """Does a base span overlap the part? Base spans of one kind are disjoint, so few lie to its left."""
    i = bisect.bisect_left(covered, (part[2], -1))
    return any(e > part[0] for _, e in covered[max(0, i - 3 * BASE):i])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, row_key and the base and weak parts of every document."""
    def mapped(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            got = [parts_of(t) for t in batch.column(2).to_pylist()]
            sides = [pa.array([[dict(zip(("start", "kind", "end"), p)) for p in g[i]] for g in got], kind)
                     for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *sides],
                                             names=["doc_id", "row_key", "base", "weak"])

    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("doc_id", "text").alias("row_key"), "text").mapInArrow(
        mapped, f"doc_id bigint, row_key bigint, base array<{PART}>, weak array<{PART}>")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row_key, terms): the weak parts of each document with a complementary part within ``scope`` characters."""
    names = F.array(*map(F.lit, KINDS))
    roles = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    kind = F.element_at(names, F.col("p.kind") + 1)
    each = (parts.filter(F.size("weak") > 0).dropDuplicates(["row_key"])
            .select("row_key", F.explode(F.concat("base", "weak")).alias("p"))
            .select("row_key", "p.*", F.element_at(roles, kind).alias("role")))
    first, last = F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope)
    placed = each.select("*", F.explode(F.sequence(first, last)).alias("cell"))
    wanted = F.array().cast("array<string>")
    for k, name in enumerate(KINDS):
        if name in NEEDS:
            wanted = F.when(F.col("kind") == k, F.array(*map(F.lit, NEEDS[name]))).otherwise(wanted)
    looking = (each.filter(F.col("kind") >= BASE).withColumn("want", F.explode(wanted))
               .select("row_key", "start", "kind", "end", "want", F.explode(F.sequence(first - 1, last + 1)).alias("cell")))
    near = looking.alias("w").join(placed.alias("p"), (F.col("w.row_key") == F.col("p.row_key"))
                                   & (F.col("w.cell") == F.col("p.cell")) & (F.col("w.want") == F.col("p.role"))
                                   & (F.col("p.start") - F.col("w.end") <= scope)
                                   & (F.col("w.start") - F.col("p.end") <= scope)
                                   & ((F.col("p.start") >= F.col("w.end")) | (F.col("p.end") <= F.col("w.start"))), "left_semi")
    return near.groupBy("row_key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("reported"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and all spans (start, kind, end; sorted) of every document.

    A null text counts as empty; repeated rows get the same spans; null ids are
    ordinary; an empty table gives an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    parts = written(scan(docs), "secret-parts")
    joined = parts.join(linked(parts), "row_key", "left")
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce(
        "reported", F.array().cast(f"array<{PART}>")))).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the count of each base kind, the digest of the base spans and all spans."""
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return find(docs).select("doc_id", *[number(k) for k in range(BASE)],
                             F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
