"""Helpers shared by the operators: sessions, written intermediates, distributed ranks, bounded samples."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.session import ensure_checkpoint_dir, scratch_path, ship_code

#: Rows of one Arrow batch: whole texts travel in them, so few rows bound a worker's memory.
BATCH_ROWS = 256
#: Rows of one (group, bucket) window in ``dealt_rank``; sets the number of buckets.
BUCKET_ROWS = 20_000


def ready(spark: SparkSession) -> SparkSession:
    """Prepare a session: shared folder, package on the executors, small Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet below the shared folder and read it back.

    This cuts the lineage: whatever reads the result after the loss of an
    executor reads files, never a recomputed (and maybe reordered) plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_rank(df: DataFrame, groups: list[str], order: list[str], out: str, rows: int,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``out`` = gapless rank (from 0) of each row inside its group, without a task per group.

    Rows are dealt to hash buckets of ``order``; a window ranks inside (group,
    bucket) and the buckets' counts, summed over the group, give the offsets.
    ``order`` must tell all different rows apart; equal rows are interchangeable.
    The rank follows the buckets, not ``order`` itself.
    """
    buckets = max(64, math.ceil(rows / bucket_rows))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    return (dealt.withColumn("_rank", F.row_number().over(inside) - 1)
            .join(offsets, [*groups, "_bucket"])
            .withColumn(out, (F.col("_rank") + F.col("_before")).cast("bigint"))
            .drop("_bucket", "_rank", "_before"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the value as text, modulo ``divisor`` (null: null)."""
    return F.crc32(F.col(column).cast("string")) % divisor


def hashed_part(df: DataFrame, key: str, wanted: int, seed: str) -> DataFrame:
    """About ``wanted`` rows (all if fewer), the same ones in every run: a threshold on a salted hash of ``key``."""
    total = df.count()
    if total <= wanted:
        return df
    limit = int(wanted / total * 2 ** 32)
    return df.filter(F.crc32(F.concat(F.lit(seed), F.col(key).cast("string"))) < limit)


def hashed_parts(df: DataFrame, key: str, by: str, wanted: int, seed: str) -> DataFrame:
    """``hashed_part`` for each value of ``by``: a quarter of ``wanted`` is dealt evenly to the values, the rest by their counts."""
    counts = {r[0]: r[1] for r in df.groupBy(by).count().collect()}
    total = sum(counts.values())
    if total <= wanted:
        return df
    even = wanted / 4 / len(counts)
    share = {v: min(1.0, even / n + 0.75 * wanted / total) for v, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for v, p in share.items() for x in (v, int(p * 2 ** 32))])
    return df.filter(F.crc32(F.concat(F.lit(seed), F.col(key).cast("string"))) < limits[F.col(by)])


def bounded_rows(df: DataFrame, wanted: int) -> DataFrame:
    """``df`` itself if it has about ``wanted`` rows, else as many, drawn row by row.

    A draw by id takes all rows of an id or none; if an id repeats over very many
    rows, this second draw keeps the bound.
    """
    total = df.count()
    if total <= 1.5 * wanted:
        return df
    share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(2 ** 32))
    return df.withColumn("_share", share).filter(F.col("_share") < int(wanted / total * 2 ** 32)).drop("_share")


def labelled(spark: SparkSession, documents: DataFrame, labels: DataFrame, label: str, keep: Column,
             wanted: int, seed: str) -> DataFrame:
    """(text, label) of a bounded sample of labelled documents.

    The ids are chosen on the narrow label table; at most about ``wanted`` of
    them exist, which is the bound of the broadcast; of their rows at most about ``wanted`` are drawn.
    """
    ids = (labels.filter(keep & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
           .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    ids = hashed_part(ids, "doc_id", wanted, seed)
    chosen = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return bounded_rows(chosen, wanted)


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a plain name; ``fn`` gets and gives an iterator of record batches."""
    return df.mapInArrow(fn, schema)
