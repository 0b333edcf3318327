"""Materialised derived tables in the shared folder.

A derived table is computed once per input (keyed by the input files' paths,
sizes and modification times), written as Parquet below the session's
checkpoint folder, and read back afterwards. The write is one Spark job, so an
executor loss only re-runs tasks, and readers never see a partial table; the
read also cuts the lineage of every query built on top.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession

from shelfcast.session import scratch_path


NAMESPACE_CONF = "spark.shelfcast.derived.namespace"   # set a fresh value to force a rebuild


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _code_version() -> bytes:
    """Source of the derivations, so a changed adapter never reuses an old table."""
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.md5()
    for name in ("sources/fixture.py", "sources/materialize.py", "sources/tables.py", "functions/dates.py",
                 "functions/hashing.py", "operators/features.py", "operators/forecast.py", "operators/gbt.py",
                 "operators/clean.py", "operators/reshape.py", "plans/q_prep.py"):
        with open(os.path.join(pkg, name), "rb") as f:
            h.update(f.read())
    return h.digest()


def input_key(spark: SparkSession, paths: list[str]) -> str:
    h = hashlib.md5(_code_version())
    for path in paths:
        p, fs = _fs(spark, path)
        found, files = fs.listFiles(p, True), []        # a table may be one file or a folder of files
        while found.hasNext():
            st = found.next()
            files.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}")
        h.update("\n".join([path, *sorted(files)]).encode())
    return h.hexdigest()[:16]


def _publish(spark: SparkSession, tmp: str, path: str) -> None:
    """Give a completely written folder its name, unless another builder was first."""
    (tp, fs), (p, _) = _fs(spark, tmp), _fs(spark, path)
    if not fs.exists(p):
        fs.rename(tp, p)


def _derived(spark: SparkSession, name: str, inputs: list[str]) -> str:
    ns = spark.conf.get(NAMESPACE_CONF, "default")
    return scratch_path(spark, os.path.join("derived", ns, input_key(spark, inputs), name))


def _aside(path: str) -> str:
    """Where a table is written before one rename gives it its name: concurrent builders cannot
    interleave files, and readers only ever see a complete table."""
    return f"{path}.tmp-{uuid.uuid4().hex[:8]}"


def materialized(spark: SparkSession, name: str, inputs: list[str], build, partition_by=()) -> DataFrame:
    """Read ``name`` for these inputs if it was written before, else build and write it."""
    path = _derived(spark, name, inputs)
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        tmp = _aside(path)
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(tmp)
        _publish(spark, tmp, path)
    return spark.read.parquet(path)


def observed(spark: SparkSession, name: str, inputs: list[str],
             build: Callable[[Observation], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``materialized``, and (rule, affected): the counts that ``build`` observes in the pass that writes the table.

    The counts are published first, so a table that is there has them.
    """
    path, audit = _derived(spark, name, inputs), _derived(spark, f"{name}_audit", inputs)
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        counts, tmp, noted = Observation(name), _aside(path), _aside(audit)
        build(counts).write.parquet(tmp)
        rows = [(rule, int(n or 0)) for rule, n in counts.get.items()]
        spark.createDataFrame(rows, "rule string, affected bigint").coalesce(1).write.parquet(noted)
        _publish(spark, noted, audit)
        _publish(spark, tmp, path)
    return spark.read.parquet(path), spark.read.parquet(audit)


#: Input bytes that one bucket may stand for: a few hundred series, whose fit is a task of seconds.
BUCKET_BYTES = 4 * 2 ** 20


def bucket_count(spark: SparkSession, inputs: list[str], per_core: int = 2) -> int:
    """Buckets of a table derived from these inputs: two a core, and enough that none grows with the data."""
    size = 0
    for path in inputs:
        p, fs = _fs(spark, path)
        size += fs.getContentSummary(p).getLength()
    return max(spark.sparkContext.defaultParallelism * per_core, -(-size // BUCKET_BYTES))


#: Bytes read whose wide rows one task may hold; they unfold to several times as much.
WIDE_BYTES = 4 * 2 ** 20


def wide_partitions(df: DataFrame, per_core: int = 2) -> int:
    """Partitions for work on wide rows: given by number, so they are not coalesced by their small compressed size."""
    from shelfcast.operators.forecast import read_bytes
    return max(df.sparkSession.sparkContext.defaultParallelism * per_core, -(-read_bytes(df) // WIDE_BYTES))


def bucketed(spark: SparkSession, name: str, inputs: list[str], build: Callable[[int], DataFrame], key: str,
             order: tuple[str, ...]) -> DataFrame:
    """``materialized``, as a table bucketed by ``key`` and sorted by ``order``.

    ``build`` gets the number of buckets and returns a frame that is hash
    partitioned on ``key`` into as many, so every bucket is one file and the write shuffles nothing. Windows,
    groupings and cogroups on ``key`` over this table need no exchange. The bucket
    layout lives in the session's catalog; a session that finds the files declares the table again.
    """
    buckets = bucket_count(spark, inputs)
    ns = spark.conf.get(NAMESPACE_CONF, "default")
    digest = input_key(spark, inputs)
    path = scratch_path(spark, os.path.join("derived", ns, digest, f"{name}-{buckets}"))
    table = f"{name}_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        aside = f"{table}_{uuid.uuid4().hex[:8]}"
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        (build(buckets).write.format("parquet").bucketBy(buckets, key).sortBy(*order)
         .option("path", tmp).saveAsTable(aside))
        _publish(spark, tmp, path)
        spark.sql(f"DROP TABLE {aside}")
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet CLUSTERED BY ({key}) "
                  f"SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
