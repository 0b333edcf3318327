"""Sources and sinks: cached scans, rules files, stock files, model and history tables.

Write-once derived tables (S9/S10) are in ``sources/materialize.py``.

All paths are expected below a shared folder (the session's checkpoint folder in
tests). Writes are atomic per Spark job (``mode('overwrite')``), so a lost
executor only re-runs tasks; readers never see half-written tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.orders import RULE_DEFAULTS, RULE_FIELDS, default_stock
from shelfcast.sources.materialize import _fs
from shelfcast.session import scratch_path

RULES_SCHEMA = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("max_shelf_capacity", T.LongType()),
    T.StructField("unit_cost", T.DoubleType()),
    T.StructField("max_budget_per_order", T.LongType()),
    T.StructField("perishability_days", T.LongType()),
    T.StructField("safety_stock_days", T.LongType()),
])
STOCK_SCHEMA = "sku STRING, current_stock BIGINT"


def unique_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _exists(spark: SparkSession, path: str) -> bool:
    """Path check through the Hadoop FileSystem of the path (works for shared stores)."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def cached_scan(spark: SparkSession, csv_path: str, parquet_path: str, schema=None,
                date_cols: tuple[str, ...] = ()) -> DataFrame:
    """Parquet when present, else CSV with a header; coerce named columns to DATE."""
    if _exists(spark, parquet_path):
        df = spark.read.parquet(parquet_path)
    else:
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        df = r.csv(csv_path)
    for c in date_cols:
        df = df.withColumn(c, F.to_date(F.col(c)))
    return df


#: Position of a row in the raw files: file, block of the file, row in the order of reading.
POSITION = ("_file", "_block", "_row")


def with_file_position(scan: DataFrame) -> DataFrame:
    """A raw scan with ``POSITION``, whose order is the order of the rows in the files.

    A block is read by one task from its start to its end, so inside it
    the generated ids rise with the rows; file and block come from Spark's hidden file metadata.
    """
    return scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_row"))


def load_stock(spark: SparkSession, path: str | None, skus: DataFrame | None = None) -> DataFrame:
    """Stock CSV when it exists, else the default level for every SKU given."""
    if path and _exists(spark, path):
        return spark.read.option("header", True).schema(STOCK_SCHEMA).csv(path)
    if skus is None:
        return spark.createDataFrame([], STOCK_SCHEMA)
    return default_stock(skus)


def save_rules(rules: DataFrame, path: str) -> None:
    """Rules as JSON lines (NULL fields are omitted, as a sparse config would be)."""
    rules.write.mode("overwrite").json(path)


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules with an explicit schema; every missing field takes its default."""
    df = spark.read.schema(RULES_SCHEMA).json(path)
    return df.select("sku", *[F.coalesce(F.col(f), F.lit(RULE_DEFAULTS[f])).cast(RULES_SCHEMA[f].dataType)
                              .alias(f) for f in RULE_FIELDS])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """S8/S12/S14/S15 sink: Parquet (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: Bytes read that one file of a sorted table may stand for, and tries of a commit against other writers.
SORTED_FILE_BYTES = 256 * 2 ** 20
COMMIT_TRIES = 20


def write_sorted(df: DataFrame, path: str, order: tuple[str, ...], files: int | None = None) -> None:
    """J7 sink: files and row groups sorted by ``order`` over the whole table, so their statistics prune a filter on it."""
    from shelfcast.operators.forecast import read_bytes
    n = files or max(df.sparkSession.sparkContext.defaultParallelism, -(-read_bytes(df) // SORTED_FILE_BYTES))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def file_ranges(spark: SparkSession, path: str, order: tuple[str, ...]) -> DataFrame:
    """(file, first, last, n_rows, overlaps) of a table's files: whether a file begins at or before the end of the one before it."""
    from pyspark.sql import Window
    at = F.struct(*order)
    files = (spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), at.alias("at"))
             .groupBy("file").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n_rows")))
    ordered = Window.orderBy("first")                     # one row a file
    return files.withColumn("overlaps", F.coalesce(F.col("first") <= F.lag("last").over(ordered), F.lit(False)))


def _commits(spark: SparkSession, path: str) -> list[str]:
    """The data folders of a table's commits, in order."""
    p, fs = _fs(spark, f"{path}/_commits")
    if not fs.exists(p):
        return []
    numbers = sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())
    folders = []
    for n in numbers:
        stream = fs.open(_fs(spark, f"{path}/_commits/{n}")[0])
        folders.append(bytes(stream.readAllBytes()).decode())
        stream.close()
    return folders


def _claim(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Publish commit ``number`` by a rename that fails if another writer was first."""
    jvm = spark.sparkContext._jvm
    tmp, fs = _fs(spark, f"{path}/_commits/tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    out.write(bytearray(folder.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    plain = spark.sparkContext._gateway.new_array(rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(_fs(spark, f"{path}/_commits/{number}")[0]), plain)
    except Exception as exc:
        if "FileAlreadyExists" in str(exc):
            return False
        raise
    return True


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """All committed snapshots of a history table (None: no commit yet)."""
    folders = _commits(spark, path)
    return spark.read.parquet(*[f"{path}/{f}" for f in folders]) if folders else None


def append_history(spark: SparkSession, path: str, runs: DataFrame) -> DataFrame:
    """Append metric snapshots; version = previous count per SKU + rank in the batch.

    A writer reads the commits so far, writes its rows to a folder of its own and
    claims the next commit number by a rename; if another writer took that number, it numbers its
    rows anew on top of that commit. So no version is given twice and rows of a failed writer never count.
    """
    from pyspark.sql import Window
    for _ in range(COMMIT_TRIES):
        done = len(_commits(spark, path))
        known = read_history(spark, path)
        prev = (known.groupBy("sku").agg(F.count(F.lit(1)).alias("_prev")) if known is not None
                else runs.select("sku").where(F.lit(False)).withColumn("_prev", F.lit(0).cast("bigint")))
        w = Window.partitionBy("sku").orderBy("run_order")
        new = (runs.join(prev, "sku", "left")
               .withColumn("version", (F.coalesce("_prev", F.lit(0)) + F.row_number().over(w)).cast("bigint"))
               .drop("_prev"))
        folder = f"rows-{uuid.uuid4().hex[:12]}"
        new.write.parquet(f"{path}/{folder}")
        if _claim(spark, path, done + 1, folder):
            return read_history(spark, path)
    raise RuntimeError(f"no commit in {COMMIT_TRIES} tries: {path}")
