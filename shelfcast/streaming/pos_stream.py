"""Incremental arrivals into the POS history, the existing row winning.

The history lies in ``SLICES`` hash slices of ``sku``. A slice is a list of
folders: a base and at most ``DELTAS`` deltas. Each micro-batch (``foreachBatch``)
reads the keys of the slices and dates that it touches, drops the rows whose (sku, date) is
already there (within the batch the first by ``src_order`` stays), and
writes one delta folder; a slice with too many deltas is merged into a new
base. So the files read per batch do not grow with the history or its age.

The ledger names the folders of every slice after each batch: one small JSON file a
batch, written aside and published by a rename. Folders count only once a
ledger names them; a batch whose ledger exists is done, and a batch that
failed midway overwrites its own folders when it is retried. So retries are exact.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.materialize import _fs

KEY = ["sku", "date"]
SLICES = 64
DELTAS = 4
INITIAL = -1
#: Rows of the first history that one slice may hold, and the least number of slices ``slices_for`` gives.
SLICE_ROWS, LEAST_SLICES = 1_000_000, 16


def slices_for(history: DataFrame) -> int:
    """Slices that keep the share of each near ``SLICE_ROWS`` rows."""
    return max(LEAST_SLICES, -(-history.count() // SLICE_ROWS))


def _slice(slices: int):
    return F.pmod(F.xxhash64("sku"), F.lit(slices)).cast("int")


def _ledgers(spark: SparkSession, path: str) -> list[int]:
    p, fs = _fs(spark, f"{path}/_ledger")
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _read_ledger(spark: SparkSession, path: str, batch_id: int) -> dict:
    p, fs = _fs(spark, f"{path}/_ledger/{batch_id}.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _publish_ledger(spark: SparkSession, path: str, batch_id: int, state: dict) -> None:
    tmp, fs = _fs(spark, f"{path}/_ledger/{batch_id}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    final, _ = _fs(spark, f"{path}/_ledger/{batch_id}.json")
    fs.rename(tmp, final)


def _write_slices(df: DataFrame, path: str, folder: str) -> dict[str, str]:
    """Write rows with a ``slice`` column below one folder, a file a slice; the folders by slice."""
    spark = df.sparkSession
    df.repartition(F.col("slice")).write.mode("overwrite").partitionBy("slice").parquet(f"{path}/{folder}")
    p, fs = _fs(spark, f"{path}/{folder}")
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return {n.split("=")[1]: f"{folder}/{n}" for n in names}


def start_history(history: DataFrame, path: str, slices: int = SLICES) -> None:
    """Lay out ``history`` in slices."""
    written = _write_slices(history.withColumn("slice", _slice(slices)), path, "base-initial")
    _publish_ledger(history.sparkSession, path, INITIAL, {
        "slices": slices, "schema": history.schema.jsonValue(), "read": 0, "folders": {k: [f] for k, f in written.items()}})


def read_history(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """The history, or the slices ``only``, as of the last finished batch."""
    from pyspark.sql.types import StructType
    state = _read_ledger(spark, path, _ledgers(spark, path)[-1])
    schema = StructType.fromJson(state["schema"])
    folders = [f"{path}/{f}" for k, fs in state["folders"].items() if only is None or k in only for f in fs]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge_batch(batch: DataFrame, batch_id: int, path: str, deltas: int = DELTAS) -> None:
    """Merge one micro-batch into the history; nothing happens if its ledger exists."""
    spark = batch.sparkSession
    done = _ledgers(spark, path)
    if batch_id in done:
        return
    state = _read_ledger(spark, path, done[-1])
    folders, slices = state["folders"], state["slices"]
    columns = [f["name"] for f in state["schema"]["fields"]]
    sliced = batch.withColumn("slice", _slice(slices))
    spans = sliced.groupBy("slice").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()     # at most ``slices``
    touched = [str(r["slice"]) for r in spans]
    lo, hi = (f((r[c] for r in spans if r[c] is not None), default=None) for f, c in ((min, "lo"), (max, "hi")))
    w = Window.partitionBy(*KEY).orderBy("src_order")
    first = sliced.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*columns, "slice")
    known = read_history(spark, path, touched).select(*KEY).where(F.col("date").between(lo, hi))   # no other key can repeat
    fresh = first.join(known, KEY, "left_anti").select(*columns, "slice")
    state["read"] = sum(len(folders.get(k, [])) for k in touched)
    for k, folder in _write_slices(fresh, path, f"delta-{batch_id}").items():
        folders.setdefault(k, []).append(folder)
    full = [k for k in touched if len(folders.get(k, [])) > deltas + 1]
    if full:
        whole = spark.read.schema(batch.select(*columns).schema).parquet(*[f"{path}/{f}" for k in full for f in folders[k]])
        for k, folder in _write_slices(whole.withColumn("slice", _slice(slices)), path, f"base-{batch_id}").items():
            folders[k] = [folder]
    _publish_ledger(spark, path, batch_id, state)


def folders_read(spark: SparkSession, path: str) -> dict[int, int]:
    """Folders that each finished batch read."""
    return {b: _read_ledger(spark, path, b)["read"] for b in _ledgers(spark, path) if b != INITIAL}


def stream_into_history(spark: SparkSession, history: DataFrame, source_dir: str, schema, history_path: str,
                        ckpt_dir: str, max_files: int | None = None, slices: int = SLICES) -> DataFrame:
    """Lay out ``history``, then consume the arrival files in ``source_dir``
    with ``availableNow`` and merge each batch; return the table."""
    if not _ledgers(spark, history_path):
        start_history(history, history_path, slices)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    q = (reader.parquet(source_dir).writeStream
         .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, history_path))
         .option("checkpointLocation", ckpt_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_history(spark, history_path)
