"""Structured Streaming drift monitor.

Stream of (sku, ts, event_id, actual) -> per-observation verdicts, keyed state
of each SKU with ``transformWithStateInPandas``; the SKUs of a group (a hash of ``sku``) are visited together. The state
is typed: of each SKU it holds the running count and sum of actuals (the predictor is the running mean of earlier
values), the last (ts, event_id) seen, the ADWIN window (at most 201 values, so an array costs one read
and one write a batch where a list state would cost one call an element) and the counters of ``SeriesState``. A key's rows
are folded when its batch is complete, in order, however many they are: at most ``HELD`` of them wait in memory, the others as sorted
runs in a file, which are merged. Rows at or before the last folded position are late: they are
emitted with ``late = true`` and do not touch the detectors (T2). Nothing expires and
nothing is dropped unless the caller asks for it. The state store is RocksDB and the query
checkpoint sits in the shared folder, so a lost executor replays from the
last committed batch.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfcast.operators.drift_replay import STATE_SCHEMA, SeriesState, drift_events, replay

OUT_SCHEMA = ("sku string, event_id long, ts timestamp, late boolean, n long, actual double, predicted double, "
              "residual double, drift_detected boolean, detectors array<string>, severity double, message string")
OUT_COLS = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
#: Running count and sum of actuals, the last position and the ADWIN window, then the detectors' counters.
VALUE_SCHEMA = f"seen bigint, sum double, last_ts bigint, last_event bigint, window array<double>, {STATE_SCHEMA}"
#: The state of a group: that of each of its SKUs. The number of groups is part of a query's checkpoint.
GROUP_SCHEMA = "members array<struct<sku: string, " + ", ".join(
    ": ".join(c.split(" ", 1)) for c in VALUE_SCHEMA.split(", ")) + ">>"
GROUPS = 1024
#: Rows of verdicts that a group gathers before it hands them out.
OUT_ROWS = 10_000
#: Rows of a key that wait in memory for the end of their batch, and rows of its runs that are merged at a time.
HELD = 100_000
#: A row that waits in a file.
ROW = np.dtype([("ts", "i8"), ("event_id", "i8"), ("actual", "f8")])
#: Rows of one arrival file, which one task reads whole.
FILE_ROWS = 500_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Runs:
    """Sorted runs of rows in a temporary file of the task."""

    def __init__(self):
        self.file, self.sizes = tempfile.TemporaryFile(), []

    def add(self, rows: tuple) -> None:
        packed = np.empty(len(rows[0]), ROW)
        for name, column in zip(ROW.names, rows):
            packed[name] = column
        self.file.seek(0, 2)
        self.file.write(packed.tobytes())
        self.sizes.append(len(packed))

    def _read(self, start: int, stop: int) -> np.ndarray:
        self.file.seek(start * ROW.itemsize)
        return np.frombuffer(self.file.read((stop - start) * ROW.itemsize), ROW)

    def merged(self) -> Iterator[tuple]:
        """All rows in order, in pieces; of equal positions that of the earlier run comes first."""
        ends = np.cumsum(self.sizes).tolist()
        at, each = [0, *ends[:-1]], max(1, HELD // len(ends))
        heads = [np.empty(0, ROW)] * len(ends)
        while True:
            for i, end in enumerate(ends):
                if not len(heads[i]) and at[i] < end:
                    heads[i] = self._read(at[i], min(at[i] + each, end))
                    at[i] += len(heads[i])
            if not any(map(len, heads)):
                self.file.close()
                return
            # what is yet to be read of a run comes behind the last row of its head
            lasts = [tuple(h[["ts", "event_id"]][-1].tolist()) for h, i, end in zip(heads, at, ends) if i < end]
            if lasts:
                ts, event = min(lasts)
                taken = [int(np.count_nonzero((h["ts"] < ts) | ((h["ts"] == ts) & (h["event_id"] <= event)))) for h in heads]
            else:
                taken = [len(h) for h in heads]
            piece = np.concatenate([h[:k] for h, k in zip(heads, taken)])
            heads = [h[k:] for h, k in zip(heads, taken)]
            yield in_order(tuple(piece[name] for name in ROW.names))


def in_order(rows: tuple) -> tuple:
    order = np.lexsort((rows[1], rows[0]))
    return tuple(c[order] for c in rows)


class Series:
    """One SKU inside a micro-batch: what is stored of it and the rows that wait for the end of the batch."""

    def __init__(self, sku: str | None, stored: tuple | None):
        self.sku, self.waiting, self.held, self.runs = sku, [], 0, None
        if stored is None:
            self.series, self.seen, self.total, self.last = SeriesState(), 0, 0.0, None
        else:
            self.seen, self.total, *self.last, window = stored[:5]
            self.series = SeriesState.from_row(stored[5:], window)

    def add(self, chunk: tuple) -> None:
        """Take (times, event ids, actuals); more than ``HELD`` rows go to a file as a sorted run."""
        self.waiting.append(chunk)
        self.held += len(chunk[0])
        if self.held > HELD:
            self.runs = self.runs or Runs()
            self.runs.add(self._rows())

    def _rows(self) -> tuple:
        rows = in_order(tuple(np.concatenate(c) for c in zip(*self.waiting)))
        self.waiting, self.held = [], 0
        return rows

    def rest(self) -> Iterator[dict]:
        """The verdicts of all rows that wait, in order."""
        if self.runs is not None:
            if self.waiting:
                self.runs.add(self._rows())
            for piece in self.runs.merged():
                yield self._folded(piece)
        elif self.waiting:
            yield self._folded(self._rows())

    def _folded(self, rows: tuple) -> dict:
        out, self.seen, self.total, self.last = folded(self.sku, rows, self.series, self.seen, self.total, self.last)
        return out

    def row(self) -> tuple:
        """The values of VALUE_SCHEMA."""
        return (self.seen, self.total, *self.last, self.series.window.tolist(), *self.series.to_row())


def chunk_of(pdf: pd.DataFrame) -> tuple:
    return (pdf["ts"].to_numpy(dtype="datetime64[ns]").astype("int64"), pdf["event_id"].to_numpy("int64"),
            pdf["actual"].to_numpy("float64"))


class Monitor(StatefulProcessor):
    """The monitor keyed by SKU; ``idle_ms`` of event time without a row removes a SKU's state (None: never)."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getValueState("series", VALUE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        one = Series(key[0], self.values.get())
        for pdf in rows:
            one.add(chunk_of(pdf))
        yield from (joined([x]) for x in one.rest())
        self.values.update(one.row())
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(one.last[0] // 1_000_000 + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.values.clear()
        return iter(())

    def close(self) -> None:
        pass


class Monitors(StatefulProcessor):
    """The same monitor for the SKUs of a group: one call, one frame and one state access a group and batch,
    whose cost is many times that of folding a SKU's few rows. SKUs share nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getValueState("group", GROUP_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = self.values.get()
        known = {m[0]: tuple(m[1:]) for m in stored[0]} if stored is not None else {}
        live, parts, size = {}, [], 0
        for pdf in rows:
            codes, skus = pd.factorize(pdf["sku"], use_na_sentinel=False)
            order = np.argsort(codes, kind="stable")
            chunk = tuple(c[order] for c in chunk_of(pdf))
            ends = np.cumsum(np.bincount(codes, minlength=len(skus))).tolist()
            for sku, start, end in zip(skus, [0, *ends], ends):
                sku = None if pd.isna(sku) else sku
                if sku not in live:
                    live[sku] = Series(sku, known.get(sku))
                live[sku].add(tuple(c[start:end] for c in chunk))
        for one in live.values():
            for part in one.rest():
                parts.append(part)
                size += len(part["late"])
                if size >= OUT_ROWS:
                    yield joined(parts)
                    parts, size = [], 0
        if parts:
            yield joined(parts)
        known |= {sku: one.row() for sku, one in live.items()}
        self.values.update(([(sku, *row) for sku, row in known.items()],))

    def close(self) -> None:
        pass


def joined(parts: list[dict]) -> pd.DataFrame:
    """The parts as one frame; late rows carry no verdict."""
    columns = {c: np.concatenate([x[c] for x in parts]) for c in OUT_COLS}
    columns["n"] = pd.arrays.IntegerArray(columns["n"], columns["late"])
    columns["drift_detected"] = pd.arrays.BooleanArray(columns["drift_detected"], columns["late"])
    return pd.DataFrame(columns, columns=OUT_COLS)


def folded(sku: str, rows: tuple, series: SeriesState, seen: int, total: float, last: list | None) -> tuple:
    """Fold sorted rows (times, event ids, actuals) into the series: (columns of verdicts, count, sum and last position after them)."""
    when, event, actual = rows
    late = np.zeros(len(when), bool)                      # of equal positions only the first counts
    late[1:] = (when[1:] == when[:-1]) & (event[1:] == event[:-1])
    if last is not None:
        late |= (when < last[0]) | ((when == last[0]) & (event <= last[1]))
    at = np.flatnonzero(~late)
    value = actual[at]
    number = seen + np.arange(len(value))
    before = total + np.concatenate([[0.0], np.cumsum(value)[:-1]]) if len(value) else value
    predicted = np.divide(before, number, out=np.zeros(len(value)), where=number > 0)
    got = series.advance(value - predicted)

    def spread(column, kind=object) -> np.ndarray:           # a late row has a place only, which ``joined`` leaves null
        out = np.full(len(when), np.nan if kind is float else None if kind is object else 0, kind)
        if kind is object:
            for i, x in zip(at.tolist(), column):
                out[i] = x
        else:
            out[at] = column
        return out

    columns = {"sku": np.full(len(when), sku, object), "event_id": event, "ts": when.astype("datetime64[ns]"), "late": late,
               "n": spread(number + 1, np.int64), "actual": spread(value, float),
               "predicted": spread(predicted, float), "residual": spread(value - predicted, float)}
    columns |= {c: spread(got[c], kind) for c, kind in
                (("drift_detected", bool), ("detectors", object), ("severity", float), ("message", object))}
    if len(value):
        seen, total = int(number[-1]) + 1, float(before[-1] + value[-1])
        last = [int(when[at[-1]]), int(event[at[-1]])]
    return columns, seen, total, last


def monitor_stream(stream: DataFrame, watermark_delay: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """Keyed stateful monitor over a streaming (sku, ts, event_id, actual) frame.

    By default every row comes out: in order with its verdict, or flagged late.
    With both parameters, Spark drops rows later than ``watermark_delay`` and the
    state of a SKU silent for ``idle_ms`` of event time is removed.
    """
    if watermark_delay is not None:
        stream = stream.withWatermark("ts", watermark_delay)
    if watermark_delay is not None and idle_ms is not None:
        return stream.groupBy("sku").transformWithStateInPandas(Monitor(idle_ms), OUT_SCHEMA, "append", "EventTime")
    group = F.pmod(F.xxhash64("sku"), F.lit(GROUPS)).alias("_group")
    return stream.select("*", group).groupBy("_group").transformWithStateInPandas(Monitors(), OUT_SCHEMA, "append", "None")


def events_as_observations(events: DataFrame) -> DataFrame:
    """The given ``events`` table as monitor input: sku = user, actual = value."""
    return events.select(F.col("user_id").cast("string").alias("sku"), F.col("ts").cast("timestamp").alias("ts"),
                         "event_id",
                         F.col("value").cast("double").alias("actual"))


def write_arrivals(obs: DataFrame, source_dir: str, order: tuple[str, ...] = ("ts", "event_id"), least: int = 5) -> int:
    """Write observations as the stream's arrival files: one range-partitioned write in ``least`` stretches of
    ``order``, each of as many files as keep one near ``FILE_ROWS`` rows. Only file names and times pass the driver.
    Returns the files of a stretch, which is a micro-batch: every batch visits the state of nearly every SKU, so
    their number must not grow with the rows."""
    spark = obs.sparkSession
    each = max(1, math.ceil(obs.count() / (least * FILE_ROWS)))
    (obs.repartitionByRange(least * each, *order).sortWithinPartitions(*order)
     .write.mode("append").parquet(source_dir))
    stamp_in_order(spark, source_dir)
    return each


def write_slices(obs: DataFrame, source_dir: str, column: str) -> int:
    """Write each value of ``column`` as arrival files of near ``FILE_ROWS`` rows, in the column's order (it is left
    out of them). All slices get equally many files, some of them empty if need be. Returns that number:
    so many files are one micro-batch."""
    spark, aside = obs.sparkSession, f"{source_dir}-slices"
    sizes = obs.groupBy(column).count().agg(F.max("count").alias("most"), F.count(F.lit(1)).alias("slices")).first()
    each = max(1, math.ceil((sizes.most or 0) / FILE_ROWS))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in obs.columns if c != column]), F.lit(each)).alias("_part")
    (obs.select("*", part).repartition(max(1, sizes.slices * each), column, "_part")
     .write.partitionBy(column, "_part").parquet(aside))
    obs.drop(column).limit(0).coalesce(1).write.parquet(f"{aside}/_none")
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = root(aside).getFileSystem(conf)
    fs.mkdirs(root(source_dir))
    files = lambda folder: [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet")]
    none = files(root(f"{aside}/_none"))[0]
    for folder in fs.listStatus(root(aside)):
        if folder.isDirectory() and "=" in folder.getPath().getName():
            value, found = int(folder.getPath().getName().split("=")[1]), 0
            for inner in fs.listStatus(folder.getPath()):
                for file in files(inner.getPath()):
                    fs.rename(file, root(f"{source_dir}/slice-{value:09d}-{found:05d}.parquet"))
                    found += 1
            for i in range(found, each):
                copy(fs, none, fs, root(f"{source_dir}/slice-{value:09d}-{i:05d}.parquet"), False, conf)
    stamp_in_order(spark, source_dir)
    return each


def stamp_in_order(spark: SparkSession, source_dir: str) -> None:
    """Give the files of a folder rising times in the order of their names: the file source takes them by time."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(root)
                   if f.getPath().getName().endswith(".parquet"))
    for i, (_, path) in enumerate(names):
        fs.setTimes(path, 1_000_000_000_000 + i * 60_000, -1)


def _child_session(spark: SparkSession, state_partitions: int | None) -> SparkSession:
    """A session of the same context with the monitor's settings; the caller's are left alone.

    The number of state partitions is fixed when a query first starts: one per core unless given.
    """
    ss = spark.newSession()
    ss.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    ss.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ss.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    ss.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return ss


def _verdicts(ss: SparkSession, source_dir: str, schema, max_files: int | None, watermark_delay: str | None,
              idle_ms: int | None) -> DataFrame:
    r = ss.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return monitor_stream(r.parquet(source_dir), watermark_delay, idle_ms)


def run_to_table(spark: SparkSession, source_dir: str, schema, out_dir: str, ckpt_dir: str,
                 max_files: int | None = None, state_partitions: int | None = None,
                 watermark_delay: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """Run the monitor over the files in ``source_dir`` until they are consumed
    (``availableNow``), writing Parquet to ``out_dir``; return the written table."""
    ss = _child_session(spark, state_partitions)
    q = (_verdicts(ss, source_dir, schema, max_files, watermark_delay, idle_ms).writeStream.format("parquet")
         .option("path", out_dir).option("checkpointLocation", ckpt_dir)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_dir)


def run_to_outputs(spark: SparkSession, source_dir: str, schema, out_dir: str, ckpt_dir: str,
                   max_files: int | None = None, state_partitions: int | None = None) -> dict[str, DataFrame]:
    """Verdicts, dated drift events and late-row counts of one stream, written batch by batch.

    Each micro-batch overwrites its own ``batch_id`` folder of the three tables,
    so a batch that is retried after a failure replaces what it wrote before. Returns the tables by name.
    """
    ss = _child_session(spark, state_partitions)

    def write(batch: DataFrame, batch_id: int) -> None:
        verdicts = f"{out_dir}/verdicts/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(verdicts)
        done = batch.sparkSession.read.schema(batch.schema).parquet(verdicts)
        drift_events(done.where("NOT late"), "event_id", "ts").write.mode("overwrite").parquet(
            f"{out_dir}/events/batch_id={batch_id}")
        done.groupBy("sku").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("n_late")).write.mode(
            "overwrite").parquet(f"{out_dir}/late/batch_id={batch_id}")

    q = (_verdicts(ss, source_dir, schema, max_files, None, None).writeStream.foreachBatch(write)
         .option("checkpointLocation", ckpt_dir).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return {name: spark.read.parquet(f"{out_dir}/{name}") for name in ("verdicts", "events", "late")}


def batch_monitor(obs: DataFrame) -> DataFrame:
    """The same verdicts computed in batch: order by (ts, event_id), running mean
    of earlier actuals as the predictor, then the grouped replay."""
    w = Window.partitionBy("sku").orderBy("ts", "event_id")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    res = (obs.withColumn("n", F.row_number().over(w).cast("bigint"))
           .withColumn("predicted", F.coalesce(F.avg("actual").over(prior), F.lit(0.0)))
           .withColumn("residual", F.col("actual") - F.col("predicted")))
    return replay(res, keep=("event_id", "ts", "actual", "predicted")).select(
        "sku", "event_id", "ts", F.lit(False).alias("late"), "n", "actual", "predicted", "residual",
        "drift_detected", "detectors", "severity", "message")
