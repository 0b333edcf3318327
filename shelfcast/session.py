"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfcast", extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for the engine.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from the
    submit configuration; locally we fill in what is unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # commit a changelog per micro-batch instead of a full RocksDB checkpoint
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    return spark


_FALLBACK_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir`` (a static setting, read
    here, never changed). When it is unset, a checkpoint folder already given
    to the SparkContext is used; only when neither exists on a local master
    (tests) is a private scratch folder created, any other master is an error. Lineage cuts use ``DataFrame.checkpoint()``
    or tables written below this folder, never executor-local storage.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        key = sc.applicationId
        d = _FALLBACK_DIRS.get(key)
        if d is None:
            current = sc.getCheckpointDir()
            if current:
                d = os.path.dirname(current.rstrip("/"))
            elif sc.master.split("[")[0] == "local":
                d = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
            else:
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            _FALLBACK_DIRS[key] = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make the ``shelfcast`` package importable in every Python worker.

    Grouped maps and pandas UDFs pickle references to functions of this package;
    executors need the package itself. It is zipped once per SparkContext,
    written to the shared checkpoint folder and registered with ``addPyFile``
    (Spark's file distribution, so it also reaches executors started later).
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    data = buf.getvalue()
    digest = hashlib.md5(data).hexdigest()[:12]
    path = scratch_path(spark, f"code/shelfcast-{digest}.zip")     # the shared folder, not a local temp dir
    jvm = sc._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        out = fs.create(p, True)
        out.write(bytearray(data))
        out.close()
    sc.addPyFile(path)
    _SHIPPED.add(key)
