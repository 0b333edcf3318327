"""Row functions in Java, for loops over small series that neither SQL nor NumPy runs near their cost.

The source lies beside this module. Spark's own compiler (Janino, which compiles its generated code) makes the classes on
the driver; a jar in the shared folder takes them to the executors, as ``session.ship_code`` does with the package.
"""

from __future__ import annotations

import hashlib
import io
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession

from shelfcast.session import scratch_path

_CLASSES: dict[tuple[str, str], object] = {}


def java_class(spark: SparkSession, name: str):
    """The class ``shelfcast.<name>`` of ``<name>.java``, which the executors know, too."""
    sc = spark.sparkContext
    key = (sc.applicationId, name)
    if key not in _CLASSES:
        with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.java"), encoding="utf-8") as f:
            source = f.read()
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(source)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for made, code in dict(compiler.getBytecodes()).items():
                z.writestr(f"{made.replace('.', '/')}.class", bytes(code))
        path = scratch_path(spark, f"code/{name}-{hashlib.md5(source.encode()).hexdigest()[:12]}.jar")
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(p):
            out = fs.create(p, True)
            out.write(bytearray(buf.getvalue()))
            out.close()
        sc._jsc.addJar(path)
        _CLASSES[key] = compiler.getClassLoader().loadClass(f"shelfcast.{name}")
    return _CLASSES[key]


def map_partitions(df: DataFrame, name: str, settings: tuple, schema: str) -> DataFrame:
    """``df`` through the ``MapPartitionsFunction`` of ``<name>.java`` after its ``set(*settings)``."""
    spark = df.sparkSession
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    made = java_class(spark, name).getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0)).newInstance(
        gateway.new_array(jvm.java.lang.Object, 0))
    made.set(*settings)
    kind = jvm.org.apache.spark.sql.Encoders.row(jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))
    return DataFrame(df._jdf.mapPartitions(made, kind).toDF(), spark)
