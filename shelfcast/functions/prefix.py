"""Distributed running sums over a global order.

A window without ``partitionBy`` would move every row into one task. Here the
rows are range-partitioned on the order key, each partition computes its local
running sum in one Arrow-batched pass, and the per-partition totals (one row per
partition, a size bound set by the partition count) are turned into offsets and
broadcast back. Cost: one range shuffle plus one small aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def global_running_sum(df: DataFrame, order: list[Column], value: str, out: str,
                       partitions: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value`` (LONG) in ``order``.

    ``order`` must be a total order (add a unique tie-break column).
    The result is checkpointed: the partition ids that tie local sums to offsets
    must not be recomputed by a second, differently sampled range shuffle.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField("_local", T.LongType())])

    def local_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = 0
        for pdf in batches:
            cs = pdf[value].astype("int64").cumsum() + carry
            if len(cs):
                carry = int(cs.iloc[-1])
            yield pdf.assign(_local=cs)

    local = ranged.mapInPandas(local_sums, schema).checkpoint(eager=True)
    totals = local.groupBy("_pid").agg(F.sum(value).cast("bigint").alias("_tot"))
    offsets = totals.select("_pid", F.coalesce(
        F.sum("_tot").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).cast("bigint").alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_local") + F.col("_off")).cast("bigint"))
            .drop("_pid", "_local", "_off"))
