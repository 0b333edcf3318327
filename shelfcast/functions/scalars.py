"""Combine one-row aggregate frames without a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_scalars(*frames: DataFrame) -> DataFrame:
    """Stack one-row frames with disjoint columns and fold them into one row.

    Each column is non-NULL in exactly one input, so ``first(ignorenulls)``
    recovers it; the result is a single aggregate over a handful of rows.
    """
    cols = [c for f in frames for c in f.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
