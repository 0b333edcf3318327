"""Result normalisation shared by every registered query.

Integral columns are widened to BIGINT and floating columns rounded to a fixed
number of digits (plus 0.0 to fold -0.0), so that results compare exactly with
the DuckDB oracle regardless of summation order. A nudge of 1e-9 before
rounding makes exact ties (k / 2^m values) round the same way in both engines,
whose rounding rules differ at ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType


NUDGE = 1e-9


def finalize(df: DataFrame, digits: int = 4) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType)):
            cols.append(c.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(c.cast("double") + F.lit(NUDGE), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
