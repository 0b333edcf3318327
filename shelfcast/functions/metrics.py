"""Regression metrics as aggregate expressions (M7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def metric_aggs(y: str = "actual", yhat: str = "predicted") -> list[Column]:
    """MAE, RMSE, R^2 (1 if SSE = SST = 0, 0 if only SST = 0), MAPE = mean(|e| / max(y, 1)) x 100."""
    e = F.col(y) - F.col(yhat)
    sse = F.sum(e * e)
    sst = F.var_pop(y) * F.count(F.lit(1))
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - sse / sst))
    return [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), r2.alias("r2"),
            (F.avg(F.abs(e) / F.greatest(F.col(y).cast("double"), F.lit(1.0))) * 100).alias("mape")]


def quality_band(r2: Column) -> Column:
    """> 0.7 good, > 0.3 fair, else poor."""
    return F.when(r2 > 0.7, "good").when(r2 > 0.3, "fair").otherwise("poor")
