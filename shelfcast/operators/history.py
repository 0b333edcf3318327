"""Model metric history and improvement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.metrics import metric_aggs
from shelfcast.operators.evaluate import MIN_TRAIN_ROWS, with_positions

# Improvement report messages.
INSUFFICIENT_NOTE = "Insufficient history"
IMPROVED_NOTE = "MAE improved by %.1f%%"
NEEDS_DATA_NOTE = "Model needs more data"


def expanding_runs(scored: DataFrame, runs: int = 3, min_rows: int = MIN_TRAIN_ROWS) -> DataFrame:
    """One metric snapshot (mae, rmse, r2, mape, samples, day of the last row) per successive run; run v sees the first v/runs of
    each series (as when a model is retrained while data accumulates). Versions
    are 1..runs in run order."""
    p = with_positions(scored).where(F.col("n") >= min_rows)
    each = p.withColumn("version", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(runs).cast("bigint"))))
    seen = each.where(F.col("rn") <= F.floor(F.col("n") * F.col("version") / float(runs)).cast("bigint"))
    return seen.groupBy("sku", "version").agg(*metric_aggs(), F.count(F.lit(1)).alias("training_samples"),
                                              F.max("date").alias("trained_at"))


def sku_history(history: DataFrame, sku: str) -> DataFrame:
    """M19."""
    return history.where(F.col("sku") == sku).orderBy("version")


def improvement_report(history: DataFrame) -> DataFrame:
    """First vs latest MAE per SKU, rounded percentage, message."""
    g = history.groupBy("sku").agg(F.count(F.lit(1)).alias("versions_trained"),
                                   F.min_by("mae", "version").alias("initial_mae"),
                                   F.max_by("mae", "version").alias("current_mae"))
    pct = F.when(F.col("initial_mae") != 0, (F.col("initial_mae") - F.col("current_mae")) / F.col("initial_mae")
                 * 100).otherwise(F.lit(0.0))
    enough = F.col("versions_trained") >= 2
    msg = (F.when(~enough, F.lit(INSUFFICIENT_NOTE))
           .when(pct > 0, F.format_string(IMPROVED_NOTE, pct))
           .otherwise(F.lit(NEEDS_DATA_NOTE)))
    return g.select("sku", "versions_trained", "initial_mae", "current_mae",
                    F.round(pct, 2).alias("mae_improvement_pct"), (enough & (pct > 0)).alias("improved"),
                    msg.alias("message"))
