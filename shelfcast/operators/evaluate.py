"""Chronological splits and metric tables for per-SKU forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.metrics import metric_aggs, quality_band

MIN_TRAIN_ROWS = 50      # M1: SKUs with fewer rows are skipped
TEST_SHARE = 0.2         # M4: hold-out share (double, rounded up as the splitter does)
CV_FOLDS = 3             # M5


def with_positions(df: DataFrame, key: str = "sku", order: str = "date") -> DataFrame:
    """Add ``rn`` (1-based position) and ``n`` (series length) per key."""
    w = Window.partitionBy(key).orderBy(order)
    return (df.withColumn("rn", F.row_number().over(w))
            .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(key))))


def holdout_split(df: DataFrame, test_share: float = TEST_SHARE) -> DataFrame:
    """M4: the last ceil(share x n) rows validate; adds ``split`` ('train'/'val')."""
    p = with_positions(df)
    n_val = F.ceil(F.lit(test_share) * F.col("n"))
    return p.withColumn("split", F.when(F.col("rn") > F.col("n") - n_val, "val").otherwise("train"))


def holdout_summary(df: DataFrame) -> DataFrame:
    s = holdout_split(df)
    return s.groupBy("sku").agg(F.count(F.lit(1)).alias("n_rows"),
                                F.count_if(F.col("split") == "train").alias("train_rows"),
                                F.count_if(F.col("split") == "val").alias("val_rows"),
                                F.min(F.when(F.col("split") == "val", F.col("date"))).alias("first_val_date"))


def cv_fold_assign(df: DataFrame, folds: int = CV_FOLDS, min_rows: int = MIN_TRAIN_ROWS) -> DataFrame:
    """M5: expanding-window folds. Block = n div (folds + 1); fold k validates on
    block k + 1 and trains on every earlier row. Rows get ``fold`` (NULL = never
    validated); only series with more than ``min_rows`` rows take part."""
    p = with_positions(df).where(F.col("n") > min_rows)
    ts = (F.col("n") / (folds + 1)).cast("bigint")
    start = F.col("n") - folds * ts
    idx = F.col("rn") - 1
    fold = F.when(idx >= start, ((idx - start) / ts).cast("bigint") + 1)
    return p.withColumn("fold", fold).withColumn("block", ts)


def cv_folds(df: DataFrame, folds: int = CV_FOLDS) -> DataFrame:
    a = cv_fold_assign(df, folds).where(F.col("fold").isNotNull())
    return (a.groupBy("sku", "fold").agg(F.min("n").alias("_n"), F.min("block").alias("val_rows"),
                                         F.min("date").alias("val_start_date"), F.max("date").alias("val_end_date"))
            .select("sku", "fold", (F.col("_n") - (folds + 1 - F.col("fold")) * F.col("val_rows")).alias("train_rows"),
                    "val_rows", "val_start_date", "val_end_date"))


def holdout_metrics(scored: DataFrame, min_rows: int = MIN_TRAIN_ROWS) -> DataFrame:
    """M7 on the hold-out of every SKU with at least ``min_rows`` rows.

    ``scored`` has (sku, date, actual, predicted).
    """
    s = holdout_split(scored).where(F.col("n") >= min_rows)
    val = s.where(F.col("split") == "val")
    m = val.groupBy("sku").agg(*metric_aggs(), F.count(F.lit(1)).alias("val_samples"),
                               F.min("n").alias("_n"))
    return m.withColumn("train_samples", F.col("_n") - F.col("val_samples")).drop("_n")


def quality_bands(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(quality_band(F.col("r2")).alias("band")).agg(F.count(F.lit(1)).alias("n_models"))


def worst_models(metrics: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` models with the largest MAE (a top-k report)."""
    from shelfcast.operators.orders import with_remainder
    top = metrics.orderBy(F.col("mae").desc(), "sku").limit(n)
    return with_remainder(top.select(F.row_number().over(Window.orderBy(F.col("mae").desc(), "sku"))
                                     .alias("listing_rank"), "sku", "mae", "rmse", "r2"), metrics, n)


def training_summary(metrics: DataFrame, skus: DataFrame) -> DataFrame:
    """Mean MAE/RMSE/R^2, trained vs total SKUs, share of good models (R^2 > 0.7)."""
    a = metrics.agg(F.avg("mae").alias("avg_mae"), F.avg("rmse").alias("avg_rmse"), F.avg("r2").alias("avg_r2"),
                    F.count(F.lit(1)).alias("trained"), F.count_if(F.col("r2") > 0.7).alias("good_models"))
    from shelfcast.functions.scalars import combine_scalars
    b = skus.agg(F.count_distinct("sku").alias("total"))
    c = combine_scalars(a, b)
    return c.withColumn("good_share", F.when(F.col("trained") > 0, F.col("good_models") / F.col("trained"))
                        .otherwise(0.0))
