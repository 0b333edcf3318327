"""Exploratory aggregations behind the reports (A1-A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.dates import day_of_week
from shelfcast.operators.orders import tail_rows


def dow_mean(pos: DataFrame) -> DataFrame:
    """A1: mean units by day of week (0 = Monday)."""
    return pos.groupBy(day_of_week(F.col("date")).alias("day_of_week")).agg(
        F.avg("units_sold").alias("mean_units"))


def daily_total(pos: DataFrame) -> DataFrame:
    """A2: total units per date."""
    return pos.groupBy("date").agg(F.sum("units_sold").alias("total_units"))


def top_skus(pos: DataFrame, n: int = 50) -> DataFrame:
    """A3: the ``n`` SKUs with the most units (distributed top-k)."""
    return (pos.groupBy("sku").agg(F.sum("units_sold").alias("total_units"))
            .orderBy(F.col("total_units").desc(), "sku").limit(n))


def price_histogram(pos: DataFrame, bins: int = 30, col: str = "price") -> DataFrame:
    """A4: equal-width bins between min and max, empty ones too; the max falls into the last bin.

    min and max are scalar subqueries (one global aggregate, computed once and
    used as constants); the counting is a partial aggregation on at most
    ``bins`` keys.
    """
    vals = pos.select(col).where(F.col(col).isNotNull())
    lo = vals.select(F.min(col)).scalar()
    hi = vals.select(F.max(col)).scalar()
    width = hi - lo
    b = F.when(width > 0, F.least(F.floor((F.col(col) - lo) / width * bins) + 1, F.lit(bins))).otherwise(F.lit(1))
    counts = vals.groupBy(b.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = vals.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"),
                                                    (lo + (F.col("bin") - 1) * width / bins).alias("bin_start"))


def category_counts(pos: DataFrame) -> DataFrame:
    """A5: rows per category."""
    return pos.groupBy("cat_id").agg(F.count(F.lit(1)).alias("n_rows"))


def series_tail(pos: DataFrame, n: int = 90) -> DataFrame:
    """The last ``n`` rows of every SKU."""
    return tail_rows(pos.select("sku", "date", "units_sold"), n)


def sample_rows(pos: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows in (sku, date) order."""
    return pos.orderBy("sku", "date").limit(n)


def overview(pos: DataFrame) -> DataFrame:
    """Record count, distinct SKUs, date range."""
    return pos.agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("sku").alias("n_skus"),
                   F.min("date").alias("min_date"), F.max("date").alias("max_date"))

