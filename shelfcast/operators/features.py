"""Calendar, lag and rolling features per SKU series.

All per-series work runs on one window specification ``partitionBy(sku)
.orderBy(date)``. A series has at most one row per calendar day, so a window
partition is bounded by the calendar length however large the table grows;
Spark plans one hash exchange on ``sku`` and one sort, shared by every window
column below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shelfcast.functions.dates import day_of_week, iso_week

# The model's ordered feature list.
FEATURE_COLUMNS = [
    "day_of_week", "day_of_month", "month", "week_of_year",
    "is_weekend", "is_holiday", "promo_flag",
    "lag_1", "lag_7", "lag_14",
    "rolling_mean_7", "rolling_std_7",
    "rolling_mean_14", "rolling_std_14",
]
DEFAULT_LAGS = (1, 7, 14)
DEFAULT_WINDOWS = (7, 14)


def series_window(key: str = "sku", order: str = "date"):
    return Window.partitionBy(key).orderBy(order)


def add_calendar_features(df: DataFrame, holidays: DataFrame | None = None,
                          date_col: str = "date") -> DataFrame:
    """F1-F6. ``holidays`` is a (holiday_date) dimension; None gives a constant 0.

    The holiday dimension is bounded (a few entries per year), so it is broadcast
    as a left-semi lookup and never shuffles the fact table.
    """
    d = F.col(date_col)
    out = df.withColumns({
        "day_of_week": day_of_week(d),
        "day_of_month": F.dayofmonth(d),
        "month": F.month(d),
        "week_of_year": iso_week(d),
        "is_weekend": (day_of_week(d) >= 5).cast("int"),
    })
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(0))
    h = F.broadcast(holidays.select(F.col("holiday_date").alias("_hd")).distinct()
                    .withColumn("_is_h", F.lit(1)))
    return (out.join(h, out[date_col] == h["_hd"], "left")
            .withColumn("is_holiday", F.coalesce(F.col("_is_h"), F.lit(0)))
            .drop("_hd", "_is_h"))


def add_lag_features(df: DataFrame, lags=DEFAULT_LAGS, key: str = "sku", value: str = "units_sold") -> DataFrame:
    """``lag_k`` by row within the series (row-based, as the reference)."""
    w = series_window(key)
    return df.withColumns({f"lag_{k}": F.lag(value, k).over(w) for k in lags})


def add_rolling_features(df: DataFrame, windows=DEFAULT_WINDOWS, key: str = "sku",
                         value: str = "units_sold") -> DataFrame:
    """Mean and sample std of the previous ``w`` rows (current row excluded)."""
    base = series_window(key)
    cols = {}
    for w in windows:
        frame = base.rowsBetween(-w, -1)
        cols[f"rolling_mean_{w}"] = F.avg(value).over(frame)
        cols[f"rolling_std_{w}"] = F.stddev_samp(value).over(frame)
    return df.withColumns(cols)


def fill_numeric_nulls(df: DataFrame, value=0) -> DataFrame:
    """F10's ``fillna(0)``, restricted to numeric columns (Q19)."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(value, subset=num)


def prepare_features(df: DataFrame, holidays: DataFrame | None = None, include_lags: bool = True) -> DataFrame:
    """calendar parts, then lags and rolling statistics, then fill NULL with 0.

    ``stddev_samp`` of a single value is NULL in Spark (NaN in pandas); both
    become 0 after the fill (Q15).
    """
    out = add_calendar_features(df, holidays)
    if include_lags:
        out = add_rolling_features(add_lag_features(out))
    return fill_numeric_nulls(out)


def feature_columns(df: DataFrame) -> list[str]:
    """the fixed list, restricted to the columns present."""
    return [c for c in FEATURE_COLUMNS if c in df.columns]


def feature_step_report(pos_df: DataFrame, feat_df: DataFrame) -> DataFrame:
    """input rows, output rows, feature count (one row, one job, no join)."""
    n_feat = len(feature_columns(feat_df))
    tagged = (pos_df.select(F.lit(1).alias("_i"), F.lit(0).alias("_o"))
              .unionByName(feat_df.select(F.lit(0).alias("_i"), F.lit(1).alias("_o"))))
    return tagged.agg(F.sum("_i").cast("bigint").alias("rows_in"),
                      F.sum("_o").cast("bigint").alias("rows_out"),
                      F.lit(n_feat).alias("n_features"))
