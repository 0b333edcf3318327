"""Registered queries: exploration (A1-A8) and baseline evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import evaluate as ev
from shelfcast.operators import explore as ex
from shelfcast.operators import features as fe
from shelfcast.plans.oracle_base import fin, with_adapter
from shelfcast.plans.registry import query
from shelfcast.sources import fixture as fx


@query("dow_mean", sql=with_adapter() + fin(
    "SELECT isodow(date) - 1 AS day_of_week, avg(units_sold) AS mean_units FROM pos GROUP BY 1",
    ints=["day_of_week"], dbls=["mean_units"]))
def dow_mean(spark, sf_dir):
    return ex.dow_mean(fx.pos(spark, sf_dir))


@query("daily_total", sql=with_adapter() + "SELECT date, CAST(sum(units_sold) AS BIGINT) AS total_units FROM pos "
       "GROUP BY date")
def daily_total(spark, sf_dir):
    return ex.daily_total(fx.pos(spark, sf_dir))


@query("top_skus", sql=with_adapter() + """
SELECT sku, CAST(sum(units_sold) AS BIGINT) AS total_units FROM pos GROUP BY sku
ORDER BY total_units DESC, sku LIMIT 50""")
def top_skus(spark, sf_dir):
    return ex.top_skus(fx.pos(spark, sf_dir), 50)


@query("price_histogram", sql=with_adapter() + fin("""
SELECT b.bin, count(c.bin) AS n, min(lo) + (b.bin - 1) * (min(hi) - min(lo)) / 30 AS bin_start
FROM (SELECT unnest(range(1, 31)) AS bin) b CROSS JOIN (SELECT min(price) AS lo, max(price) AS hi FROM pos) r
     LEFT JOIN (SELECT CASE WHEN x.hi - x.lo > 0 THEN LEAST(floor((price - x.lo) / (x.hi - x.lo) * 30) + 1, 30) ELSE 1 END AS bin
                FROM pos, (SELECT min(price) AS lo, max(price) AS hi FROM pos) x WHERE price IS NOT NULL) c ON c.bin = b.bin
GROUP BY b.bin""", ints=["bin", "n"], dbls=["bin_start"]))
def price_histogram(spark, sf_dir):
    return ex.price_histogram(fx.pos(spark, sf_dir), 30)


@query("category_counts", sql=with_adapter() + "SELECT cat_id, CAST(count(*) AS BIGINT) AS n_rows FROM pos "
       "GROUP BY cat_id")
def category_counts(spark, sf_dir):
    return ex.category_counts(fx.pos(spark, sf_dir))


@query("series_tail", sql=with_adapter() + """
SELECT sku, date, units_sold FROM (
  SELECT sku, date, units_sold, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rd FROM pos)
WHERE rd <= 90""")
def series_tail(spark, sf_dir):
    return ex.series_tail(fx.pos(spark, sf_dir), 90)


@query("sample_rows", sql=with_adapter() + fin(
    "SELECT * FROM pos ORDER BY sku, date LIMIT 100", ints=["units_sold", "promo_flag"], dbls=["price"],
    keep=["date", "sku", "store_id", "cat_id"]))
def sample_rows(spark, sf_dir):
    return ex.sample_rows(fx.pos(spark, sf_dir), 100)


@query("overview", sql=with_adapter() + """
SELECT CAST(count(*) AS BIGINT) AS n_records, CAST(count(DISTINCT sku) AS BIGINT) AS n_skus,
       min(date) AS min_date, max(date) AS max_date FROM pos""")
def overview(spark, sf_dir):
    return ex.overview(fx.pos(spark, sf_dir))


# ------------------------------------------------------------- evaluation (baseline predictor)
POS_N = """
pos_n AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY date) AS rn,
                 count(*) OVER (PARTITION BY sku) AS n FROM pos)
"""


@query("holdout_split", sql=with_adapter(POS_N) + fin("""
SELECT sku, count(*) AS n_rows, count(*) FILTER (WHERE NOT val) AS train_rows,
       count(*) FILTER (WHERE val) AS val_rows, min(CASE WHEN val THEN date END) AS first_val_date
FROM (SELECT *, rn > n - ceil(0.2::DOUBLE * n) AS val FROM pos_n) GROUP BY sku""",
    ints=["n_rows", "train_rows", "val_rows"], keep=["sku", "first_val_date"]))
def holdout_split(spark, sf_dir):
    return ev.holdout_summary(fx.pos(spark, sf_dir))


@query("cv_folds", sql=with_adapter(POS_N) + fin("""
SELECT sku, fold, min(n) - (4 - fold) * min(ts) AS train_rows, min(ts) AS val_rows,
       min(date) AS val_start_date, max(date) AS val_end_date
FROM (SELECT *, n // 4 AS ts, CASE WHEN rn - 1 >= n - 3 * (n // 4)
                              THEN (rn - 1 - (n - 3 * (n // 4))) // (n // 4) + 1 END AS fold
      FROM pos_n WHERE n > 50)
WHERE fold IS NOT NULL GROUP BY sku, fold""", ints=["fold", "train_rows", "val_rows"],
    keep=["sku", "val_start_date", "val_end_date"]))
def cv_folds(spark, sf_dir):
    return ev.cv_folds(fx.pos(spark, sf_dir))


BASE_SQL = POS_N + """,
scored AS (
  SELECT sku, date, rn, n, units_sold AS actual,
         COALESCE(avg(units_sold) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0)
           AS predicted FROM pos_n),
bm AS (
  SELECT sku, avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) ^ 2)) AS rmse,
         CASE WHEN var_pop(actual) * count(*) = 0 THEN CASE WHEN sum((actual - predicted) ^ 2) = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(*)) END AS r2,
         avg(abs(actual - predicted) / GREATEST(actual, 1)) * 100 AS mape,
         count(*) AS val_samples, min(n) - count(*) AS train_samples
  FROM scored WHERE n >= 50 AND rn > n - ceil(0.2::DOUBLE * n) GROUP BY sku)
"""
METRIC_DBLS = ["mae", "rmse", "r2", "mape"]


def baseline_scored(spark, sf_dir):
    """(sku, date, actual, predicted) with the 7-row rolling mean as the predictor."""
    f = fe.add_rolling_features(fx.pos(spark, sf_dir), windows=(7,))
    return f.select("sku", "date", F.col("units_sold").alias("actual"),
                    F.coalesce(F.col("rolling_mean_7"), F.lit(0.0)).alias("predicted"))


def baseline_metrics_df(spark, sf_dir):
    return ev.holdout_metrics(baseline_scored(spark, sf_dir))


@query("baseline_metrics", sql=with_adapter(BASE_SQL) + fin(
    "SELECT * FROM bm", ints=["val_samples", "train_samples"], dbls=METRIC_DBLS, keep=["sku"]))
def baseline_metrics(spark, sf_dir):
    return baseline_metrics_df(spark, sf_dir)


@query("quality_bands", sql=with_adapter(BASE_SQL) + """
SELECT CASE WHEN r2 > 0.7 THEN 'good' WHEN r2 > 0.3 THEN 'fair' ELSE 'poor' END AS band,
       CAST(count(*) AS BIGINT) AS n_models FROM bm GROUP BY 1""")
def quality_bands(spark, sf_dir):
    return ev.quality_bands(baseline_metrics_df(spark, sf_dir))


@query("worst_models", sql=with_adapter(BASE_SQL) + fin("""
SELECT *, GREATEST((SELECT count(*) FROM bm) - 50, 0) AS n_more FROM (
SELECT row_number() OVER (ORDER BY mae DESC, sku) AS listing_rank, sku, mae, rmse, r2 FROM bm
ORDER BY mae DESC, sku LIMIT 50)""", ints=["listing_rank", "n_more"], dbls=["mae", "rmse", "r2"], keep=["sku"]))
def worst_models(spark, sf_dir):
    return ev.worst_models(baseline_metrics_df(spark, sf_dir), 50)


@query("training_summary", sql=with_adapter(BASE_SQL) + fin("""
SELECT avg(mae) AS avg_mae, avg(rmse) AS avg_rmse, avg(r2) AS avg_r2, count(*) AS trained,
       count(*) FILTER (WHERE r2 > 0.7) AS good_models, (SELECT count(DISTINCT sku) FROM pos) AS total,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE r2 > 0.7) / count(*) ELSE 0.0 END AS good_share
FROM bm""", ints=["trained", "good_models", "total"], dbls=["avg_mae", "avg_rmse", "avg_r2", "good_share"]))
def training_summary(spark, sf_dir):
    return ev.training_summary(baseline_metrics_df(spark, sf_dir), fx.pos(spark, sf_dir).select("sku"))
