"""Registered queries: features F1-F12."""

from __future__ import annotations

from shelfcast.functions.dates import holiday_dimension
from shelfcast.operators import features as fe
from shelfcast.plans.oracle_base import HOLIDAYS, fin, with_adapter
from shelfcast.plans.registry import query
from shelfcast.sources import fixture as fx
from shelfcast.sources.materialize import bucketed
from shelfcast.sources.tables import table_path

FEATURE_SQL = """
feat AS (
  SELECT p.sku, p.date, p.units_sold, p.promo_flag,
         isodow(p.date) - 1 AS day_of_week, day(p.date) AS day_of_month, month(p.date) AS month,
         weekofyear(p.date) AS week_of_year, CAST(isodow(p.date) >= 6 AS INTEGER) AS is_weekend,
         CAST(p.date IN (SELECT holiday_date FROM holidays) AS INTEGER) AS is_holiday,
         COALESCE(lag(units_sold, 1) OVER w, 0) AS lag_1,
         COALESCE(lag(units_sold, 7) OVER w, 0) AS lag_7,
         COALESCE(lag(units_sold, 14) OVER w, 0) AS lag_14,
         COALESCE(avg(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS rolling_mean_7,
         COALESCE(stddev_samp(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS rolling_std_7,
         COALESCE(avg(units_sold) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0) AS rolling_mean_14,
         COALESCE(stddev_samp(units_sold) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 0) AS rolling_std_14
  FROM pos p WINDOW w AS (PARTITION BY sku ORDER BY date))
"""

INT_FEATS = ["units_sold", "promo_flag", "day_of_week", "day_of_month", "month", "week_of_year",
             "is_weekend", "is_holiday", "lag_1", "lag_7", "lag_14"]
DBL_FEATS = ["rolling_mean_7", "rolling_std_7", "rolling_mean_14", "rolling_std_14"]


def features_df(spark, sf_dir, for_training: bool = False):
    """The feature table (pos + F1-F10).

    ``for_training`` gives the stored one: built once per input, bucketed by
    ``sku`` (S10), shared by training, scoring, tails and drift.
    """
    hol = holiday_dimension(fx.calendar_raw(spark, sf_dir))
    if not for_training:
        return fe.prepare_features(fx.pos(spark, sf_dir), hol)
    from shelfcast.operators.forecast import partition_for_training
    return bucketed(spark, "features", [table_path(sf_dir, t) for t in fx.SKU_INPUTS],
                    lambda n: fe.prepare_features(partition_for_training(fx.pos(spark, sf_dir), partitions=n), hol),
                    "sku", ("sku", "date"))


@query("feature_matrix", sql=with_adapter(HOLIDAYS, FEATURE_SQL)
       + fin("SELECT * FROM feat", ints=INT_FEATS, dbls=DBL_FEATS, keep=["sku", "date"]))
def feature_matrix(spark, sf_dir):
    return features_df(spark, sf_dir).select("sku", "date", *INT_FEATS, *DBL_FEATS)


@query("calendar_features", sql=with_adapter(HOLIDAYS, FEATURE_SQL)
       + fin("SELECT * FROM feat", ints=INT_FEATS[2:8], keep=["sku", "date"]))
def calendar_features(spark, sf_dir):
    pos = fx.pos(spark, sf_dir)
    hol = holiday_dimension(fx.calendar_raw(spark, sf_dir))
    return fe.add_calendar_features(pos, hol).select("sku", "date", *INT_FEATS[2:8])


@query("lag_features", sql=with_adapter(HOLIDAYS, FEATURE_SQL) + """
SELECT sku, date, CAST(units_sold AS BIGINT) AS units_sold,
       CAST(lag(units_sold, 1) OVER w AS BIGINT) AS lag_1, CAST(lag(units_sold, 7) OVER w AS BIGINT) AS lag_7,
       CAST(lag(units_sold, 14) OVER w AS BIGINT) AS lag_14
FROM pos WINDOW w AS (PARTITION BY sku ORDER BY date)""")
def lag_features(spark, sf_dir):
    return fe.add_lag_features(fx.pos(spark, sf_dir)).select("sku", "date", "units_sold", "lag_1", "lag_7", "lag_14")


@query("rolling_features", sql=with_adapter() + fin("""
SELECT sku, date,
       avg(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_mean_7,
       stddev_samp(units_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_std_7,
       avg(units_sold) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS rolling_mean_14,
       stddev_samp(units_sold) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS rolling_std_14
FROM pos WINDOW w AS (PARTITION BY sku ORDER BY date)""", dbls=DBL_FEATS, keep=["sku", "date"]))
def rolling_features(spark, sf_dir):
    return fe.add_rolling_features(fx.pos(spark, sf_dir)).select("sku", "date", *DBL_FEATS)


@query("holiday_calendar", sql=with_adapter(HOLIDAYS) + "SELECT holiday_date, holiday_name FROM holidays")
def holiday_calendar(spark, sf_dir):
    return holiday_dimension(fx.calendar_raw(spark, sf_dir))


@query("feature_summary", sql=with_adapter() + """
SELECT CAST(count(*) AS BIGINT) AS rows_in, CAST(count(*) AS BIGINT) AS rows_out, CAST(14 AS BIGINT) AS n_features
FROM pos""")
def feature_summary(spark, sf_dir):
    return fe.feature_step_report(fx.pos(spark, sf_dir), features_df(spark, sf_dir))
