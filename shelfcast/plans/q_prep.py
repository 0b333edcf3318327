"""Registered queries: cleaning (C1-C21), reshape and joins (J1-J11), sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from shelfcast.operators import clean as cl
from shelfcast.operators import reshape as rs
from shelfcast.plans.oracle_base import fin, with_adapter
from shelfcast.plans.registry import query
from shelfcast.sources import fixture as fx
from shelfcast.sources.materialize import observed
from shelfcast.sources.tables import table_path

CAL_CLEAN_SQL = """
cal_parsed AS (
  SELECT TRY_CAST(date AS DATE) AS date, d, wm_yr_wk, COALESCE(event_name_1, '') AS event_name_1,
         COALESCE(event_type_1, '') AS event_type_1, COALESCE(event_name_2, '') AS event_name_2,
         COALESCE(event_type_2, '') AS event_type_2, snap_A, snap_B
  FROM calendar_dirty WHERE TRY_CAST(date AS DATE) IS NOT NULL),
cal_clean AS (
  SELECT DISTINCT *, CAST(event_name_1 <> '' AS INTEGER) AS has_event, GREATEST(snap_A, snap_B) AS any_snap,
         CAST(event_name_1 <> '' OR GREATEST(snap_A, snap_B) = 1 AS INTEGER) AS promo_flag
  FROM cal_parsed)
"""
SALES_CLEAN_SQL = """
sc AS (SELECT item_id, store_id, cat_id, d,
              CAST(COALESCE(CASE WHEN units_sold < 0 THEN 0 ELSE units_sold END, 0) AS BIGINT) AS units_sold
       FROM sales_cells_dirty),
item_tot AS (SELECT item_id, store_id, cat_id, sum(units_sold) AS tot FROM sc GROUP BY item_id, store_id, cat_id),
kept_items AS (
  SELECT item_id, store_id, cat_id FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY store_id, cat_id) AS rn FROM item_tot WHERE tot > 0)
  WHERE rn = 1),
kept_items_all AS (SELECT item_id, store_id, cat_id FROM item_tot WHERE tot > 0),
sales_clean AS (SELECT sc.* FROM sc JOIN kept_items USING (item_id, store_id, cat_id)),
sales_clean_all AS (SELECT sc.* FROM sc JOIN kept_items_all USING (item_id, store_id, cat_id))
"""
PRICES_CLEAN_SQL = """
pc AS (
  SELECT store_id, item_id, wm_yr_wk, sell_price FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id, item_id, wm_yr_wk ORDER BY src_rank) AS rn
    FROM prices_dirty
    WHERE item_id IN (SELECT item_id FROM kept_items) AND sell_price IS NOT NULL AND sell_price > 0)
  WHERE rn = 1),
pc_all AS (
  SELECT store_id, item_id, wm_yr_wk, sell_price FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id, item_id, wm_yr_wk ORDER BY src_rank) AS rn
    FROM prices_dirty
    WHERE item_id IN (SELECT item_id FROM kept_items_all) AND sell_price IS NOT NULL AND sell_price > 0)
  WHERE rn = 1)
"""
PREP = with_adapter(CAL_CLEAN_SQL, SALES_CLEAN_SQL, PRICES_CLEAN_SQL)

CAL_INTS = ["wm_yr_wk", "snap_A", "snap_B", "has_event", "any_snap", "promo_flag"]
CAL_KEEP = ["date", "d", "event_name_1", "event_type_1", "event_name_2", "event_type_2"]


def _raw_inputs(sf_dir):
    return [table_path(sf_dir, t) for t in fx.SKU_INPUTS]


def calendar_cleaning(spark, sf_dir):
    """The cleaned calendar and its audit, written in one pass once per input."""
    return observed(spark, "cleaned_calendar", _raw_inputs(sf_dir),
                    lambda counts: cl.clean_calendar(fx.calendar_dirty(spark, sf_dir), counts))


def sales_cleaning(spark, sf_dir, store_aware=False):
    """The cleaned sales in wide form and their audit: one scan of the raw table."""
    keys = ("item_id", "store_id") if store_aware else ("item_id",)
    return observed(spark, "cleaned_sales_" + "_".join(keys), _raw_inputs(sf_dir),
                    lambda counts: cl.clean_sales_wide(fx.sales_wide_dirty(spark, sf_dir), dedup_keys=keys, counts=counts))


def prices_cleaning(spark, sf_dir, store_aware=False):
    """The cleaned prices of the items kept by the sales cleaner, and their audit."""
    def build(counts):
        items = cleaned_sales_wide(spark, sf_dir, store_aware).select("item_id")
        return cl.clean_prices(fx.prices_dirty(spark, sf_dir), items, counts=counts)
    return observed(spark, f"cleaned_prices_{'all' if store_aware else 'one'}", _raw_inputs(sf_dir), build)


def cleaned_calendar(spark, sf_dir):
    return calendar_cleaning(spark, sf_dir)[0]


def cleaned_sales_wide(spark, sf_dir, store_aware=False):
    return sales_cleaning(spark, sf_dir, store_aware)[0]


def cleaned_sales(spark, sf_dir, store_aware=False):
    days = cl.split_columns(fx.sales_wide_dirty(spark, sf_dir))[1]
    return cl.melt_units(cleaned_sales_wide(spark, sf_dir, store_aware), days)


def cleaned_prices(spark, sf_dir, store_aware=False):
    return prices_cleaning(spark, sf_dir, store_aware)[0]


@query("clean_calendar", sql=PREP + fin("SELECT * FROM cal_clean", ints=CAL_INTS, keep=CAL_KEEP))
def clean_calendar(spark, sf_dir):
    return cleaned_calendar(spark, sf_dir)


@query("calendar_gaps", sql=PREP + """
SELECT CAST(g AS DATE) AS gap_date
FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS g FROM cal_clean)
WHERE CAST(g AS DATE) NOT IN (SELECT date FROM cal_clean)""")
def calendar_gaps(spark, sf_dir):
    return cl.calendar_gaps(cleaned_calendar(spark, sf_dir))


@query("calendar_summary", sql=PREP + fin("""
SELECT count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, sum(has_event) AS event_days,
       sum(promo_flag) AS promo_days, arg_min(d, date) AS first_d, arg_max(d, date) AS last_d FROM cal_clean""",
    ints=["n_rows", "event_days", "promo_days"], keep=["min_date", "max_date", "first_d", "last_d"]))
def calendar_summary(spark, sf_dir):
    return cl.calendar_summary(cleaned_calendar(spark, sf_dir))


@query("clean_sales", sql=PREP + "SELECT * FROM sales_clean")
def clean_sales(spark, sf_dir):
    return cleaned_sales(spark, sf_dir)


@query("sales_category_counts", sql=PREP + """
SELECT cat_id, CAST(count(*) AS BIGINT) AS n_items FROM kept_items GROUP BY cat_id""")
def sales_category_counts(spark, sf_dir):
    return cl.sales_value_counts(cleaned_sales_wide(spark, sf_dir), "cat_id")


@query("sales_department_counts", sql=PREP + """
SELECT cat_id || '_' || CAST((CAST(substr(item_id, 7) AS INTEGER) // 3) % 3 + 1 AS VARCHAR) AS dept_id,
       CAST(count(*) AS BIGINT) AS n_items FROM kept_items GROUP BY 1""")
def sales_department_counts(spark, sf_dir):
    kept = cleaned_sales_wide(spark, sf_dir).withColumn("dept_id", fx.department_of(F.col("item_id")))
    return cl.sales_value_counts(kept, "dept_id")


@query("top_items", sql=PREP + """
SELECT item_id, store_id, cat_id, CAST(sum(units_sold) AS BIGINT) AS total_units FROM sales_clean
GROUP BY ALL ORDER BY total_units DESC, item_id, store_id, cat_id LIMIT 5""")
def top_items(spark, sf_dir):
    return cl.top_items(cleaned_sales(spark, sf_dir), 5)


@query("clean_prices", sql=PREP + fin("SELECT * FROM pc", ints=["wm_yr_wk"], dbls=["sell_price"],
                                      keep=["store_id", "item_id"]))
def clean_prices(spark, sf_dir):
    return cleaned_prices(spark, sf_dir)


@query("price_summary", sql=PREP + fin("""
SELECT count(DISTINCT item_id) AS n_items, min(sell_price) AS min_price, max(sell_price) AS max_price,
       avg(sell_price) AS mean_price, median(sell_price) AS median FROM pc""",
    ints=["n_items"], dbls=["min_price", "max_price", "mean_price", "median"]))
def price_summary(spark, sf_dir):
    return cl.price_summary(cleaned_prices(spark, sf_dir))


AUDIT_SQL = """
cal_a AS (
  SELECT count(*) AS rows_before, count(*) FILTER (WHERE TRY_CAST(date AS DATE) IS NULL) AS invalid_dates,
         count(*) FILTER (WHERE TRY_CAST(date AS DATE) IS NOT NULL AND event_name_1 IS NULL)
         + count(*) FILTER (WHERE TRY_CAST(date AS DATE) IS NOT NULL AND event_type_1 IS NULL)
         + count(*) FILTER (WHERE TRY_CAST(date AS DATE) IS NOT NULL AND event_name_2 IS NULL)
         + count(*) FILTER (WHERE TRY_CAST(date AS DATE) IS NOT NULL AND event_type_2 IS NULL) AS events_filled
  FROM calendar_dirty),
cal_b AS (SELECT (SELECT count(*) FROM cal_parsed) - count(*) AS duplicates_removed, count(*) AS rows_after
          FROM cal_clean),
per_item AS (
  SELECT item_id, store_id, cat_id, count(*) FILTER (WHERE units_sold < 0) AS neg,
         count(*) FILTER (WHERE units_sold IS NULL) AS nul,
         sum(CASE WHEN units_sold > 0 THEN units_sold ELSE 0 END) AS tot
  FROM sales_cells_dirty GROUP BY item_id, store_id, cat_id),
sal AS (
  SELECT count(*) AS rows_before, sum(neg) AS negatives_fixed, sum(nul) AS nulls_filled,
         count(*) FILTER (WHERE tot = 0) AS zero_items_removed,
         count(*) FILTER (WHERE tot > 0) - count(DISTINCT CASE WHEN tot > 0 THEN item_id END) AS duplicates_removed,
         count(DISTINCT CASE WHEN tot > 0 THEN item_id END) AS rows_after
  FROM per_item),
pr_v AS (SELECT *, item_id IN (SELECT item_id FROM kept_items) AS valid FROM prices_dirty),
pr_a AS (
  SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT valid) AS invalid_items_removed,
         count(*) FILTER (WHERE valid AND NOT COALESCE(sell_price > 0, false)) AS bad_prices_removed
  FROM pr_v),
pr_b AS (SELECT sum(n) - count(*) AS duplicates_removed, count(*) AS rows_after FROM (
  SELECT store_id, item_id, wm_yr_wk, count(*) AS n FROM pr_v WHERE valid AND sell_price > 0 GROUP BY ALL))
"""


def _audit_union(rows):
    return "\nUNION ALL ".join(f"SELECT '{t}' AS tbl, '{r}' AS rule, CAST({r} AS BIGINT) AS affected FROM {src}"
                               for t, r, src in rows)


@query("cleaning_audit", sql=with_adapter(CAL_CLEAN_SQL, SALES_CLEAN_SQL, AUDIT_SQL) + _audit_union(
    [("calendar", r, "cal_a") for r in ("rows_before", "invalid_dates", "events_filled")]
    + [("calendar", r, "cal_b") for r in ("duplicates_removed", "rows_after")]
    + [("sales", r, "sal") for r in ("rows_before", "negatives_fixed", "nulls_filled", "zero_items_removed",
                                     "duplicates_removed", "rows_after")]
    + [("prices", r, "pr_a") for r in ("rows_before", "invalid_items_removed", "bad_prices_removed")]
    + [("prices", r, "pr_b") for r in ("duplicates_removed", "rows_after")]))
def cleaning_audit(spark, sf_dir):
    """C20: one (table, rule, affected) row per cleaning rule, as observed when the tables were cleaned."""
    parts = [cleaning(spark, sf_dir)[1].select(F.lit(table).alias("tbl"), "rule", "affected")
             for table, cleaning in (("calendar", calendar_cleaning), ("sales", sales_cleaning), ("prices", prices_cleaning))]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("sales_long", sql=with_adapter() + "SELECT item_id, store_id, cat_id, d, units_sold FROM sales_cells")
def sales_long(spark, sf_dir):
    return cl.melt_sales(fx.sales_wide(spark, sf_dir))


@query("pos_merged", sql=PREP + fin("""
SELECT c.date, s.store_id || '_' || s.item_id AS sku, s.store_id, s.units_sold, p.sell_price AS price,
       c.promo_flag, s.cat_id
FROM sales_clean_all s LEFT JOIN cal_clean c ON c.d = s.d
     LEFT JOIN pc_all p ON p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk AND p.store_id = s.store_id
WHERE p.sell_price IS NOT NULL""", ints=["units_sold", "promo_flag"], dbls=["price"],
    keep=["date", "sku", "store_id", "cat_id"]))
def pos_merged(spark, sf_dir):
    """C21 + J1-J7: clean the three dirtied tables, melt, merge (all stores kept)."""
    days = cl.split_columns(fx.sales_wide_dirty(spark, sf_dir))[1]
    return rs.merge_pos(cleaned_sales_wide(spark, sf_dir, store_aware=True), cleaned_calendar(spark, sf_dir),
                        cleaned_prices(spark, sf_dir, store_aware=True), days)


@query("pos_sorted", sql=PREP + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS overlapping_files,
       CAST(count(*) FILTER (WHERE sku = least) AS BIGINT) AS least_sku_rows,
       max(date) FILTER (WHERE sku = least) AS least_sku_last
FROM (SELECT *, min(sku) OVER () AS least FROM (
  SELECT c.date, s.store_id || '_' || s.item_id AS sku
  FROM sales_clean_all s LEFT JOIN cal_clean c ON c.d = s.d
       LEFT JOIN pc_all p ON p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk AND p.store_id = s.store_id
  WHERE p.sell_price IS NOT NULL))""")
def pos_sorted(spark, sf_dir):
    """The merged table written in the order (sku, date); rows, files whose ranges overlap, and what a
    filter on one SKU (the least) finds."""
    from shelfcast.functions.scalars import combine_scalars
    from shelfcast.sources import store
    path, order = store.unique_path(spark, "pos_sorted"), ("sku", "date")
    store.write_sorted(pos_merged(spark, sf_dir), path, order)
    whole = store.file_ranges(spark, path, order).agg(
        F.sum("n_rows").alias("n_rows"), F.count_if("overlaps").alias("overlapping_files"))
    back = spark.read.parquet(path)
    least = back.agg(F.min("sku")).first()[0]
    one = back.where(F.col("sku") == least).agg(F.count(F.lit(1)).alias("least_sku_rows"), F.max("date").alias("least_sku_last"))
    return combine_scalars(whole, one)


@query("pos_profile", sql=with_adapter() + fin("""
SELECT count(*) AS n_rows, count(DISTINCT sku) AS n_skus, count(DISTINCT store_id) AS n_stores,
       min(date) AS min_date, max(date) AS max_date, avg(units_sold) AS mean_units,
       min(price) AS min_price, max(price) AS max_price FROM pos""",
    ints=["n_rows", "n_skus", "n_stores"], dbls=["mean_units", "min_price", "max_price"],
    keep=["min_date", "max_date"]))
def pos_profile(spark, sf_dir):
    return rs.pos_profile(fx.pos(spark, sf_dir))


@query("sku_list", sql=with_adapter() + "SELECT DISTINCT sku FROM pos")
def sku_list(spark, sf_dir):
    return rs.sku_list(fx.pos(spark, sf_dir))


@query("incremental_merge", sql=with_adapter() + """
SELECT sku, date, CAST(units_sold AS BIGINT) AS units_sold, CAST(src AS BIGINT) AS src FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, date ORDER BY src) AS rn FROM (
    SELECT sku, date, units_sold, 0 AS src FROM pos WHERE date < DATE '2000-01-01'
    UNION ALL SELECT sku, date, units_sold + 1, 1 FROM pos WHERE date >= DATE '1999-07-01'))
WHERE rn = 1""")
def incremental_merge(spark, sf_dir):
    pos = fx.pos(spark, sf_dir).select("sku", "date", "units_sold")
    existing = pos.where(F.col("date") < F.lit("2000-01-01").cast("date"))
    new = (pos.where(F.col("date") >= F.lit("1999-07-01").cast("date"))
           .withColumn("units_sold", F.col("units_sold") + 1))
    return rs.incremental_merge(existing, new).withColumnRenamed("_src", "src")


@query("source_profile", sql=with_adapter() + """
SELECT CAST((SELECT count(*) FROM calendar_raw) AS BIGINT) AS calendar_rows,
       (SELECT min(date) FROM calendar_raw) AS min_date, (SELECT max(date) FROM calendar_raw) AS max_date,
       CAST((SELECT count(DISTINCT d) FROM sales_long_window) AS BIGINT) AS day_columns,
       CAST((SELECT count(*) FROM prices_raw) AS BIGINT) AS price_rows,
       CAST((SELECT count(DISTINCT item_id) FROM prices_raw) AS BIGINT) AS price_items""")
def source_profile(spark, sf_dir):
    """Calendar rows and range, day-column count of the wide sales, price rows and items."""
    from shelfcast.functions.scalars import combine_scalars
    cal = fx.calendar_raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("calendar_rows"),
                                             F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    wide = fx.sales_wide(spark, sf_dir)
    _, days = cl.split_columns(wide)
    pr = fx.prices_raw(fx.sku_day(spark, sf_dir)).agg(F.count(F.lit(1)).alias("price_rows"),
                                                      F.count_distinct("item_id").alias("price_items"))
    return combine_scalars(cal.withColumn("day_columns", F.lit(len(days)).cast("bigint")), pr)


@query("cleaned_sink", sql=PREP + fin("SELECT * FROM cal_clean", ints=CAL_INTS, keep=CAL_KEEP))
def cleaned_sink(spark, sf_dir):
    """Write the cleaned calendar as CSV with a header and read it back with its schema."""
    from shelfcast.sources import store
    df = cleaned_calendar(spark, sf_dir)
    path = store.unique_path(spark, "calendar_cleaned_csv")
    df.write.mode("overwrite").option("header", True).csv(path)
    back = spark.read.option("header", True).schema(df.schema).csv(path)
    return back.fillna("", subset=[c for c in cl.EVENT_COLUMNS if c in back.columns])


@query("raw_csv_clean_calendar", sql=PREP + fin("SELECT * FROM cal_clean", ints=CAL_INTS, keep=CAL_KEEP))
def raw_csv_clean_calendar(spark, sf_dir):
    """The raw calendar arrives as CSV (no Parquet cache yet), is read through
    the cached-scan fallback with an explicit schema, and cleaned."""
    from shelfcast.sources import store
    raw = fx.calendar_dirty(spark, sf_dir)
    base = store.unique_path(spark, "raw_calendar")
    raw.write.mode("overwrite").option("header", True).csv(base + "/calendar.csv")
    scanned = store.cached_scan(spark, base + "/calendar.csv", base + "/calendar.parquet", schema=raw.schema)
    return cl.clean_calendar(scanned)


def _through_csv(spark, raw, name, order):
    """Write a raw table as CSV in the given order and read it, with the position of every row in the files,
    through the cached-scan fallback (no Parquet cache yet). ``src_rank`` is not in the files."""
    from shelfcast.sources import store
    base = store.unique_path(spark, f"raw_{name}")
    raw = raw.orderBy(*order).drop("src_rank")
    raw.write.option("header", True).csv(base + f"/{name}.csv")
    return store.with_file_position(
        store.cached_scan(spark, base + f"/{name}.csv", base + f"/{name}.parquet", schema=raw.schema))


@query("raw_csv_clean_sales", sql=PREP + "SELECT * FROM sales_clean")
def raw_csv_clean_sales(spark, sf_dir):
    """The wide sales arrive as CSV, every day column, and are cleaned; the first item in file order stays."""
    raw = _through_csv(spark, fx.sales_wide_dirty(spark, sf_dir), "sales", ("store_id", "cat_id", "item_id"))
    return cl.clean_sales(raw, order=cl.POSITION)


@query("raw_csv_clean_prices", sql=PREP + fin("SELECT * FROM pc", ints=["wm_yr_wk"], dbls=["sell_price"],
                                              keep=["store_id", "item_id"]))
def raw_csv_clean_prices(spark, sf_dir):
    """The prices arrive as CSV and are cleaned against the cleaned sales' items; the first
    price of a key in file order stays."""
    prices = _through_csv(spark, fx.prices_dirty(spark, sf_dir), "prices", ("src_rank", "store_id", "item_id", "wm_yr_wk"))
    return cl.clean_prices(prices, cleaned_sales_wide(spark, sf_dir), order=cl.POSITION)
