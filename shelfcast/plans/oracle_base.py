"""DuckDB SQL for the fixture adapter, shared by every oracle query.

These CTEs restate FIXTURES.md §2 and the dirtied variants of
``shelfcast.sources.fixture`` in DuckDB SQL over the pre-registered views.
DuckDB inlines CTEs, so unreferenced ones cost nothing.
"""

from __future__ import annotations

H = "('0x' || substr(md5({}), 1, 8))::BIGINT"


def h(expr: str, salt: str = "") -> str:
    """DuckDB twin of ``functions.hashing.md5_u32``."""
    return H.format(expr if not salt else f"({expr}) || '{salt}'")


WEEK = "CAST(isoyear({d}) * 100 + weekofyear({d}) AS INTEGER)"
CAT = ("CASE CAST(substr({i}, 7) AS INTEGER) % 3 WHEN 0 THEN 'FOODS' WHEN 1 THEN 'HOUSEHOLD' "
       "ELSE 'HOBBIES' END")
DAYNUM = "(date_diff('day', DATE '1995-01-01', {d}) + 1)"

ADAPTER = f"""
sku_day AS (
  SELECT r_name AS store_id, 'Suppl#' || CAST((l_suppkey + 1) // 2 AS VARCHAR) AS item_id, CAST(l_shipdate AS DATE) AS date,
         CAST(SUM(l_quantity) AS BIGINT) AS units_sold,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS revenue_cents
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3),
calendar_raw AS (
  SELECT date, 'd_' || CAST({DAYNUM.format(d='date')} AS VARCHAR) AS d,
         {WEEK.format(d='date')} AS wm_yr_wk,
         CASE WHEN day(date) = 1 THEN 'MonthStart' END AS event_name_1,
         CASE WHEN day(date) = 1 THEN 'Cultural' END AS event_type_1,
         CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
         CAST(day(date) <= 3 AS INTEGER) AS snap_A, CAST(day(date) IN (10, 20) AS INTEGER) AS snap_B
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)),
prices_raw AS (
  SELECT store_id, item_id, {WEEK.format(d='date')} AS wm_yr_wk,
         (CAST(SUM(revenue_cents) AS BIGINT) // CAST(SUM(units_sold) AS BIGINT)) / 100.0 AS sell_price
  FROM sku_day GROUP BY 1, 2, 3
  HAVING {WEEK.format(d='date')} % 13 <> 0),
pos AS (
  SELECT s.date, s.store_id || '_' || s.item_id AS sku, s.store_id, s.units_sold, p.sell_price AS price,
         CAST(COALESCE(c.event_name_1, '') <> '' OR GREATEST(c.snap_A, c.snap_B) = 1 AS INTEGER) AS promo_flag,
         {CAT.format(i='s.item_id')} AS cat_id
  FROM sku_day s JOIN calendar_raw c ON s.date = c.date
       JOIN prices_raw p ON p.store_id = s.store_id AND p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk),
sales_long_window AS (
  SELECT item_id, store_id, {CAT.format(i='item_id')} AS cat_id,
         'd_' || CAST({DAYNUM.format(d='date')} AS VARCHAR) AS d, units_sold
  FROM sku_day),
sales_cells AS (
  SELECT i.item_id, i.store_id, i.cat_id, dd.d, s.units_sold
  FROM (SELECT DISTINCT item_id, store_id, cat_id FROM sales_long_window) i
       CROSS JOIN (SELECT DISTINCT d FROM sales_long_window) dd
       LEFT JOIN sales_long_window s ON s.item_id = i.item_id AND s.store_id = i.store_id AND s.d = dd.d),
sales_cells_dirty AS (
  SELECT i.item_id, i.store_id, i.cat_id, dd.d,
         CAST(CASE WHEN s.d IS NULL THEN NULL
              WHEN i.item_id = 'Suppl#1' THEN 0
              WHEN s.d IS NOT NULL AND {h("s.store_id || s.item_id || s.d")} % 20 = 0
                   AND CAST(substr(s.d, 3) AS INTEGER) % 2 = 0 THEN -s.units_sold
              WHEN s.d IS NOT NULL AND {h("s.store_id || s.item_id || s.d")} % 20 = 0 THEN NULL
              ELSE s.units_sold END AS BIGINT) AS units_sold
  FROM (SELECT DISTINCT item_id, store_id, cat_id FROM sales_long_window) i
       CROSS JOIN (SELECT DISTINCT d FROM sales_long_window) dd
       LEFT JOIN sales_long_window s ON s.item_id = i.item_id AND s.store_id = i.store_id AND s.d = dd.d),
calendar_kept AS (
  SELECT CASE WHEN {DAYNUM.format(d='date')} % 100 = 50 THEN 'not-a-date' ELSE CAST(date AS VARCHAR) END AS date,
         d, wm_yr_wk, event_name_1, event_type_1, event_name_2, event_type_2, snap_A, snap_B,
         {DAYNUM.format(d='date')} AS _n
  FROM calendar_raw WHERE {DAYNUM.format(d='date')} % 200 <> 0),
calendar_dirty AS (
  SELECT * EXCLUDE (_n) FROM calendar_kept
  UNION ALL SELECT * EXCLUDE (_n) FROM calendar_kept WHERE _n % 50 = 25),
prices_dirty AS (
  SELECT store_id, item_id, wm_yr_wk,
         CASE WHEN {h("store_id || item_id || CAST(wm_yr_wk AS VARCHAR)")} % 30 = 0 AND wm_yr_wk % 3 = 0 THEN NULL
              WHEN {h("store_id || item_id || CAST(wm_yr_wk AS VARCHAR)")} % 30 = 0 AND wm_yr_wk % 3 = 1 THEN 0.0
              WHEN {h("store_id || item_id || CAST(wm_yr_wk AS VARCHAR)")} % 30 = 0 THEN -1.0
              ELSE sell_price END AS sell_price, 0 AS src_rank
  FROM prices_raw
  UNION ALL
  SELECT store_id, item_id, wm_yr_wk, sell_price + 1.0, 1
  FROM prices_raw WHERE {h("store_id || item_id || CAST(wm_yr_wk AS VARCHAR)", "#dup")} % 40 = 1)
"""


# The holiday rules of functions.dates.US_FEDERAL_HOLIDAYS, restated.
HOLIDAYS = """
hol_years AS (SELECT unnest(range(min(year(date)) - 1, max(year(date)) + 2)) AS year FROM calendar_raw),
hol_rules(name, month, rule, n, wd, y0) AS (VALUES
  ('New Year''s Day', 1, 'fixed', 1, NULL, 1871),
  ('Martin Luther King Jr. Day', 1, 'nth', 3, 0, 1986),
  ('Washington''s Birthday', 2, 'nth', 3, 0, 1971),
  ('Memorial Day', 5, 'last', NULL, 0, 1971),
  ('Juneteenth National Independence Day', 6, 'fixed', 19, NULL, 2021),
  ('Independence Day', 7, 'fixed', 4, NULL, 1871),
  ('Labor Day', 9, 'nth', 1, 0, 1894),
  ('Columbus Day', 10, 'nth', 2, 0, 1971),
  ('Veterans Day', 11, 'fixed', 11, NULL, 1954),
  ('Thanksgiving', 11, 'nth', 4, 3, 1871),
  ('Christmas Day', 12, 'fixed', 25, NULL, 1871)),
hol_actual AS (
  SELECT name, rule, CASE rule
    WHEN 'fixed' THEN make_date(year, month, n)
    WHEN 'nth' THEN make_date(year, month, 1)
         + CAST((((wd - (isodow(make_date(year, month, 1)) - 1)) % 7) + 7) % 7 + (n - 1) * 7 AS INTEGER)
    ELSE last_day(make_date(year, month, 1))
         - CAST((((isodow(last_day(make_date(year, month, 1))) - 1 - wd) % 7) + 7) % 7 AS INTEGER)
    END AS holiday_date
  FROM hol_years JOIN hol_rules ON year >= y0),
holidays AS (
  SELECT holiday_date, name AS holiday_name FROM hol_actual
  UNION ALL
  SELECT CASE isodow(holiday_date) WHEN 6 THEN holiday_date - 1 WHEN 7 THEN holiday_date + 1 END,
         name || ' (observed)'
  FROM hol_actual WHERE rule = 'fixed' AND isodow(holiday_date) IN (6, 7))
"""


def fin(body: str, ints=(), dbls=(), keep=(), digits: int = 4) -> str:
    """Final projection with the normalisation used by the Spark side.

    Integral columns become BIGINT, floating columns ``round(x, digits) + 0.0``.
    """
    cols = ([f"CAST({c} AS BIGINT) AS {c}" for c in ints]
            + [f"ROUND(CAST({c} AS DOUBLE) + 1e-9, {digits}) + 0.0 AS {c}" for c in dbls]
            + list(keep))
    return f"SELECT {', '.join(cols)} FROM ({body}) q"


def with_adapter(*ctes: str) -> str:
    """``WITH`` clause holding the adapter plus extra named CTEs."""
    parts = [ADAPTER.strip()] + [c.strip() for c in ctes]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"
