"""Retail-shaped inputs derived from the given TPC-H-like tables.

The reference consumes a calendar, a wide daily sales table and weekly prices.
Those files are not available, so this adapter derives the same shapes from
``lineitem``/``supplier``/``nation``/``region`` (see FIXTURES.md §2):

* store = region name, item = a pair of neighbouring supplier keys (so items and
  series grow with the data), day = ship date, units = quantity;
* the calendar holds every ship date; weeks whose ISO number is divisible by 13
  carry no price so that the "not yet on sale" drop has work to do.

The base derivations (``sku_day``, ``calendar_raw``, ``pos``) and the raw
inputs of the cleaners (wide sales and the dirtied tables, which are files in
the reference) are materialised once per input in the shared folder (S10), so
every query built on them starts from a Parquet scan. Nothing is collected except the list of day
columns (one a calendar day) needed to pivot the wide sales table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.dates import iso_week, iso_year
from shelfcast.functions.hashing import md5_mod
from shelfcast.sources.materialize import materialized, wide_partitions
from shelfcast.sources.tables import read_table, table_path

# Fixed values of the adapter (FIXTURES.md §2).
DAY_ZERO = "1995-01-01"          # d_1 is this date
NO_PRICE_WEEK_MODULUS = 13       # weeks with wm_yr_wk % 13 == 0 have no price
ZERO_ITEM = "Suppl#1"            # item zeroed in the dirtied sales


def week_key(d: Column) -> Column:
    """``wm_yr_wk`` = ISO year * 100 + ISO week."""
    return (iso_year(d) * 100 + iso_week(d)).cast("int")


def category_of(item_id: Column) -> Column:
    n = F.substring(item_id, 7, 10).cast("int") % 3
    return F.when(n == 0, "FOODS").when(n == 1, "HOUSEHOLD").otherwise("HOBBIES")


def department_of(item_id: Column) -> Column:
    """Three departments a category."""
    n = F.substring(item_id, 7, 10).cast("int")
    return F.concat(category_of(item_id), F.lit("_"), (F.floor(n / 3) % 3 + 1).cast("string"))


def day_number(d: Column) -> Column:
    return F.datediff(d, F.lit(DAY_ZERO).cast("date")) + 1


def sku_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = [table_path(sf_dir, t) for t in ("lineitem", "supplier", "nation", "region")]
    return materialized(spark, "sku_day", src, lambda: build_sku_day(spark, sf_dir))


def calendar_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, "calendar_raw", [table_path(sf_dir, "lineitem")],
                        lambda: build_calendar_raw(spark, sf_dir))


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = [table_path(sf_dir, t) for t in ("lineitem", "supplier", "nation", "region")]
    return materialized(spark, "pos", src, lambda: build_pos(spark, sf_dir))


def build_sku_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily units and revenue per (store, item); the heavy aggregation of the adapter.

    nation (25 rows) and region (5 rows) are fixed-size dimensions and are
    broadcast; supplier grows with the data and is left to the planner (AQE turns
    it into a broadcast only when its measured size allows it).
    The aggregation has at most stores x items x days groups, so the partial
    (map-side) aggregate collapses each task's rows before the shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    supp_region = (supp.join(F.broadcast(nation), supp.s_nationkey == nation.n_nationkey)
                   .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                   .select("s_suppkey", "r_name"))
    j = li.join(supp_region, li.l_suppkey == supp_region.s_suppkey)
    item = F.concat(F.lit("Suppl#"), F.expr("(l_suppkey + 1) div 2").cast("string"))
    return (j.groupBy(F.col("r_name").alias("store_id"), item.alias("item_id"),
                      F.to_date("l_shipdate").alias("date"))
            .agg(F.sum("l_quantity").cast("bigint").alias("units_sold"),
                 F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("revenue_cents")))


def build_calendar_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ship date: ``d``, week key, events and two SNAP flags."""
    dates = (read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
             .select(F.to_date("l_shipdate").alias("date")).distinct())
    dom = F.dayofmonth("date")
    return dates.select(
        "date",
        F.concat(F.lit("d_"), day_number(F.col("date")).cast("string")).alias("d"),
        week_key(F.col("date")).alias("wm_yr_wk"),
        F.when(dom == 1, F.lit("MonthStart")).alias("event_name_1"),
        F.when(dom == 1, F.lit("Cultural")).alias("event_type_1"),
        F.lit(None).cast("string").alias("event_name_2"),
        F.lit(None).cast("string").alias("event_type_2"),
        (dom <= 3).cast("int").alias("snap_A"),
        dom.isin(10, 20).cast("int").alias("snap_B"),
    )


def prices_raw(sd: DataFrame) -> DataFrame:
    """Weekly price per (store, item): integer cents of revenue per unit."""
    wk = week_key(F.col("date"))
    g = (sd.groupBy("store_id", "item_id", wk.alias("wm_yr_wk"))
         .agg(F.sum("revenue_cents").alias("rc"), F.sum("units_sold").alias("u"))
         .where(F.col("wm_yr_wk") % NO_PRICE_WEEK_MODULUS != 0))
    price = F.when(F.col("u") != 0, F.expr("rc div u")) / F.lit(100.0)
    return g.select("store_id", "item_id", "wm_yr_wk", price.alias("sell_price"))


def build_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily point-of-sale table (sku, date, units, price, promo, category).

    The calendar has one row per day, a size bound that makes the broadcast safe.
    """
    sd = sku_day(spark, sf_dir)
    cal = calendar_raw(spark, sf_dir)
    pr = prices_raw(sd)
    promo = ((F.coalesce(F.col("event_name_1"), F.lit("")) != "")
             | (F.greatest("snap_A", "snap_B") == 1)).cast("int")
    c = F.broadcast(cal.select("date", "wm_yr_wk", promo.alias("promo_flag")))
    j = sd.join(c, "date").join(pr, ["store_id", "item_id", "wm_yr_wk"])
    return j.select(
        "date",
        F.concat("store_id", F.lit("_"), "item_id").alias("sku"),
        "store_id", "units_sold",
        F.col("sell_price").alias("price"),
        "promo_flag",
        category_of(F.col("item_id")).alias("cat_id"),
    )


def sales_long_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, store, category, d, units) for every ship date."""
    sd = sku_day(spark, sf_dir)
    return sd.select("item_id", "store_id", category_of(F.col("item_id")).alias("cat_id"),
                     F.concat(F.lit("d_"), day_number(F.col("date")).cast("string")).alias("d"),
                     "units_sold")


def day_columns(long_df: DataFrame) -> list[str]:
    """Distinct ``d`` values of the wide window, in day order.

    One a calendar day, so collecting it to the driver is safe; it names the pivot
    columns.
    """
    rows = long_df.select("d").distinct().collect()
    return sorted((r.d for r in rows), key=lambda s: int(s[2:]))


def _pivot(long_df: DataFrame) -> DataFrame:
    """The wide form: one shuffle of the narrow rows, whose partitions hold whole items (a wide row is 20 KB of
    cells, so no partial ones travel) and grow in number with the data."""
    ids, cols = ["item_id", "store_id", "cat_id"], day_columns(long_df)
    return (long_df.repartition(wide_partitions(long_df), *ids).groupBy(*ids).pivot("d", cols)
            .agg(F.sum("units_sold").cast("bigint")))


SKU_INPUTS = ("lineitem", "supplier", "nation", "region")


def _sku_inputs(sf_dir: str) -> list[str]:
    return [table_path(sf_dir, t) for t in SKU_INPUTS]


def sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide daily sales: id columns then one ``d_<n>`` column per day (NULL = no sale).

    This is a raw input of the pipeline (a file in the reference), so it is
    written once per input like the other raw tables below.
    """
    return materialized(spark, "sales_wide", _sku_inputs(sf_dir), lambda: _pivot(sales_long_window(spark, sf_dir)))


# ---------------------------------------------------------------- dirtied inputs
# The corruption pattern applied for the cleaners (FIXTURES.md §2).
CAL_GAP_EVERY, CAL_BAD_DATE_AT, CAL_DUP_AT = 200, (100, 50), (50, 25)
SALES_BAD_CELL_MOD = 20
PRICE_BAD_MOD, PRICE_DUP_MOD = 30, 40


def calendar_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar with a string ``date``: gaps, unparseable dates and duplicate rows (raw input)."""
    return materialized(spark, "calendar_dirty", [table_path(sf_dir, "lineitem")],
                        lambda: build_calendar_dirty(spark, sf_dir))


def build_calendar_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    cal = calendar_raw(spark, sf_dir).withColumn("_n", day_number(F.col("date")))
    kept = cal.where(F.col("_n") % CAL_GAP_EVERY != 0).withColumn(
        "date", F.when(F.col("_n") % CAL_BAD_DATE_AT[0] == CAL_BAD_DATE_AT[1], F.lit("not-a-date"))
        .otherwise(F.col("date").cast("string")))
    dups = kept.where(F.col("_n") % CAL_DUP_AT[0] == CAL_DUP_AT[1])
    return kept.unionByName(dups).drop("_n")


def sales_wide_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sales with negative and NULL cells and one all-zero item (raw input)."""
    return materialized(spark, "sales_wide_dirty", _sku_inputs(sf_dir), lambda: build_sales_wide_dirty(spark, sf_dir))


def build_sales_wide_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    lg = sales_long_window(spark, sf_dir)
    cell = md5_mod(F.concat("store_id", "item_id", "d"), SALES_BAD_CELL_MOD) == 0
    dn = F.substring("d", 3, 10).cast("int")
    units = (F.when(F.col("item_id") == ZERO_ITEM, F.lit(0))
             .when(cell & (dn % 2 == 0), -F.col("units_sold"))
             .when(cell, F.lit(None))
             .otherwise(F.col("units_sold")))
    return _pivot(lg.withColumn("units_sold", units.cast("bigint")))


def prices_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with NULL / zero / negative values and duplicated keys (raw input)."""
    return materialized(spark, "prices_dirty", _sku_inputs(sf_dir), lambda: build_prices_dirty(spark, sf_dir))


def build_prices_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with NULL / zero / negative values and duplicated keys.

    ``src_rank`` records file order (0 = original, 1 = appended duplicate) so that
    keep-first deduplication has an explicit order.
    """
    pr = prices_raw(sku_day(spark, sf_dir))
    key = F.concat("store_id", "item_id", F.col("wm_yr_wk").cast("string"))
    bad = md5_mod(key, PRICE_BAD_MOD) == 0
    price = (F.when(bad & (F.col("wm_yr_wk") % 3 == 0), F.lit(None))
             .when(bad & (F.col("wm_yr_wk") % 3 == 1), F.lit(0.0))
             .when(bad, F.lit(-1.0))
             .otherwise(F.col("sell_price")))
    base = pr.select("store_id", "item_id", "wm_yr_wk", price.alias("sell_price"), F.lit(0).alias("src_rank"))
    dups = (pr.where(md5_mod(key, PRICE_DUP_MOD, "#dup") == 1)
            .select("store_id", "item_id", "wm_yr_wk", (F.col("sell_price") + 1.0).alias("sell_price"),
                    F.lit(1).alias("src_rank")))
    return base.unionByName(dups)
