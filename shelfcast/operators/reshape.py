"""Reshape and joins: long sales -> daily point-of-sale table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.clean import melt_sales  # noqa: F401  (J1 lives with the cleaners)
from shelfcast.sources.materialize import wide_partitions


def merge_pos(sales: DataFrame, calendar: DataFrame, prices: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Join calendar on ``d`` and prices on (item, week[, store]); build the SKU key.

    ``sales`` is long (..., d, units_sold), or, with the names of its ``days``, cleaned wide rows (..., units): these
    meet the prices first and are melted behind that join, so a row a series is shuffled and not one a cell.
    Joins are left to the planner: a left join followed by a NOT NULL filter
    on price is rewritten to an inner join by Catalyst, and AQE picks broadcast or
    sort-merge from the measured table sizes.
    """
    cal = calendar.select("d", "date", "wm_yr_wk", "promo_flag")
    keys = ["item_id", "wm_yr_wk"]
    if "store_id" in prices.columns and "store_id" in sales.columns:
        keys.append("store_id")
    if days is None:
        j = sales.join(cal, "d", "left").join(prices.select(*keys, "sell_price"), keys, "left")
    else:
        j = _priced_cells(sales, cal, prices, [k for k in keys if k != "wm_yr_wk"], days)
    sku = (F.concat("store_id", F.lit("_"), "item_id") if "store_id" in j.columns else F.col("item_id"))
    u = F.col("units_sold")
    j = (j.withColumn("sku", sku).withColumnRenamed("sell_price", "price")
         .where(F.col("price").isNotNull())
         .withColumn("units_sold", F.when(u < 0, F.lit(0)).otherwise(u)))
    keep = ["date", "sku"] + (["store_id"] if "store_id" in j.columns else []) + ["units_sold", "price", "promo_flag"]
    keep += [c for c in ("cat_id", "dept_id") if c in j.columns]
    return j.select(*keep)


def _priced_cells(wide: DataFrame, cal: DataFrame, prices: DataFrame, series: list[str], days: list[str]) -> DataFrame:
    """The cells of cleaned wide rows whose week has a price, with their day.

    Prices are gathered to one row a series and the calendar (a row a day) to one a week; a wide row meets its
    prices, these their weeks and those the cells of their days.
    """
    place = F.array_position(F.expr("array(" + ", ".join(f"'{d}'" for d in days) + ")"), F.col("d")).cast("int")
    weeks = (cal.withColumn("_at", place).where(F.col("_at") > 0).groupBy("wm_yr_wk")
             .agg(F.collect_list(F.struct("_at", "date", "promo_flag")).alias("_days")))
    n = wide_partitions(wide)
    own = (prices.where(F.col("sell_price").isNotNull()).repartition(n, *series).groupBy(*series)
           .agg(F.collect_list(F.struct("wm_yr_wk", "sell_price")).alias("_prices")))
    ids = [c for c in wide.columns if c != "units"]
    priced = (wide.repartition(n, *series).join(own, series)
              .select(*ids, "units", F.explode("_prices").alias("_p"))
              .select(*ids, "units", "_p.wm_yr_wk", "_p.sell_price"))
    cells = priced.join(F.broadcast(weeks), "wm_yr_wk").select(*ids, "units", "sell_price", F.explode("_days").alias("_d"))
    return cells.select(*ids, "_d.date", "_d.promo_flag", "sell_price", F.get("units", F.col("_d._at") - 1).alias("units_sold"))


def pos_profile(pos: DataFrame) -> DataFrame:
    """Rows, SKUs, stores, date range, mean units, price range (one row)."""
    return pos.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sku").alias("n_skus"),
                   F.count_distinct("store_id").alias("n_stores"), F.min("date").alias("min_date"),
                   F.max("date").alias("max_date"), F.avg("units_sold").alias("mean_units"),
                   F.min("price").alias("min_price"), F.max("price").alias("max_price"))


def sku_list(pos: DataFrame) -> DataFrame:
    """Distinct SKUs."""
    return pos.select("sku").distinct()


def incremental_merge(existing: DataFrame, new: DataFrame, key: str = "sku", order: str = "date") -> DataFrame:
    """Union old and new observations; on a repeated (key, date) the existing row wins."""
    u = (existing.withColumn("_src", F.lit(0))
         .unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True))
    w = Window.partitionBy(key, order).orderBy("_src")
    return u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
