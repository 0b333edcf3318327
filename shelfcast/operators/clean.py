"""Cleaning of the three raw tables.

The wide sales table is cleaned in long form: one ``unpivot`` turns 1,900+ day
columns into rows, so every rule is a single column expression instead of one
expression per day column. Keep-first deduplication always uses an explicit
order, since tables have no row order in Spark (Q5): a column, or the position of a row in the
raw files (``with_file_position``).

The audit of a cleaner (C20) is observed in the pass that cleans. All counts are
taken behind its last shuffle, in the stage that writes: a task that runs
again after the loss of an executor counts once there. Rows that a rule removes
travel that far only when counts are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shelfcast.functions.prefix import global_running_sum
from shelfcast.functions.scalars import combine_scalars
from shelfcast.sources.materialize import wide_partitions
from shelfcast.sources.store import POSITION

EVENT_COLUMNS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
DAY_PREFIX = "d_"


def snap_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("snap_")]


def clean_calendar(raw: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Lenient date parse (drop failures), fill events, flags, whole-row dedup.

    With ``counts`` the pass also observes its audit (C20).
    """
    out, valid = raw, F.lit(True)
    if "date" in out.columns:
        out = out.withColumn("date", F.try_to_date(F.col("date").cast("string")))
        valid = F.col("date").isNotNull()
    ev = [c for c in EVENT_COLUMNS if c in out.columns]
    if counts is None:
        out = out.where(valid)
    else:
        empty = sum((F.col(c).isNull().cast("bigint") for c in ev), F.lit(0).cast("bigint"))
        out = out.withColumn("_filled", F.when(valid, empty).otherwise(0))
    if ev:
        out = out.fillna("", subset=ev)
    has_event = ((F.col("event_name_1") != "").cast("int") if "event_name_1" in out.columns else F.lit(0))
    out = out.withColumn("has_event", has_event)
    snaps = snap_columns(out)
    if snaps:
        any_snap = F.greatest(*snaps) if len(snaps) > 1 else F.col(snaps[0])
        out = out.withColumn("any_snap", any_snap).withColumn(
            "promo_flag", ((F.col("has_event") == 1) | (F.col("any_snap") == 1)).cast("int"))
    else:
        out = out.withColumn("promo_flag", F.col("has_event"))
    if counts is None:
        return out.dropDuplicates()
    columns = [c for c in out.columns if c != "_filled"]
    rows = (out.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"), F.sum("_filled").alias("_filled"))
            .observe(counts, F.sum("_n").alias("rows_before"),
                     F.sum(F.when(~valid, F.col("_n"))).alias("invalid_dates"),
                     F.sum("_filled").alias("events_filled"),
                     F.sum(F.when(valid, F.col("_n") - 1)).alias("duplicates_removed"),
                     F.count_if(valid).alias("rows_after")))
    return rows.where(valid).select(*columns)


def calendar_gaps(cal: DataFrame) -> DataFrame:
    """Dates missing between the first and last calendar date (distinct dates, Q14).

    The generated range has one row per day of the span, a bounded size.
    """
    dates = cal.select("date").distinct()
    span = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).where(F.col("lo").isNotNull())
    full = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return full.join(dates, "date", "left_anti").select(F.col("date").alias("gap_date"))


def calendar_summary(cal: DataFrame) -> DataFrame:
    """Rows, date range, event days, promo days, first and last ``d``."""
    return cal.agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("min_date"),
                   F.max("date").alias("max_date"), F.sum("has_event").alias("event_days"),
                   F.sum("promo_flag").alias("promo_days"), F.min_by("d", "date").alias("first_d"),
                   F.max_by("d", "date").alias("last_d"))


def split_columns(wide: DataFrame, prefix: str = DAY_PREFIX) -> tuple[list[str], list[str]]:
    """(id columns, day columns) by name prefix."""
    days = [c for c in wide.columns if c.startswith(prefix)]
    ids = [c for c in wide.columns if not c.startswith(prefix)]
    return ids, days


def melt_sales(wide: DataFrame, value: str = "units_sold") -> DataFrame:
    """Wide -> long; NULL cells are kept (they are "no value").

    One generator over an array of the day columns: thousands of columns make
    ``unpivot`` plan one projection for each.
    """
    ids, days = split_columns(wide)
    if not days:
        return wide.unpivot(ids, days, "d", value)
    cells = F.expr("array(" + ", ".join(f"`{c}`" for c in days) + ")")
    names = F.expr("array(" + ", ".join(f"'{c}'" for c in days) + ")")
    long = wide.select(*ids, F.posexplode(cells).alias("_day", value))
    return long.select(*ids, F.element_at(names, F.col("_day") + 1).alias("d"), value)


def day_cells(wide: DataFrame) -> Column:
    """The day columns as one array, in their order."""
    return F.expr("array(" + ", ".join(f"`{c}`" for c in split_columns(wide)[1]) + ")")


def clean_sales_wide(wide: DataFrame, dedup_keys: tuple[str, ...] = ("item_id",),
                     order: tuple[str, ...] = ("store_id",), counts: Observation | None = None) -> DataFrame:
    """C10-C13 on the wide rows, in one scan; returns (ids..., units: one value a day column).

    Negative cells -> 0, NULL cells -> 0, items with zero total dropped, then one
    item kept per ``dedup_keys``, the first by ``order`` (the reference keys on
    ``item_id`` alone; pass ``("item_id", "store_id")`` to keep every store). ``order`` may be
    the file position (``POSITION``), which is no id. Rows that repeat all id
    columns are one item, as early as its first row, and stay together. With ``counts`` the pass also
    observes its audit (C20), in rows.
    """
    ids = [c for c in split_columns(wide)[0] if c not in POSITION]
    keys = [k for k in dedup_keys if k in ids] or ids[:1]
    cell = lambda x: F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)).cast("bigint")
    number = lambda test: F.size(F.filter(day_cells(wide), test)).cast("bigint")
    rows = wide.select(*ids, F.struct(*order).alias("_at"), F.transform(day_cells(wide), cell).alias("units"),
                       number(lambda x: x < 0).alias("_negative"), number(lambda x: x.isNull()).alias("_null"))
    own = F.aggregate("units", F.lit(0).cast("bigint"), lambda a, x: a + x)
    item = Window.partitionBy(*ids)
    rows = (rows.repartition(wide_partitions(wide), *keys).withColumn("_sold", F.sum(own).over(item) > 0)
            .withColumn("_first", F.min("_at").over(item)))
    w = Window.partitionBy(*keys).orderBy(F.desc("_sold"), "_first", *ids)
    rows = rows.withColumn("_rank", F.dense_rank().over(w))
    kept = F.col("_sold") & (F.col("_rank") == 1)
    if counts is not None:
        rows = rows.observe(counts, F.count(F.lit(1)).alias("rows_before"), F.sum("_negative").alias("negatives_fixed"),
                            F.sum("_null").alias("nulls_filled"), F.count_if(~F.col("_sold")).alias("zero_items_removed"),
                            F.count_if(F.col("_sold") & ~kept).alias("duplicates_removed"),
                            F.count_if(kept).alias("rows_after"))
    return rows.where(kept).select(*ids, "units")


def melt_units(cleaned: DataFrame, days: list[str]) -> DataFrame:
    """J1 for cleaned wide rows: (ids..., d, units_sold)."""
    ids = [c for c in cleaned.columns if c != "units"]
    names = F.expr("array(" + ", ".join(f"'{c}'" for c in days) + ")")
    long = cleaned.select(*ids, F.posexplode("units").alias("_day", "units_sold"))
    return long.select(*ids, F.element_at(names, F.col("_day") + 1).alias("d"), "units_sold")


def clean_sales(wide: DataFrame, dedup_keys: tuple[str, ...] = ("item_id",),
                order: tuple[str, ...] = ("store_id",)) -> DataFrame:
    """C10-C13 in the long form; returns (ids..., d, units_sold)."""
    return melt_units(clean_sales_wide(wide, dedup_keys, order), split_columns(wide)[1])


def sales_value_counts(clean_long: DataFrame, col: str) -> DataFrame:
    """C14: cleaned items per category (or department)."""
    ids = [c for c in clean_long.columns if c not in ("d", "units_sold", "units")]
    return clean_long.select(*ids).distinct().groupBy(col).agg(F.count(F.lit(1)).alias("n_items"))


def top_items(clean_long: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` items with the largest total volume (a top-k report)."""
    ids = [c for c in clean_long.columns if c not in ("d", "units_sold")]
    return (clean_long.groupBy(*ids).agg(F.sum("units_sold").alias("total_units"))
            .orderBy(F.col("total_units").desc(), *[F.col(c) for c in ids]).limit(n))


def clean_prices(prices: DataFrame, valid_items: DataFrame | None = None,
                 order: tuple[str, ...] = ("src_rank",), counts: Observation | None = None) -> DataFrame:
    """Valid items only, drop NULL/non-positive prices, keep the first row per key by ``order``.

    ``order`` may be the file position (``POSITION``); its columns leave the result. With ``counts``
    the pass also observes its audit (C20): bad rows are then marked, not dropped, until the end.
    """
    out, valid = prices, F.lit(True)
    if valid_items is not None and "item_id" in out.columns:
        items = valid_items.select("item_id").distinct()
        if counts is None:
            out = out.join(items, "item_id", "left_semi")
        else:
            out = out.join(items.withColumn("_valid", F.lit(True)), "item_id", "left")
            valid = F.coalesce("_valid", F.lit(False))
    priced = F.coalesce(F.col("sell_price") > 0, F.lit(False))
    out = out.withColumn("_good", valid & priced)
    if counts is None:
        out = out.where("_good")
    keys = [c for c in ("store_id", "item_id", "wm_yr_wk") if c in out.columns]
    places = [c for c in order if c in out.columns]
    w = Window.partitionBy(*keys).orderBy(F.desc("_good"), *(places or ["sell_price"]))
    if keys:                                              # file positions are long, but compress well
        out = out.repartition(wide_partitions(prices), *keys)
    out = out.withColumn("_rn", F.row_number().over(w) if keys else F.lit(1))
    good, first = F.col("_good"), F.col("_rn") == 1
    if counts is not None:
        out = out.observe(counts, F.count(F.lit(1)).alias("rows_before"), F.count_if(~valid).alias("invalid_items_removed"),
                          F.count_if(valid & ~priced).alias("bad_prices_removed"),
                          F.count_if(good & ~first).alias("duplicates_removed"), F.count_if(good & first).alias("rows_after"))
    return out.where(good & first).select(*[c for c in prices.columns if c not in places])


def exact_median(df: DataFrame, col: str) -> DataFrame:
    """Exact median (mean of the two middle values for an even count), distributed.

    Values are reduced to (value, count) pairs, a global running count is built
    with range partitioning (no single-task window), and the middle ranks are
    picked with the total count as a scalar subquery. Returns one row (NULL
    median for an empty input).
    """
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    run = global_running_sum(vc, [F.col(col).asc()], "_c", "_cum")
    n = run.select(F.max("_cum")).scalar()
    k1 = F.floor((n + 1) / 2)
    k2 = F.floor(n / 2) + 1
    cum = F.col("_cum")
    picks = run.where((cum >= k1) & (cum - F.col("_c") < k2))
    return picks.agg(((F.min(F.when(cum >= k1, F.col(col))) + F.min(F.when(cum >= k2, F.col(col))))
                      / 2.0).cast("double").alias("median"))


def price_summary(prices: DataFrame) -> DataFrame:
    """Distinct items, min, max, mean and exact median price."""
    g = prices.agg(F.count_distinct("item_id").alias("n_items"), F.min("sell_price").alias("min_price"),
                   F.max("sell_price").alias("max_price"), F.avg("sell_price").alias("mean_price"))
    return combine_scalars(g, exact_median(prices, "sell_price"))
