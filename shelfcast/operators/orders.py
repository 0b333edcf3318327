"""Business rules: derive rules, forecast, constrain orders.

Every rule is a column expression evaluated inside whole-stage codegen; the
reference's row loop becomes a projection after two left joins on ``sku``.
Rules, stock and economics have one row per SKU.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.hashing import md5_choice, md5_mod, md5_unit

# Category-dependent perishability choices and safety days.
PERISHABILITY_CHOICES = {"FOODS": [7, 10, 14], "HOUSEHOLD": [90, 120, 180], "OTHER": [60, 90, 120]}
SAFETY_STOCK_DAYS = {"FOODS": 1, "HOUSEHOLD": 3, "OTHER": 2}
# Per-field defaults of a loaded rule file.
RULE_DEFAULTS = {"max_shelf_capacity": 100, "unit_cost": 1.0, "max_budget_per_order": 500,
                 "perishability_days": 30, "safety_stock_days": 2}
RULE_FIELDS = list(RULE_DEFAULTS)
# Order explanation texts.
NO_RULE_NOTE = "No rules configured, using raw forecast minus stock"
WITHIN_NOTE = "Within all constraints"
SHELF_NOTE = "Capped by shelf capacity (%d)"
BUDGET_NOTE = "Capped by budget ($%d)"
PERISH_NOTE = "Capped by perishability (%d days)"
NOTE_SEPARATOR = "; "
DEFAULT_STOCK = 50


def sku_profile(pos: DataFrame) -> DataFrame:
    """One aggregate per SKU feeding rules (B1), demand (B3) and the SKU list.

    Deriving all three from this one frame lets Spark reuse a single exchange
    (ReuseExchange) instead of aggregating the fact table once per consumer.
    """
    has_cat = "cat_id" in pos.columns
    cat = F.min_by("cat_id", "date") if has_cat else F.lit("UNKNOWN")
    return pos.groupBy("sku").agg(F.avg("units_sold").alias("_avg_u"), F.max("units_sold").alias("_max_u"),
                                  F.avg("price").alias("_avg_p"), cat.alias("category"))


def derive_rules(pos: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """B1: one rule row per SKU from its history (one shuffle on sku, partial agg)."""
    g = profile if profile is not None else sku_profile(pos)
    c = F.col("category")
    perish = (F.when(c == "FOODS", md5_choice(F.col("sku"), PERISHABILITY_CHOICES["FOODS"]))
              .when(c == "HOUSEHOLD", md5_choice(F.col("sku"), PERISHABILITY_CHOICES["HOUSEHOLD"]))
              .otherwise(md5_choice(F.col("sku"), PERISHABILITY_CHOICES["OTHER"])))
    safety = (F.when(c == "FOODS", SAFETY_STOCK_DAYS["FOODS"])
              .when(c == "HOUSEHOLD", SAFETY_STOCK_DAYS["HOUSEHOLD"]).otherwise(SAFETY_STOCK_DAYS["OTHER"]))
    return g.select(
        "sku", "category",
        F.greatest(F.col("_max_u") * 3, F.col("_avg_u") * 7, F.lit(50)).cast("bigint").alias("max_shelf_capacity"),
        F.round(F.col("_avg_p") * 0.55, 2).alias("unit_cost"),
        F.greatest(F.lit(500), F.col("_avg_u") * F.col("_avg_p") * 7).cast("bigint").alias("max_budget_per_order"),
        perish.cast("bigint").alias("perishability_days"),
        safety.cast("bigint").alias("safety_stock_days"),
    )


def simulated_stock(skus: DataFrame) -> DataFrame:
    """Opening stock 10..99 per SKU, an order-free hash draw."""
    return skus.select("sku", (F.lit(10) + md5_mod(F.col("sku"), 90)).cast("bigint").alias("current_stock"))


def default_stock(skus: DataFrame, level: int = DEFAULT_STOCK) -> DataFrame:
    """S5 fallback: the same stock level for every SKU."""
    return skus.select("sku", F.lit(level).cast("bigint").alias("current_stock"))


def tail_rows(df: DataFrame, n: int, key: str = "sku", order: str = "date") -> DataFrame:
    """Last ``n`` rows per key. ``row_number() <= n`` lets Spark insert a partial
    per-group limit before the shuffle, so at most ``n`` rows per key move."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rd", F.row_number().over(w)).where(F.col("_rd") <= n).drop("_rd")


def weekly_forecast(pos: DataFrame, recent: int = 14, days: int = 7) -> DataFrame:
    """B2: int(mean of the last ``recent`` rows x ``days``)."""
    return (tail_rows(pos.select("sku", "date", "units_sold"), recent).groupBy("sku")
            .agg((F.avg("units_sold") * days).cast("bigint").alias("forecast_qty")))


def daily_demand(pos: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Mean daily units over the whole history."""
    if profile is not None:
        return profile.select("sku", F.col("_avg_u").alias("daily_demand"))
    return pos.groupBy("sku").agg(F.avg("units_sold").alias("daily_demand"))


def _note(cond: Column, text: Column) -> Column:
    return F.when(cond, text)


def constrain(f: Column, s: Column, cap: Column, cost: Column, budget: Column, days: Column,
              demand: Column | None, has_rule: Column) -> tuple[Column, Column]:
    """B4-B9 as expressions: returns (final_qty, explanation)."""
    net = F.greatest(f - s, F.lit(0))
    room = F.greatest(cap - s, F.lit(0))
    cap_hit = net > room
    q1 = F.when(cap_hit, room).otherwise(net)
    units = F.try_divide(budget.cast("double"), cost)  # cost 0 -> NULL -> no cap (Q11)
    bud_hit = F.coalesce(q1 > units, F.lit(False))
    q2 = F.when(bud_hit, F.floor(units)).otherwise(q1)
    if demand is None:
        per_hit, q3 = F.lit(False), q2
    else:
        limit = demand * days
        per_hit = F.coalesce((demand > 0) & (q2 > limit), F.lit(False))
        q3 = F.when(per_hit, F.floor(limit)).otherwise(q2)
    notes = F.concat_ws(NOTE_SEPARATOR,
                        _note(cap_hit, F.format_string(SHELF_NOTE, cap)),
                        _note(bud_hit, F.format_string(BUDGET_NOTE, budget)),
                        _note(per_hit, F.format_string(PERISH_NOTE, days)))
    expl = F.when(~has_rule, F.lit(NO_RULE_NOTE)).otherwise(
        F.coalesce(F.nullif(notes, F.lit("")), F.lit(WITHIN_NOTE)))
    final = F.when(~has_rule, net).otherwise(q3).cast("bigint")
    return final, expl


def apply_rules(forecast: DataFrame, stock: DataFrame, rules: DataFrame,
                demand: DataFrame | None = None) -> DataFrame:
    """B4-B9 for every forecast row: (sku, forecast_qty, current_stock, final_qty, explanation).

    Missing stock counts as 0 (J9); a SKU without a rule takes the no-rule branch (B9, Q10).
    """
    r = rules.select("sku", *RULE_FIELDS, F.lit(True).alias("_has_rule"))
    j = (forecast.join(stock, "sku", "left").join(r, "sku", "left"))
    if demand is not None:
        j = j.join(demand, "sku", "left")
    s = F.coalesce(F.col("current_stock"), F.lit(0))
    final, expl = constrain(F.col("forecast_qty"), s, F.col("max_shelf_capacity"), F.col("unit_cost"),
                            F.col("max_budget_per_order"), F.col("perishability_days"),
                            F.col("daily_demand") if demand is not None else None,
                            F.coalesce(F.col("_has_rule"), F.lit(False)))
    return j.select("sku", "forecast_qty", s.cast("bigint").alias("current_stock"),
                    final.alias("final_qty"), expl.alias("explanation"))


def apply_rules_batch(forecast: DataFrame, stock: DataFrame, rules: DataFrame) -> DataFrame:
    """Batch form without demand, so perishability never binds."""
    out = apply_rules(forecast, stock, rules, None)
    return out.select("sku", "forecast_qty", F.col("final_qty").alias("final_order_qty"),
                      F.col("explanation").alias("rule_explanation"))


def update_rules(rules: DataFrame, edits: DataFrame) -> DataFrame:
    """Apply (sku, field, value, edit_order) edits; unknown SKUs and fields are ignored.

    Of several edits of a field the last by ``edit_order`` counts. Edits are pivoted per SKU with a fixed field list (no value discovery) and
    left-joined, so only SKUs present in ``rules`` change.
    """
    e = edits.where(F.col("field").isin(RULE_FIELDS))
    wide = e.groupBy("sku").agg(*[F.max_by("value", F.when(F.col("field") == f, F.col("edit_order"))).alias(f"_e_{f}")
                                  for f in RULE_FIELDS])
    j = rules.join(wide, "sku", "left")
    cols = []
    for c in rules.columns:
        if c in RULE_FIELDS:
            t = dict(rules.dtypes)[c]
            cols.append(F.coalesce(F.col(f"_e_{c}").cast(t), F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def order_status(final: Column, expl: Column) -> Column:
    return (F.when(expl.contains("Capped"), "capped").when(final == 0, "sufficient_stock").otherwise("ok"))


def order_summary(orders: DataFrame) -> DataFrame:
    """Totals, reduction %, capped and zero counts (one row)."""
    st = order_status(F.col("final_qty"), F.col("explanation"))
    g = orders.agg(F.sum("forecast_qty").cast("bigint").alias("total_forecast"),
                   F.sum("final_qty").cast("bigint").alias("total_order"),
                   F.count_if(st == "capped").cast("bigint").alias("capped_skus"),
                   F.count_if(st == "sufficient_stock").cast("bigint").alias("zero_skus"),
                   F.count(F.lit(1)).cast("bigint").alias("n_skus"))
    red = F.when(F.col("total_forecast") > 0,
                 (F.col("total_forecast") - F.col("total_order")) / F.col("total_forecast") * 100).otherwise(0.0)
    return g.withColumn("reduction_pct", red)


def order_listing(orders: DataFrame, n: int = 30) -> DataFrame:
    """Capped first, then normal, then zero orders; the first ``n`` (a display top-k).

    ``orderBy().limit(n)`` plans a distributed top-k (each task keeps n rows).
    """
    st = order_status(F.col("final_qty"), F.col("explanation"))
    rank = F.when(st == "capped", 0).when(st == "ok", 1).otherwise(2)
    top = (orders.withColumn("status", st).withColumn("_r", rank)
           .orderBy("_r", "sku").limit(n))
    w = Window.orderBy("_r", "sku")  # over at most n rows
    return with_remainder(top.select(F.row_number().over(w).alias("listing_rank"), "sku", "status",
                                     "forecast_qty", "final_qty"), orders, n)


def with_remainder(top: DataFrame, full: DataFrame, n: int) -> DataFrame:
    """Add ``n_more`` ("... and N more"): rows of ``full`` beyond the first ``n``
    (a scalar subquery over ``full``)."""
    total = full.select(F.count(F.lit(1))).scalar()
    return top.withColumn("n_more", F.greatest(total - n, F.lit(0)))


def sku_economics(skus: DataFrame) -> DataFrame:
    """Unit cost U(5, 50), selling price = cost x U(1.2, 2.5), stock 10..99 (hash draws)."""
    sku = F.col("sku")
    cost = F.round(F.lit(5.0) + md5_unit(sku, "#cost") * 45.0, 2)
    price = F.round(cost * (F.lit(1.2) + md5_unit(sku, "#markup") * 1.3), 2)
    return skus.select("sku", cost.alias("unit_cost"), price.alias("selling_price"),
                       (F.lit(10) + md5_mod(sku, 90)).cast("bigint").alias("current_stock"))


def margins(orders: DataFrame, economics: DataFrame) -> DataFrame:
    """margin = price - cost, line cost = qty x cost."""
    j = orders.join(economics.select("sku", "unit_cost", "selling_price"), "sku", "left")
    return j.select("sku", "final_qty", "unit_cost", "selling_price",
                    (F.col("selling_price") - F.col("unit_cost")).alias("margin"),
                    (F.col("final_qty") * F.col("unit_cost")).alias("line_cost"))
