"""Global budget, greedy by margin, with partial fills.

Sequential rule (per SKU in margin-descending order, SKU as tie-break):
``affordable = (budget - spent) div cost; final = min(qty, affordable)``.

Distributed exact form, in rounds. With budget ``R`` left and the candidates
that come after the last fixed row:
  1. a candidate costing more than ``R`` gets 0 (it cannot afford one unit);
  2. over the remaining candidates take the running sum ``S`` of ``qty * cost``;
     every row with ``S <= R`` is filled in full;
  3. the first row with ``S > R`` gets ``(R - S_before) div cost`` (a partial
     fill) and leaves ``R' < cost``; rows after it form the next round.
Each round fixes at least one row and shrinks the budget below the partial
row's cost, so the next round only keeps cheaper rows. Money is integer cents.
Rounds run on Spark; only the single partial row of a round reaches the driver.
A line without a positive cost does not touch the budget and is filled in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.prefix import global_running_sum

# The note appended when the global budget reduces an order.
REDUCED_NOTE = " |  Reduced from %d to %d due to Budget Limit."


def _after(m: Column, s: Column, m0: int, s0: str) -> Column:
    """Rows strictly after (m0, s0) in the order (margin desc, sku asc)."""
    return (m < F.lit(m0)) | ((m == F.lit(m0)) & (s > F.lit(s0)))


def _before(m: Column, s: Column, m0: int, s0: str) -> Column:
    return (m > F.lit(m0)) | ((m == F.lit(m0)) & (s < F.lit(s0)))


def allocate(rows: DataFrame, budget_cents: int, max_rounds: int | None = None) -> DataFrame:
    """Greedy fill of ``rows`` (sku, margin_cents, cost_cents, qty) within ``budget_cents``.

    Returns (sku, final_qty). ``max_rounds`` is only a guard for tests; the loop
    is exact and ends when a round has no partial row.
    """
    spark = rows.sparkSession
    m, s = F.col("margin_cents"), F.col("sku")
    order = [m.desc(), s.asc()]
    wanted = rows.select("sku", "margin_cents", "cost_cents", "qty").where(F.col("qty") > 0)
    free = F.coalesce(F.col("cost_cents") <= 0, F.lit(True))
    pending = wanted.where(~free)
    remaining = int(budget_cents)
    fixed = [wanted.where(free).select("sku", F.col("qty").alias("final_qty"))]
    rounds = 0
    while True:
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError("budget allocation did not finish within max_rounds")
        cand = pending.where(F.col("cost_cents") <= F.lit(remaining))
        run = global_running_sum(cand.withColumn("_line", F.col("qty") * F.col("cost_cents")),
                                 order, "_line", "_S")
        over = run.where(F.col("_S") > F.lit(remaining)).orderBy(*order).limit(1).collect()
        if not over:
            fixed.append(run.select("sku", F.col("qty").alias("final_qty")))
            break
        o = over[0]
        s_before = o["_S"] - o["_line"]
        part = (remaining - s_before) // o["cost_cents"]
        fixed.append(run.where(_before(m, s, o["margin_cents"], o["sku"]))
                     .select("sku", F.col("qty").alias("final_qty")))
        fixed.append(spark.createDataFrame([(o["sku"], int(part))], "sku STRING, final_qty BIGINT"))
        remaining = remaining - s_before - part * o["cost_cents"]
        pending = run.where(_after(m, s, o["margin_cents"], o["sku"])).select(
            "sku", "margin_cents", "cost_cents", "qty")
    filled = fixed[0]
    for f in fixed[1:]:
        filled = filled.unionByName(f)
    return rows.select("sku").join(filled, "sku", "left").select(
        "sku", F.coalesce(F.col("final_qty"), F.lit(0)).cast("bigint").alias("final_qty"))


def global_budget(orders: DataFrame, economics: DataFrame, budget_cents: int | None = None,
                  budget_share: tuple[int, int] = (2, 5)) -> DataFrame:
    """(sku, forecast_qty, margin, unit_cost, base_order_qty, final_order_qty,
    total_sku_cost, rule_applied, budget).

    ``orders`` has (sku, forecast_qty, final_qty, explanation); ``economics`` has
    (sku, unit_cost, selling_price). Without an explicit budget, the budget is
    ``budget_share`` (a fraction num/den, integer cents) of the unconstrained order
    cost, so it binds at every scale.
    """
    cost_c = F.round(F.col("unit_cost") * 100).cast("bigint")
    e = economics.select("sku", cost_c.alias("cost_cents"),
                         (F.round(F.col("selling_price") * 100).cast("bigint") - cost_c).alias("margin_cents"))
    rows = orders.join(e, "sku").select("sku", "forecast_qty", "margin_cents", "cost_cents",
                                        F.col("final_qty").alias("qty"), "explanation")
    rows = rows.checkpoint(eager=True)
    if budget_cents is None:
        tot = rows.agg(F.sum(F.col("qty") * F.col("cost_cents")).alias("t")).collect()[0]["t"] or 0
        budget_cents = int(tot) * budget_share[0] // budget_share[1]
    alloc = allocate(rows, budget_cents)
    j = rows.join(alloc, "sku")
    note = F.when(F.col("final_order_qty") < F.col("qty"),
                  F.concat(F.col("explanation"),
                           F.format_string(REDUCED_NOTE, F.col("qty"), F.col("final_order_qty"))))
    return j.select(
        "sku", "forecast_qty",
        (F.col("margin_cents") / 100.0).alias("margin"),
        (F.col("cost_cents") / 100.0).alias("unit_cost"),
        F.col("qty").alias("base_order_qty"),
        F.col("final_qty").alias("final_order_qty"),
        (F.col("final_qty") * F.col("cost_cents") / 100.0).alias("total_sku_cost"),
        F.coalesce(note, F.col("explanation")).alias("rule_applied"),
        (F.lit(budget_cents) / 100.0).alias("budget"),
    )


def budget_summary(alloc: DataFrame) -> DataFrame:
    """Totals of forecast, order, spend, remaining budget and reduction %."""
    g = alloc.agg(F.sum("forecast_qty").cast("bigint").alias("total_forecast"),
                  F.sum("final_order_qty").cast("bigint").alias("total_order"),
                  F.sum(F.round(F.col("total_sku_cost") * 100)).cast("bigint").alias("_spent_c"),
                  F.max(F.round(F.col("budget") * 100)).cast("bigint").alias("_budget_c"))
    red = F.when(F.col("total_forecast") > 0, (F.col("total_forecast") - F.col("total_order"))
                 / F.col("total_forecast") * 100).otherwise(0.0)
    return g.select("total_forecast", "total_order", (F.col("_spent_c") / 100.0).alias("total_spent"),
                    ((F.col("_budget_c") - F.col("_spent_c")) / 100.0).alias("remaining_budget"),
                    red.alias("reduction_pct"))
