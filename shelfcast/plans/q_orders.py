"""Registered queries: business rules and ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.hashing import md5_mod
from shelfcast.operators import budget as bg
from shelfcast.operators import orders as od
from shelfcast.plans.oracle_base import fin, h, with_adapter
from shelfcast.plans.registry import query
from shelfcast.sources import fixture as fx
from shelfcast.sources import store

U = "(({}) :: DOUBLE / 4294967296.0::DOUBLE)"

RULES_SQL = f"""
rule_stats AS (
  SELECT sku, avg(units_sold) AS avg_u, max(units_sold) AS max_u, avg(price) AS avg_p,
         arg_min(cat_id, date) AS category FROM pos GROUP BY sku),
rules_d AS (
  SELECT sku, category,
         CAST(trunc(GREATEST(max_u * 3, avg_u * 7, 50)) AS BIGINT) AS max_shelf_capacity,
         ROUND(avg_p * 0.55, 2) AS unit_cost,
         CAST(trunc(GREATEST(500, avg_u * avg_p * 7)) AS BIGINT) AS max_budget_per_order,
         CAST(CASE category WHEN 'FOODS' THEN [7, 10, 14][{h('sku')} % 3 + 1]
                           WHEN 'HOUSEHOLD' THEN [90, 120, 180][{h('sku')} % 3 + 1]
                           ELSE [60, 90, 120][{h('sku')} % 3 + 1] END AS BIGINT) AS perishability_days,
         CAST(CASE category WHEN 'FOODS' THEN 1 WHEN 'HOUSEHOLD' THEN 3 ELSE 2 END AS BIGINT) AS safety_stock_days
  FROM rule_stats),
fc AS (
  SELECT sku, CAST(trunc(avg(units_sold) * 7) AS BIGINT) AS forecast_qty
  FROM (SELECT sku, units_sold, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rd FROM pos)
  WHERE rd <= 14 GROUP BY sku),
stock_fx AS (SELECT sku, CAST(10 + {h('sku')} % 90 AS BIGINT) AS current_stock FROM (SELECT DISTINCT sku FROM pos)),
demand AS (SELECT sku, avg(units_sold) AS daily_demand FROM pos GROUP BY sku)
"""


def constrain_sql(src: str, with_demand: bool = True) -> str:
    """CTEs ar1..ar4 applying B4-B9 to ``src`` (sku, forecast_qty, cs, cap, cost, bud, pdays, dd, has_rule)."""
    per = ("COALESCE(dd > 0 AND q2 > dd * pdays, false)" if with_demand else "false")
    return f"""
ar1 AS (SELECT *, GREATEST(forecast_qty - cs, 0) AS net, GREATEST(cap - cs, 0) AS room,
               CASE WHEN cost = 0 THEN NULL ELSE bud / cost END AS units FROM {src}),
ar2 AS (SELECT *, COALESCE(net > room, false) AS cap_hit,
               CASE WHEN net > room THEN room ELSE net END AS q1 FROM ar1),
ar3 AS (SELECT *, COALESCE(q1 > units, false) AS bud_hit,
               CASE WHEN COALESCE(q1 > units, false) THEN floor(units) ELSE q1 END AS q2 FROM ar2),
ar4 AS (SELECT *, {per} AS per_hit,
               CASE WHEN {per} THEN floor(dd * pdays) ELSE q2 END AS q3 FROM ar3),
ar AS (
  SELECT sku, forecast_qty, cs AS current_stock,
         CAST(CASE WHEN has_rule THEN q3 ELSE net END AS BIGINT) AS final_qty,
         CASE WHEN NOT has_rule THEN 'No rules configured, using raw forecast minus stock'
              ELSE COALESCE(NULLIF(concat_ws('; ',
                     CASE WHEN cap_hit THEN 'Capped by shelf capacity (' || cap || ')' END,
                     CASE WHEN bud_hit THEN 'Capped by budget ($' || bud || ')' END,
                     CASE WHEN per_hit THEN 'Capped by perishability (' || pdays || ' days)' END), ''),
                   'Within all constraints') END AS explanation
  FROM ar4)
"""


AR_INPUT = """
ar_in AS (
  SELECT f.sku, f.forecast_qty, COALESCE(st.current_stock, 0) AS cs, r.max_shelf_capacity AS cap,
         r.unit_cost AS cost, r.max_budget_per_order AS bud, r.perishability_days AS pdays,
         dm.daily_demand AS dd, r.sku IS NOT NULL AS has_rule
  FROM fc f LEFT JOIN stock_fx st ON st.sku = f.sku LEFT JOIN rules_d r ON r.sku = f.sku
       LEFT JOIN demand dm ON dm.sku = f.sku)
"""
APPLY_SQL = with_adapter(RULES_SQL, AR_INPUT, constrain_sql("ar_in"))


def rule_inputs(spark, sf_dir):
    pos = fx.pos(spark, sf_dir)
    prof = od.sku_profile(pos)
    return (pos, od.derive_rules(pos, prof), od.weekly_forecast(pos), od.simulated_stock(prof.select("sku")),
            od.daily_demand(pos, prof))


def applied_orders(spark, sf_dir):
    pos, rules, fc, stock, dem = rule_inputs(spark, sf_dir)
    return od.apply_rules(fc, stock, rules, dem)


@query("derived_rules", sql=with_adapter(RULES_SQL) + "SELECT * FROM rules_d")
def derived_rules(spark, sf_dir):
    return od.derive_rules(fx.pos(spark, sf_dir))


@query("weekly_forecast", sql=with_adapter(RULES_SQL) + "SELECT * FROM fc")
def weekly_forecast(spark, sf_dir):
    return od.weekly_forecast(fx.pos(spark, sf_dir))


@query("daily_demand", sql=with_adapter(RULES_SQL) + fin("SELECT * FROM demand", dbls=["daily_demand"],
                                                          keep=["sku"]))
def daily_demand(spark, sf_dir):
    return od.daily_demand(fx.pos(spark, sf_dir))


@query("simulated_stock", sql=with_adapter(RULES_SQL) + "SELECT * FROM stock_fx")
def simulated_stock(spark, sf_dir):
    return od.simulated_stock(fx.pos(spark, sf_dir).select("sku").distinct())


@query("default_stock", sql=with_adapter() + "SELECT DISTINCT sku, CAST(50 AS BIGINT) AS current_stock FROM pos")
def default_stock(spark, sf_dir):
    """No stock file exists, so every SKU gets the default level."""
    return store.load_stock(spark, None, fx.pos(spark, sf_dir).select("sku").distinct())


@query("apply_rules", sql=APPLY_SQL + "SELECT * FROM ar")
def apply_rules(spark, sf_dir):
    return applied_orders(spark, sf_dir)


GAPS_INPUT = AR_INPUT.replace("st.sku = f.sku", f"st.sku = f.sku AND {h('f.sku', '#nostock')} % 5 <> 0").replace(
    "r.sku = f.sku", f"r.sku = f.sku AND {h('f.sku', '#norule')} % 4 <> 0")


@query("apply_rules_gaps", sql=with_adapter(RULES_SQL, GAPS_INPUT, constrain_sql("ar_in")) + "SELECT * FROM ar")
def apply_rules_gaps(spark, sf_dir):
    """Some SKUs have no stock row (counts as none) and some no rule (raw forecast minus stock)."""
    _, rules, fc, stock, dem = rule_inputs(spark, sf_dir)
    return od.apply_rules(fc, stock.where(md5_mod(F.col("sku"), 5, "#nostock") != 0),
                          rules.where(md5_mod(F.col("sku"), 4, "#norule") != 0), dem)


@query("apply_rules_batch", sql=with_adapter(RULES_SQL, AR_INPUT, constrain_sql("ar_in", with_demand=False))
       + "SELECT sku, forecast_qty, final_qty AS final_order_qty, explanation AS rule_explanation FROM ar")
def apply_rules_batch(spark, sf_dir):
    pos, rules, fc, stock, _ = rule_inputs(spark, sf_dir)
    return od.apply_rules_batch(fc, stock, rules)


EDITS_SQL = f"""
edits AS (
  SELECT sku, 'perishability_days' AS field, 5.0 AS value, 1 AS edit_order FROM rules_d WHERE category = 'FOODS'
  UNION ALL SELECT sku, 'max_shelf_capacity', max_shelf_capacity + 100.0, 1 FROM rules_d WHERE category = 'HOBBIES'
  UNION ALL SELECT sku || '_GONE', 'unit_cost', 9.99, 1 FROM rules_d WHERE category = 'HOUSEHOLD'
  UNION ALL SELECT sku, 'max_shelf_capacity', CAST(max_shelf_capacity - 10 AS DOUBLE), 2 FROM rules_d
            WHERE category = 'HOBBIES' AND {h("sku", "#again")} % 2 = 0),
ed AS (SELECT sku, arg_max(value, edit_order) FILTER (WHERE field = 'max_shelf_capacity') AS e_cap,
              arg_max(value, edit_order) FILTER (WHERE field = 'unit_cost') AS e_cost,
              arg_max(value, edit_order) FILTER (WHERE field = 'perishability_days') AS e_days
       FROM edits GROUP BY sku)
"""


def rule_edits(rules):
    """Edits derived from the rules themselves, in the order they are made; the HOUSEHOLD ones name
    unknown SKUs, and some HOBBIES shelves are edited twice (the later, lower value counts)."""
    c = F.col("category")
    again = md5_mod(F.col("sku"), 2, "#again") == 0
    return (rules.where(c == "FOODS").select("sku", F.lit("perishability_days").alias("field"),
                                              F.lit(5.0).alias("value"), F.lit(1).alias("edit_order"))
            .unionByName(rules.where(c == "HOBBIES").select(
                "sku", F.lit("max_shelf_capacity").alias("field"),
                (F.col("max_shelf_capacity") + 100.0).alias("value"), F.lit(1).alias("edit_order")))
            .unionByName(rules.where((c == "HOBBIES") & again).select(
                "sku", F.lit("max_shelf_capacity").alias("field"),
                (F.col("max_shelf_capacity") - 10.0).alias("value"), F.lit(2).alias("edit_order")))
            .unionByName(rules.where(c == "HOUSEHOLD").select(
                F.concat("sku", F.lit("_GONE")).alias("sku"), F.lit("unit_cost").alias("field"),
                F.lit(9.99).alias("value"), F.lit(1).alias("edit_order"))))


@query("update_rules", sql=with_adapter(RULES_SQL, EDITS_SQL) + fin("""
SELECT r.sku, r.category, COALESCE(CAST(e.e_cap AS BIGINT), r.max_shelf_capacity) AS max_shelf_capacity,
       COALESCE(e.e_cost, r.unit_cost) AS unit_cost, r.max_budget_per_order,
       COALESCE(CAST(e.e_days AS BIGINT), r.perishability_days) AS perishability_days, r.safety_stock_days
FROM rules_d r LEFT JOIN ed e ON e.sku = r.sku""",
    ints=["max_shelf_capacity", "max_budget_per_order", "perishability_days", "safety_stock_days"],
    dbls=["unit_cost"], keep=["sku", "category"]))
def update_rules(spark, sf_dir):
    rules = od.derive_rules(fx.pos(spark, sf_dir))
    return od.update_rules(rules, rule_edits(rules))


ORDER_STATUS_SQL = """
st AS (SELECT *, CASE WHEN explanation LIKE '%Capped%' THEN 'capped' WHEN final_qty = 0 THEN 'sufficient_stock'
                      ELSE 'ok' END AS status FROM ar)
"""


@query("order_summary", sql=APPLY_SQL + "," + ORDER_STATUS_SQL + fin("""
SELECT sum(forecast_qty) AS total_forecast, sum(final_qty) AS total_order,
       count(*) FILTER (WHERE status = 'capped') AS capped_skus,
       count(*) FILTER (WHERE status = 'sufficient_stock') AS zero_skus, count(*) AS n_skus,
       CASE WHEN sum(forecast_qty) > 0 THEN (sum(forecast_qty) - sum(final_qty)) / sum(forecast_qty) * 100
            ELSE 0.0 END AS reduction_pct
FROM st""", ints=["total_forecast", "total_order", "capped_skus", "zero_skus", "n_skus"], dbls=["reduction_pct"]))
def order_summary(spark, sf_dir):
    return od.order_summary(applied_orders(spark, sf_dir))


@query("order_listing", sql=APPLY_SQL + "," + ORDER_STATUS_SQL + """
SELECT *, CAST(GREATEST((SELECT count(*) FROM st) - 30, 0) AS BIGINT) AS n_more FROM (
SELECT CAST(row_number() OVER (ORDER BY r, sku) AS BIGINT) AS listing_rank, sku, status, forecast_qty, final_qty
FROM (SELECT *, CASE status WHEN 'capped' THEN 0 WHEN 'ok' THEN 1 ELSE 2 END AS r FROM st)
ORDER BY r, sku LIMIT 30)""")
def order_listing(spark, sf_dir):
    return od.order_listing(applied_orders(spark, sf_dir), 30)


ECON_SQL = f"""
econ AS (
  SELECT sku, unit_cost, ROUND(unit_cost * (1.2::DOUBLE + {U.format(h('sku', '#markup'))} * 1.3::DOUBLE), 2)
         AS selling_price, CAST(10 + {h('sku')} % 90 AS BIGINT) AS current_stock
  FROM (SELECT sku, ROUND(5.0::DOUBLE + {U.format(h('sku', '#cost'))} * 45.0::DOUBLE, 2) AS unit_cost
        FROM (SELECT DISTINCT sku FROM pos)))
"""


@query("sku_economics", sql=with_adapter(ECON_SQL) + fin("SELECT * FROM econ", ints=["current_stock"],
                                                         dbls=["unit_cost", "selling_price"], keep=["sku"]))
def sku_economics(spark, sf_dir):
    return od.sku_economics(fx.pos(spark, sf_dir).select("sku").distinct())


@query("order_margins", sql=APPLY_SQL + "," + ECON_SQL + fin("""
SELECT a.sku, a.final_qty, e.unit_cost, e.selling_price, e.selling_price - e.unit_cost AS margin,
       a.final_qty * e.unit_cost AS line_cost
FROM ar a LEFT JOIN econ e ON e.sku = a.sku""", ints=["final_qty"],
    dbls=["unit_cost", "selling_price", "margin", "line_cost"], keep=["sku"]))
def order_margins(spark, sf_dir):
    orders = applied_orders(spark, sf_dir)
    return od.margins(orders, od.sku_economics(fx.pos(spark, sf_dir).select("sku").distinct()))


@query("rules_roundtrip", sql=with_adapter(RULES_SQL) + fin("""
SELECT sku, COALESCE(max_shelf_capacity, 100) AS max_shelf_capacity, COALESCE(unit_cost, 1.0) AS unit_cost,
       COALESCE(max_budget_per_order, 500) AS max_budget_per_order,
       COALESCE(CASE WHEN category = 'HOBBIES' THEN NULL ELSE perishability_days END, 30) AS perishability_days,
       COALESCE(safety_stock_days, 2) AS safety_stock_days
FROM rules_d""", ints=["max_shelf_capacity", "max_budget_per_order", "perishability_days", "safety_stock_days"],
    dbls=["unit_cost"], keep=["sku"]))
def rules_roundtrip(spark, sf_dir):
    """S12 then S11: write the rules as JSON lines (HOBBIES without a perishability
    field), read them back with per-field defaults."""
    rules = od.derive_rules(fx.pos(spark, sf_dir)).withColumn(
        "perishability_days", F.when(F.col("category") != "HOBBIES", F.col("perishability_days")))
    path = store.unique_path(spark, "rules_json")
    store.save_rules(rules, path)
    return store.load_rules(spark, path)


BUDGET_SQL = f"""
b_in AS (
  SELECT a.sku, a.forecast_qty, a.final_qty AS qty, a.explanation,
         CAST(ROUND(e.unit_cost * 100) AS BIGINT) AS cost_cents,
         CAST(ROUND(e.selling_price * 100) AS BIGINT) - CAST(ROUND(e.unit_cost * 100) AS BIGINT) AS margin_cents
  FROM ar a JOIN (SELECT * REPLACE (CASE WHEN {h("sku", "#free")} % 10 = 0 THEN 0.0 ELSE unit_cost END AS unit_cost)
                  FROM econ) e ON e.sku = a.sku),
b_rows AS (SELECT row_number() OVER (ORDER BY margin_cents DESC, sku) AS i, * FROM b_in),
b_total AS (SELECT CAST(sum(qty * cost_cents) AS BIGINT) * 2 // 5 AS b FROM b_rows),
rec AS (
  SELECT CAST(0 AS BIGINT) AS i, (SELECT b FROM b_total) AS rem, CAST(NULL AS VARCHAR) AS sku,
         CAST(NULL AS BIGINT) AS fq
  UNION ALL
  SELECT r.i, rec.rem - CASE WHEN r.cost_cents > 0 THEN LEAST(r.qty, rec.rem // r.cost_cents) * r.cost_cents ELSE 0 END,
         r.sku, CASE WHEN r.cost_cents > 0 THEN LEAST(r.qty, rec.rem // r.cost_cents) ELSE r.qty END
  FROM rec JOIN b_rows r ON r.i = rec.i + 1),
alloc AS (
  SELECT r.sku, r.forecast_qty, r.margin_cents / 100.0 AS margin, r.cost_cents / 100.0 AS unit_cost,
         r.qty AS base_order_qty, c.fq AS final_order_qty, c.fq * r.cost_cents / 100.0 AS total_sku_cost,
         CASE WHEN c.fq < r.qty THEN r.explanation || ' |  Reduced from ' || r.qty || ' to ' || c.fq
              || ' due to Budget Limit.' ELSE r.explanation END AS rule_applied,
         (SELECT b FROM b_total) / 100.0 AS budget
  FROM b_rows r JOIN rec c ON c.i = r.i)
"""


def budget_allocation(spark, sf_dir):
    orders = applied_orders(spark, sf_dir)
    econ = od.sku_economics(fx.pos(spark, sf_dir).select("sku").distinct())
    free = md5_mod(F.col("sku"), 10, "#free") == 0             # some lines cost nothing (Q11)
    return bg.global_budget(orders, econ.withColumn("unit_cost", F.when(free, 0.0).otherwise(F.col("unit_cost"))))


@query("global_budget", sql=APPLY_SQL + "," + ECON_SQL + "," + BUDGET_SQL + fin(
    "SELECT * FROM alloc", ints=["forecast_qty", "base_order_qty", "final_order_qty"],
    dbls=["margin", "unit_cost", "total_sku_cost", "budget"], keep=["sku", "rule_applied"]))
def global_budget(spark, sf_dir):
    return budget_allocation(spark, sf_dir)


@query("budget_summary", sql=APPLY_SQL + "," + ECON_SQL + "," + BUDGET_SQL + fin("""
SELECT sum(forecast_qty) AS total_forecast, sum(final_order_qty) AS total_order,
       sum(CAST(ROUND(total_sku_cost * 100) AS BIGINT)) / 100.0 AS total_spent,
       (max(CAST(ROUND(budget * 100) AS BIGINT)) - sum(CAST(ROUND(total_sku_cost * 100) AS BIGINT))) / 100.0
         AS remaining_budget,
       CASE WHEN sum(forecast_qty) > 0 THEN (sum(forecast_qty) - sum(final_order_qty)) / sum(forecast_qty) * 100
            ELSE 0.0 END AS reduction_pct
FROM alloc""", ints=["total_forecast", "total_order"], dbls=["total_spent", "remaining_budget", "reduction_pct"]))
def budget_summary(spark, sf_dir):
    return bg.budget_summary(budget_allocation(spark, sf_dir))


# ------------------------------------------------------------------ A9 / A10 summaries
def _summary_sql(select: str) -> str:
    from shelfcast.plans.q_drift import RES_SQL
    from shelfcast.plans.q_explore import BASE_SQL
    from shelfcast.plans.q_forecast import ADWIN_REC_SQL, DDM_REC_SQL, REPLAY_TAIL, VERDICT_SQL
    head = with_adapter(RULES_SQL, AR_INPUT, constrain_sql("ar_in"), BASE_SQL, RES_SQL)
    return head + DDM_REC_SQL + ADWIN_REC_SQL + REPLAY_TAIL + VERDICT_SQL + select


@query("run_summary", sql=_summary_sql(fin("""
SELECT (SELECT count(*) FROM pos) AS n_records, (SELECT count(DISTINCT sku) FROM pos) AS n_skus,
       (SELECT count(*) FROM (SELECT sku FROM pos GROUP BY sku HAVING count(*) >= 50)) AS models_trained, (SELECT count(*) FILTER (WHERE drift) FROM ds) AS drift_skus,
       (SELECT sum(forecast_qty) FROM ar) AS total_forecast, (SELECT sum(final_qty) FROM ar) AS total_order,
       (SELECT CASE WHEN sum(forecast_qty) > 0 THEN (sum(forecast_qty) - sum(final_qty)) / sum(forecast_qty) * 100
               ELSE 0.0 END FROM ar) AS order_reduction_pct""",
    ints=["n_records", "n_skus", "models_trained", "drift_skus", "total_forecast", "total_order"],
    dbls=["order_reduction_pct"])))
def run_summary(spark, sf_dir):
    """Records, SKUs, models in the model table, drifted SKUs, order totals and reduction."""
    from shelfcast.functions.scalars import combine_scalars
    from shelfcast.operators import drift as dr
    from shelfcast.operators import drift_replay as rp
    from shelfcast.operators import explore as ex
    from shelfcast.plans.q_drift import residuals_df
    from shelfcast.plans.q_forecast import model_averages_of, trained
    ov = ex.overview(fx.pos(spark, sf_dir)).select("n_records", "n_skus")
    tr = model_averages_of(trained(spark, sf_dir)[1]).select("models_trained")
    dc = dr.drift_counts(rp.last_verdicts(residuals_df(spark, sf_dir))).select("drift_skus")
    os_ = od.order_summary(applied_orders(spark, sf_dir)).select(
        "total_forecast", "total_order", F.col("reduction_pct").alias("order_reduction_pct"))
    return combine_scalars(ov, tr, dc, os_)


@query("metrics_dashboard", sql=_summary_sql(fin("""
SELECT (SELECT avg(mae) FROM bm) AS baseline_mae, (SELECT avg(rmse) FROM bm) AS baseline_rmse,
       (SELECT avg(r2) FROM bm) AS baseline_r2, (SELECT avg(mean_residual) FROM ds) AS avg_mean_residual,
       (SELECT avg(std_residual) FROM ds) AS avg_std_residual,
       (SELECT count(*) FILTER (WHERE explanation LIKE '%Capped%') FROM ar) AS capped_skus,
       (SELECT avg(final_qty) FROM ar) AS avg_order_qty""",
    ints=["capped_skus"], dbls=["baseline_mae", "baseline_rmse", "baseline_r2", "avg_mean_residual", "avg_std_residual",
                                "avg_order_qty"])))
def metrics_dashboard(spark, sf_dir):
    """A10: averages of the rolling-mean baseline, residuals and orders (one row); ``model_averages`` has those of the models."""
    from shelfcast.functions.scalars import combine_scalars
    from shelfcast.operators import drift as dr
    from shelfcast.operators import drift_replay as rp
    from shelfcast.plans.q_drift import residuals_df
    from shelfcast.plans.q_explore import baseline_metrics_df
    m = baseline_metrics_df(spark, sf_dir).agg(F.avg("mae").alias("baseline_mae"), F.avg("rmse").alias("baseline_rmse"),
                                               F.avg("r2").alias("baseline_r2"))
    d = dr.drift_counts(rp.last_verdicts(residuals_df(spark, sf_dir))).select("avg_mean_residual",
                                                                              "avg_std_residual")
    o = applied_orders(spark, sf_dir).agg(F.count_if(F.col("explanation").contains("Capped")).alias("capped_skus"),
                                          F.avg("final_qty").alias("avg_order_qty"))
    return combine_scalars(m, d, o)
