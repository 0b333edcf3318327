"""Registered queries: drift detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import drift as dr
from shelfcast.plans.oracle_base import fin, h, with_adapter
from shelfcast.plans.q_features import features_df
from shelfcast.plans.registry import query

RUN = "PARTITION BY sku ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
RES_DEF = f"""
res_base AS (
  SELECT sku, date, units_sold,
         COALESCE(avg(units_sold) OVER (PARTITION BY sku ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0)
           AS predicted,
         row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rd FROM pos),
res AS (
  SELECT sku, date, CAST(count(*) OVER (PARTITION BY sku) - rd + 1 AS BIGINT) AS n,
         CAST(units_sold + CASE WHEN {h('sku')} % 4 = 0 AND rd <= 40 THEN 60 ELSE 0 END AS DOUBLE) AS actual,
         predicted,
         CAST(units_sold + CASE WHEN {h('sku')} % 4 = 0 AND rd <= 40 THEN 60 ELSE 0 END AS DOUBLE) - predicted
           AS residual
  FROM res_base WHERE rd <= 100),
"""
DETECT_SQL = f"""
be AS (
  SELECT *, abs(residual) AS abs_residual, avg(abs(residual)) OVER ({RUN}) AS running_mae FROM res),
be2 AS (SELECT *, CAST(abs_residual > running_mae AS INTEGER) AS binary_error FROM be),
dd AS (SELECT *, avg(binary_error) OVER ({RUN}) AS p FROM be2),
dd2 AS (SELECT *, sqrt(p * (1 - p) / n) AS s FROM dd),
dd3 AS (
  SELECT *, arg_min(CASE WHEN n >= 30 THEN {{'bp': p, 'bs': s}} END,
                    CASE WHEN n >= 30 THEN {{'k': p + s, 'kn': n}} END) OVER ({RUN}) AS best FROM dd2),
ddm AS (
  SELECT *, CAST(n >= 30 AND p + s > best.bp + 3 * best.bs AS INTEGER) AS ddm_drift,
         CAST(n >= 30 AND NOT (p + s > best.bp + 3 * best.bs) AND p + s > best.bp + 2 * best.bs AS INTEGER)
           AS ddm_warning FROM dd3),
sv AS (
  SELECT *, sum(abs(residual)) OVER (PARTITION BY sku ORDER BY n ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rs,
         count(*) OVER (PARTITION BY sku ORDER BY n ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rc,
         sum(abs(residual)) OVER ({RUN}) AS cs,
         sum(CASE WHEN n <= 7 THEN abs(residual) END) OVER (PARTITION BY sku) AS f7 FROM ddm),
sv2 AS (SELECT *, CASE WHEN n > 14 THEN (cs - rs) / (n - 7) ELSE f7 / LEAST(n, 7) END AS base0 FROM sv),
sv3 AS (SELECT *, CASE WHEN base0 = 0 THEN rs / rc ELSE base0 END AS base FROM sv2),
sev AS (
  SELECT *, CASE WHEN n < 10 THEN 0.5 ELSE
           ROUND(LEAST(1.0, GREATEST(0.0, ((CASE WHEN base <> 0 THEN (rs / rc) / base ELSE 1.0 END) - 1) / 2)), 2)
         END AS severity_score, rs / rc AS recent_mae FROM sv3)
"""
RES_SQL = RES_DEF + DETECT_SQL
DRIFT = with_adapter(RES_SQL)

# The same detector chain over the ``events`` table (the streaming monitor's input):
# sku = user, predictor = running mean of earlier values, ordered by (ts, event_id).
EVENTS_RES_DEF = """
res AS (
  SELECT CAST(user_id AS VARCHAR) AS sku, event_id, CAST(ts AS TIMESTAMP) AS ts,
         CAST(row_number() OVER w AS BIGINT) AS n, value AS actual,
         COALESCE(avg(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS predicted,
         value - COALESCE(avg(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS residual
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
"""
EVENTS_DRIFT = with_adapter(EVENTS_RES_DEF + DETECT_SQL)


def residuals_df(spark, sf_dir):
    """Residuals over the stored feature table: its buckets serve every window on ``sku``."""
    return dr.residual_series(features_df(spark, sf_dir, for_training=True))


@query("residuals", sql=DRIFT + fin("SELECT sku, date, n, actual, predicted, residual FROM res", ints=["n"],
                                    dbls=["actual", "predicted", "residual"], keep=["sku", "date"]))
def residuals(spark, sf_dir):
    return residuals_df(spark, sf_dir)


@query("binary_errors", sql=DRIFT + fin("SELECT sku, n, abs_residual, running_mae, binary_error FROM be2",
                                        ints=["n", "binary_error"], dbls=["abs_residual", "running_mae"],
                                        keep=["sku"]))
def binary_errors(spark, sf_dir):
    return dr.binary_errors(residuals_df(spark, sf_dir)).select("sku", "n", "abs_residual", "running_mae",
                                                                "binary_error")


@query("ddm_first_detection", sql=DRIFT + """
SELECT sku, CAST(min(n) AS BIGINT) AS first_n FROM ddm WHERE ddm_drift = 1 GROUP BY sku""")
def ddm_first_detection(spark, sf_dir):
    d = dr.ddm_no_reset(residuals_df(spark, sf_dir))
    return d.where(F.col("ddm_drift") == 1).groupBy("sku").agg(F.min("n").alias("first_n"))


@query("ddm_levels", sql=DRIFT + fin("""
SELECT sku, n, p, s, best.bp AS p_min, best.bs AS s_min, ddm_drift, ddm_warning FROM ddm""",
    ints=["n", "ddm_drift", "ddm_warning"], dbls=["p", "s", "p_min", "s_min"], keep=["sku"]))
def ddm_levels(spark, sf_dir):
    d = dr.ddm_no_reset(residuals_df(spark, sf_dir))
    return d.select("sku", "n", "p", "s", F.col("best.bp").alias("p_min"), F.col("best.bs").alias("s_min"),
                    "ddm_drift", "ddm_warning")


@query("severity_scores", sql=DRIFT + fin("SELECT sku, n, severity_score, recent_mae FROM sev", ints=["n"],
                                          dbls=["severity_score", "recent_mae"], keep=["sku"]))
def severity_scores(spark, sf_dir):
    return dr.with_severity(residuals_df(spark, sf_dir)).select("sku", "n", "severity_score", "recent_mae")


@query("residual_stats", sql=DRIFT + fin("""
SELECT sku, avg(residual) AS mean_residual, stddev_pop(residual) AS std_residual, avg(abs(residual)) AS mae,
       count(*) AS n_obs FROM res GROUP BY sku""", ints=["n_obs"], dbls=["mean_residual", "std_residual", "mae"],
    keep=["sku"]))
def residual_stats(spark, sf_dir):
    return dr.residual_stats(residuals_df(spark, sf_dir))


KS_SQL = """,
snap AS (
  SELECT sku, 'actual' AS feature, CASE WHEN n <= 50 THEN 'before' ELSE 'after' END AS side, actual AS value FROM res
  UNION ALL
  SELECT sku, 'predicted', CASE WHEN n <= 50 THEN 'before' ELSE 'after' END, predicted FROM res),
kc AS (SELECT sku, feature, value, count(*) FILTER (WHERE side = 'before') AS c1,
              count(*) FILTER (WHERE side = 'after') AS c2 FROM snap GROUP BY sku, feature, value),
kd AS (
  SELECT sku, feature, sum(c1) OVER g AS n1, sum(c2) OVER g AS n2,
         abs(sum(c1) OVER r / NULLIF(sum(c1) OVER g, 0) - sum(c2) OVER r / NULLIF(sum(c2) OVER g, 0)) AS d
  FROM kc WINDOW g AS (PARTITION BY sku, feature),
                 r AS (PARTITION BY sku, feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


@query("ks_statistic", sql=DRIFT + KS_SQL + fin("""
SELECT sku, feature, min(n1) AS n_before, min(n2) AS n_after, max(d) AS ks_statistic FROM kd GROUP BY sku, feature""",
    ints=["n_before", "n_after"], dbls=["ks_statistic"], keep=["sku", "feature"]))
def ks_statistic(spark, sf_dir):
    return dr.ks_statistic(dr.feature_snapshots(residuals_df(spark, sf_dir)))


@query("ks_pooled", sql=DRIFT + KS_SQL + fin("""
SELECT feature, max(n1) AS n_before, max(n2) AS n_after, max(d) AS ks_statistic FROM (
  SELECT feature, sum(c1) OVER g AS n1, sum(c2) OVER g AS n2,
         abs(sum(c1) OVER r / sum(c1) OVER g - sum(c2) OVER r / sum(c2) OVER g) AS d
  FROM (SELECT feature, value, sum(c1) AS c1, sum(c2) AS c2 FROM kc GROUP BY feature, value)
  WINDOW g AS (PARTITION BY feature), r AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
GROUP BY feature""", ints=["n_before", "n_after"], dbls=["ks_statistic"], keep=["feature"]))
def ks_pooled(spark, sf_dir):
    """D10 over the whole portfolio: one statistic a feature, by distributed running sums."""
    return dr.ks_statistic_pooled(dr.feature_snapshots(residuals_df(spark, sf_dir)))


def ks_tests(spark, sf_dir):
    return ks_tests_by(spark, sf_dir, "exact")


def ks_tests_by(spark, sf_dir, method):
    return dr.ks_tests(dr.ks_statistic(dr.feature_snapshots(residuals_df(spark, sf_dir))), method)


# Exact two-sided KS p-value as a lattice-path walk, one cell per recursion step, with the
# same operation order as functions/ks.py (so the doubles agree bit for bit).
KS_P_SQL = """,
ks_base AS (SELECT sku, feature, min(n1) AS n_before, min(n2) AS n_after, max(d) AS ks_statistic
            FROM kd GROUP BY sku, feature),
ks_gp AS (
  SELECT sku, feature, CAST(n_before AS BIGINT) AS n1, CAST(n_after AS BIGINT) AS n2,
         CAST(n_before + n_after AS BIGINT) AS tot,
         CAST(round(ks_statistic * (n_before // gcd(CAST(n_before AS BIGINT), CAST(n_after AS BIGINT)) * n_after))
              AS BIGINT) * gcd(CAST(n_before AS BIGINT), CAST(n_after AS BIGINT)) AS bound
  FROM ks_base WHERE n_before >= 5 AND n_after >= 5 AND ks_statistic IS NOT NULL),
lat AS (
  SELECT sku, feature, n1, n2, tot, bound, CAST(0 AS BIGINT) AS i, CAST(1 AS BIGINT) AS j,
         CAST([] AS DOUBLE[]) AS prev, [1.0::DOUBLE] AS cur
  FROM ks_gp WHERE bound > 0
  UNION ALL
  SELECT sku, feature, n1, n2, tot, bound, CASE WHEN j = n2 THEN i + 1 ELSE i END,
         CASE WHEN j = n2 THEN 0 ELSE j + 1 END,
         CASE WHEN j = n2 THEN list_append(cur, v) ELSE prev END,
         CASE WHEN j = n2 THEN CAST([] AS DOUBLE[]) ELSE list_append(cur, v) END
  FROM (
    SELECT *, CASE WHEN abs(i * n2 - j * n1) < bound THEN
                (CASE WHEN i > 0 THEN prev[j + 1] * (n1 - i + 1) / greatest(tot - (i - 1) - j, 1) ELSE 0.0 END)
                + (CASE WHEN j > 0 THEN cur[j] * (n2 - j + 1) / (tot - i - (j - 1)) ELSE 0.0 END)
              ELSE 0.0 END AS v
    FROM lat WHERE i <= n1) x),
ks_exact AS (SELECT sku, feature, least(1.0, greatest(0.0, 1 - prev[n2 + 1])) AS p FROM lat
             WHERE i = n1 + 1 AND j = 0),
ks_asym AS (
  SELECT sku, feature, CASE WHEN lam < 1e-3 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(
           list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END)
                                                   * exp(-2 * k * k * lam * lam))))) END AS p
  FROM (SELECT g.sku, g.feature, b.ks_statistic * sqrt(g.n1 * g.n2 / (g.n1 + g.n2)) AS lam
        FROM ks_gp g JOIN ks_base b ON b.sku = g.sku AND b.feature = g.feature)),
ks AS (
  SELECT b.sku, b.feature, b.n_before, b.n_after, b.ks_statistic, COALESCE(e.p, 1.0) AS p_raw, 'exact' AS method
  FROM ks_base b LEFT JOIN ks_exact e ON e.sku = b.sku AND e.feature = b.feature),
ks_out AS (
  SELECT sku, feature, n_before, n_after, round(ks_statistic, 4) AS ks_statistic, round(p_raw, 4) AS p_value,
         p_raw < 0.05 AS drift_detected,
         CASE WHEN n_before < 5 OR n_after < 5 OR ks_statistic IS NULL THEN 'Insufficient data'
              ELSE printf('%s: %s (p=%.4f)', feature, CASE WHEN p_raw < 0.05 THEN 'Drift detected'
                                                             ELSE 'No drift' END, p_raw) END AS message, method
  FROM ks)
"""


@query("ks_test", sql=DRIFT + KS_SQL + KS_P_SQL + fin(
    "SELECT * FROM ks_out", ints=["n_before", "n_after"], dbls=["ks_statistic", "p_value"],
    keep=["sku", "feature", "drift_detected", "message", "method"]))
def ks_test(spark, sf_dir):
    """D10 with exact p-values (an Arrow pandas UDF; the oracle walks the same lattice in SQL)."""
    return ks_tests(spark, sf_dir)


KS_ASYM_SQL = KS_P_SQL.replace("ks_exact e ON", "ks_asym e ON").replace("'exact' AS method", "'asymptotic' AS method")


@query("ks_test_asymptotic", sql=DRIFT + KS_SQL + KS_ASYM_SQL + fin(
    "SELECT * FROM ks_out", ints=["n_before", "n_after"], dbls=["ks_statistic", "p_value"],
    keep=["sku", "feature", "drift_detected", "message", "method"]))
def ks_test_asymptotic(spark, sf_dir):
    """D10 by the Kolmogorov series, the caller's other method."""
    return ks_tests_by(spark, sf_dir, "asymptotic")
