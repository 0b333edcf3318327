"""Registered queries: model training, scoring and retraining (M1-M20), drift replay.

Trained models have no SQL twin (the learner runs in Python workers): the queries
that return their numbers carry no oracle, and the *_audit queries return what
SQL can state about them (samples, versions, dates, soundness).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import drift as dr
from shelfcast.operators import drift_replay as rp
from shelfcast.operators import features as fe
from shelfcast.operators import forecast as fc
from shelfcast.operators import history as hi
from shelfcast.operators.orders import tail_rows
from shelfcast.plans import q_drift
from shelfcast.plans.q_features import features_df
from shelfcast.plans.oracle_base import fin, with_adapter
from shelfcast.plans.q_explore import BASE_SQL
from shelfcast.plans.registry import query
from shelfcast.sources import fixture as fx
from shelfcast.sources import store
from shelfcast.sources.materialize import bucketed
from shelfcast.sources.tables import table_path

METRIC_COLS = ["sku", "n_rows", "train_samples", "val_samples", "best_iteration", "mae", "rmse", "r2", "mape",
               "error", "version", "status"]


def trained(spark, sf_dir):
    """The feature table and the stored models of the first training run (S10, S15): fitted once per input.

    Both are bucketed by ``sku`` alike, so scoring cogroups them without an exchange.
    """
    feats = features_df(spark, sf_dir, for_training=True)
    models = bucketed(spark, "models", [table_path(sf_dir, t) for t in fx.SKU_INPUTS],
                      lambda n: fc.train_models(feats, fe.FEATURE_COLUMNS), "sku", ("sku",))
    return feats, models


@query("train_metrics")
def train_metrics(spark, sf_dir):
    """M1/M2/M4/M6/M7/M8: one row per SKU; those with under 50 rows give the reason."""
    _, models = trained(spark, sf_dir)
    return models.select(*METRIC_COLS)


@query("train_predict")
def train_predict(spark, sf_dir):
    """In-sample and hold-out predictions for every trained SKU, or why its model could not be read."""
    feats, models = trained(spark, sf_dir)
    return fc.score(feats, models).select("sku", "date", "actual", "predicted", "split", "error")


@query("predict_tail")
def predict_tail(spark, sf_dir):
    """The last 7 observed rows of each SKU scored, with the model version."""
    feats, models = trained(spark, sf_dir)
    return fc.predict_tail(feats, models, 7)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """M13."""
    _, models = trained(spark, sf_dir)
    return fc.feature_importance(models)


@query("cv_fold_metrics")
def cv_fold_metrics(spark, sf_dir):
    """M5: three expanding-window folds per SKU, each scored."""
    return fc.cv_fold_metrics(features_df(spark, sf_dir, for_training=True), fe.FEATURE_COLUMNS)


@query("model_store")
def model_store(spark, sf_dir):
    """Write the model table, read it back and score the tail from the stored models."""
    feats, models = trained(spark, sf_dir)
    path = store.unique_path(spark, "models")
    store.write_table(models, path)
    loaded = spark.read.parquet(path)
    return fc.predict_tail(feats, loaded, 7)


@query("retrain_drifted")
def retrain_drifted(spark, sf_dir):
    """Retrain the SKUs whose last verdict is a drift on the merged history;
    versions continue from the first training run."""
    feats, models = trained(spark, sf_dir)
    drifted = rp.last_verdicts(q_drift.residuals_df(spark, sf_dir)).where("drift").select("sku")
    new = fc.retrain_subset(feats, drifted, fe.FEATURE_COLUMNS, prior=models)
    return new.select(*METRIC_COLS)


@query("model_drift_check")
def model_drift_check(spark, sf_dir):
    """D1 with the trained model: last 100 (actual, predicted) pairs per SKU replayed
    through ADWIN + DDM, then the per-SKU verdict (D11/D13/D14)."""
    feats, models = trained(spark, sf_dir)
    s = fc.score(tail_rows(feats, dr.MONITOR_ROWS), models)       # a prediction takes its own row only
    return rp.drift_check(rp.replay(rp_last100(s)))


def rp_last100(scored):
    from pyspark.sql import Window
    w = Window.partitionBy("sku").orderBy(F.col("date").desc())
    t = scored.where("error IS NULL").withColumn("_rd", F.row_number().over(w)).where(F.col("_rd") <= dr.MONITOR_ROWS)
    cnt = F.count(F.lit(1)).over(Window.partitionBy("sku"))
    return t.select("sku", "date", (cnt - F.col("_rd") + 1).cast("bigint").alias("n"), "actual", "predicted",
                    (F.col("actual") - F.col("predicted")).alias("residual"))


# ----------------------------------------------------------------- history
HIST_SQL = BASE_SQL.replace("bm AS (", "bm_unused AS (") + """,
runs AS (
  SELECT sku, v AS version, avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) ^ 2)) AS rmse,
         CASE WHEN var_pop(actual) * count(*) = 0 THEN CASE WHEN sum((actual - predicted) ^ 2) = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1 - sum((actual - predicted) ^ 2) / (var_pop(actual) * count(*)) END AS r2,
         avg(abs(actual - predicted) / GREATEST(actual, 1)) * 100 AS mape, max(date) AS trained_at,
         count(*) AS training_samples
  FROM (SELECT s.*, v.v FROM scored s JOIN (VALUES (1), (2), (3)) v(v)
          ON s.rn <= CAST(floor(s.n * v.v / 3.0) AS BIGINT))
  WHERE n >= 50 GROUP BY sku, v)
"""


def history_runs(spark, sf_dir):
    from shelfcast.plans.q_explore import baseline_scored
    return hi.expanding_runs(baseline_scored(spark, sf_dir), runs=3)


@query("sku_history", sql=with_adapter(HIST_SQL) + fin(
    "SELECT sku, version, mae, rmse, r2, mape, training_samples, trained_at FROM runs",
    ints=["version", "training_samples"], dbls=["mae", "rmse", "r2", "mape"], keep=["sku", "trained_at"]))
def sku_history(spark, sf_dir):
    """Metric snapshots of three successive runs per SKU (versions 1..3)."""
    return history_runs(spark, sf_dir).select("sku", "version", "mae", "rmse", "r2", "mape", "training_samples", "trained_at")


@query("improvement_report", sql=with_adapter(HIST_SQL) + fin("""
SELECT sku, CAST(count(*) AS BIGINT) AS versions_trained, arg_min(mae, version) AS initial_mae,
       arg_max(mae, version) AS current_mae,
       ROUND(CASE WHEN arg_min(mae, version) <> 0
             THEN (arg_min(mae, version) - arg_max(mae, version)) / arg_min(mae, version) * 100 ELSE 0 END, 2)
         AS mae_improvement_pct,
       count(*) >= 2 AND CASE WHEN arg_min(mae, version) <> 0
             THEN (arg_min(mae, version) - arg_max(mae, version)) / arg_min(mae, version) * 100 ELSE 0 END > 0
         AS improved,
       CASE WHEN count(*) < 2 THEN 'Insufficient history'
            WHEN CASE WHEN arg_min(mae, version) <> 0
                 THEN (arg_min(mae, version) - arg_max(mae, version)) / arg_min(mae, version) * 100 ELSE 0 END > 0
            THEN printf('MAE improved by %.1f%%', (arg_min(mae, version) - arg_max(mae, version))
                        / arg_min(mae, version) * 100)
            ELSE 'Model needs more data' END AS message
FROM runs GROUP BY sku""", ints=["versions_trained"], dbls=["initial_mae", "current_mae", "mae_improvement_pct"],
    keep=["sku", "improved", "message"]))
def improvement_report(spark, sf_dir):
    """M18/M20."""
    return hi.improvement_report(history_runs(spark, sf_dir))


@query("history_store", sql=with_adapter(HIST_SQL) + fin(
    "SELECT sku, version, mae, rmse, r2, mape, training_samples, trained_at FROM runs",
    ints=["version", "training_samples"], dbls=["mae", "rmse", "r2", "mape"], keep=["sku", "trained_at"]))
def history_store(spark, sf_dir):
    """Append each run's snapshot to a history table; versions continue per SKU."""
    runs = history_runs(spark, sf_dir)
    path = store.unique_path(spark, "metric_history")
    out = None
    for v in (1, 2, 3):
        batch = runs.where(F.col("version") == v).drop("version").withColumn("run_order", F.lit(v))
        out = store.append_history(spark, path, batch)
    return out.select("sku", "version", "mae", "rmse", "r2", "mape", "training_samples", "trained_at")


DDM_REC_SQL = """,
ddm_in AS (SELECT sku, n, binary_error AS e FROM be2),
rec AS (
  SELECT sku, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS k, 0.0::DOUBLE AS p, 0.0::DOUBLE AS s,
         'inf'::DOUBLE AS pmin, 'inf'::DOUBLE AS smin, false AS drift, false AS warn
  FROM (SELECT DISTINCT sku FROM ddm_in)
  UNION ALL
  SELECT sku, n, CASE WHEN drift THEN 0 ELSE k1 END, CASE WHEN drift THEN 0.0 ELSE p1 END,
         CASE WHEN drift THEN 0.0 ELSE s1 END, CASE WHEN drift THEN 'inf'::DOUBLE ELSE pmin2 END,
         CASE WHEN drift THEN 'inf'::DOUBLE ELSE smin2 END, drift,
         NOT drift AND k1 >= 30 AND p1 + s1 > pmin2 + 2 * smin2
  FROM (
    SELECT *, k1 >= 30 AND p1 + s1 > pmin2 + 3 * smin2 AS drift FROM (
      SELECT *, CASE WHEN k1 >= 30 AND p1 + s1 < pmin + smin THEN p1 ELSE pmin END AS pmin2,
                CASE WHEN k1 >= 30 AND p1 + s1 < pmin + smin THEN s1 ELSE smin END AS smin2 FROM (
        SELECT *, sqrt(p1 * (1 - p1) / k1) AS s1 FROM (
          SELECT r.sku, i.n, r.k + 1 AS k1, r.p + (i.e - r.p) / (r.k + 1) AS p1, r.pmin, r.smin
          FROM rec r JOIN ddm_in i ON i.sku = r.sku AND i.n = r.n + 1) a) b) c) d)
"""


@query("ddm_replay", sql=q_drift.DRIFT + DDM_REC_SQL + """
SELECT sku, n, CAST(drift AS BIGINT) AS ddm_drift, CAST(warn AS BIGINT) AS ddm_warning FROM rec WHERE n > 0""")
def ddm_replay(spark, sf_dir):
    """D3 with resets (the online detector), per observation; oracle: a recursive CTE."""
    return rp.ddm_trace(q_drift.residuals_df(spark, sf_dir))


@query("pooled_model_metrics")
def pooled_model_metrics(spark, sf_dir):
    """M6 (pooled Spark ML GBT) + M7: per-SKU hold-out metrics of one model over all SKUs."""
    from shelfcast.operators.evaluate import holdout_metrics
    feats = features_df(spark, sf_dir).checkpoint(eager=True)
    model, data = fc.train_pooled(feats, fe.FEATURE_COLUMNS)
    return holdout_metrics(fc.score_pooled(model, data).drop("split"))


ADWIN_SPLIT = ("list_filter(range(10, len(w2) - 10), lambda s: "
               "sqrt((list_var_pop(w2[1:s]) + list_var_pop(w2[s + 1:len(w2)])) / 2) > 0 "
               "AND abs(list_avg(w2[1:s]) - list_avg(w2[s + 1:len(w2)])) "
               "/ sqrt((list_var_pop(w2[1:s]) + list_var_pop(w2[s + 1:len(w2)])) / 2) "
               "> sqrt(2 * ln(2 / 0.002) / least(s, len(w2) - s)))[1]")
ADWIN_REC_SQL = f""",
adw_in AS (SELECT sku, n, abs(residual) AS v FROM res),
adw AS (
  SELECT sku, CAST(0 AS BIGINT) AS n, CAST([] AS DOUBLE[]) AS w, false AS hit, CAST(0 AS BIGINT) AS wlen
  FROM (SELECT DISTINCT sku FROM adw_in)
  UNION ALL
  SELECT sku, n, CASE WHEN fs IS NOT NULL THEN w2[fs + 1:len(w2)]
                      WHEN len(w2) > 200 THEN w2[len(w2) - 99:len(w2)] ELSE w2 END,
         fs IS NOT NULL,
         len(CASE WHEN fs IS NOT NULL THEN w2[fs + 1:len(w2)]
                  WHEN len(w2) > 200 THEN w2[len(w2) - 99:len(w2)] ELSE w2 END)
  FROM (SELECT *, CASE WHEN len(w2) < 20 THEN NULL ELSE {ADWIN_SPLIT} END AS fs
        FROM (SELECT a.sku, i.n, list_append(a.w, i.v) AS w2
              FROM adw a JOIN adw_in i ON i.sku = a.sku AND i.n = a.n + 1) x) y)
"""


@query("adwin_replay", sql=q_drift.DRIFT + ADWIN_REC_SQL + """
SELECT sku, n, CAST(hit AS BIGINT) AS adwin_drift, wlen AS window_len FROM adw WHERE n > 0""")
def adwin_replay(spark, sf_dir):
    """D2 per observation (drift flag and window length after the update); oracle: a
    recursive CTE carrying the window as a list."""
    res = q_drift.residuals_df(spark, sf_dir).select("sku", "n", "residual")
    return rp.adwin_trace(res)


REPLAY_TAIL = """,
rp AS (
  SELECT r.sku, r.n, r.residual, a.hit AS adwin_drift, d.drift AS ddm_drift, d.warn AS ddm_warning,
         a.hit OR d.drift AS drift_detected,
         CASE WHEN a.hit AND d.drift THEN ['ADWIN', 'DDM'] WHEN a.hit THEN ['ADWIN'] WHEN d.drift THEN ['DDM']
              ELSE CAST([] AS VARCHAR[]) END AS detectors,
         CASE WHEN a.hit OR d.drift THEN v.severity_score ELSE 0.0 END AS severity,
         v.recent_mae
  FROM res r JOIN adw a ON a.sku = r.sku AND a.n = r.n JOIN rec d ON d.sku = r.sku AND d.n = r.n
       JOIN sev v ON v.sku = r.sku AND v.n = r.n),
rp2 AS (
  SELECT *, CASE WHEN drift_detected THEN printf('Drift detected by %s. Recent MAE: %.2f',
                                                 array_to_string(detectors, ', '), recent_mae)
                 ELSE '' END AS message FROM rp)
"""
REPLAY_SQL = q_drift.DRIFT + DDM_REC_SQL + ADWIN_REC_SQL + REPLAY_TAIL
EVENTS_REPLAY_SQL = q_drift.EVENTS_DRIFT + DDM_REC_SQL + ADWIN_REC_SQL + REPLAY_TAIL


@query("drift_replay", sql=REPLAY_SQL + fin(
    "SELECT * FROM rp2", ints=["n"], dbls=["residual", "severity"],
    keep=["sku", "adwin_drift", "ddm_drift", "ddm_warning", "drift_detected", "detectors", "message"]))
def drift_replay(spark, sf_dir):
    """Per-observation verdicts of the full detectors (with resets)."""
    return rp.replay(q_drift.residuals_df(spark, sf_dir))


@query("drift_events", sql=REPLAY_SQL + fin(
    "SELECT p.*, r.date FROM rp2 p JOIN res r ON r.sku = p.sku AND r.n = p.n WHERE p.drift_detected", ints=["n"], dbls=["severity"],
    keep=["sku", "date", "detectors", "message"]))
def drift_events(spark, sf_dir):
    """D8, each event with the date of its observation."""
    return rp.drift_events(rp.replay(q_drift.residuals_df(spark, sf_dir), keep=("date",)), "date")


DRIFT_CHECK_SQL = """
SELECT s.sku, x.lv.d OR COALESCE(k.in_d, false) AS drift_detected, x.lv.s AS severity,
       CASE WHEN len(x.lv.det) > 0 THEN array_to_string(x.lv.det, ', ') ELSE '—' END AS detectors,
       x.lv.m AS message,
       CASE WHEN x.lv.d AND x.lv.s >= 0.5 THEN 'HIGH' WHEN x.lv.d OR COALESCE(k.in_d, false) THEN 'MEDIUM'
            WHEN x.lv.w THEN 'LOW' ELSE 'NONE' END AS label,
       x.drift_events, s.mean_residual, s.std_residual, s.mae, s.n_obs,
       COALESCE(k.input_drift, CAST([] AS VARCHAR[])) AS input_drift
FROM (SELECT sku, arg_max({'d': drift_detected, 's': severity, 'det': detectors, 'm': message, 'w': ddm_warning}, n)
             AS lv, count(*) FILTER (WHERE drift_detected) AS drift_events FROM rp2 GROUP BY sku) x
     JOIN (SELECT sku, avg(residual) AS mean_residual, stddev_pop(residual) AS std_residual,
                  avg(abs(residual)) AS mae, count(*) AS n_obs FROM res GROUP BY sku) s ON s.sku = x.sku
     LEFT JOIN (SELECT sku, list_sort(list(message)) AS input_drift, bool_or(drift_detected) AS in_d
                FROM ks_out GROUP BY sku) k ON k.sku = x.sku"""


@query("drift_check", sql=REPLAY_SQL + q_drift.KS_SQL + q_drift.KS_P_SQL + fin(
    DRIFT_CHECK_SQL, ints=["drift_events", "n_obs"], dbls=["severity", "mean_residual", "std_residual", "mae"],
    keep=["sku", "drift_detected", "detectors", "message", "label", "input_drift"]))
def drift_check(spark, sf_dir):
    """D11-D14 with input drift from the KS tests."""
    return checked_inputs(spark, sf_dir).drop("input_tests")


def checked_inputs(spark, sf_dir):
    return rp.drift_check(rp.replay(q_drift.residuals_df(spark, sf_dir)), q_drift.ks_tests(spark, sf_dir))


@query("drift_check_inputs", sql=REPLAY_SQL + q_drift.KS_SQL + q_drift.KS_P_SQL + fin(
    "SELECT sku, feature, ks_statistic, p_value, drift_detected AS drift FROM ks_out", dbls=["ks_statistic", "p_value"],
    keep=["sku", "feature", "drift"]))
def drift_check_inputs(spark, sf_dir):
    """The structured input tests that each SKU's verdict carries, one row a feature."""
    return checked_inputs(spark, sf_dir).select("sku", F.explode("input_tests").alias("t")).select("sku", "t.*")


# The verdict at the last observation, without input tests (Q4).
VERDICT_SQL = """,
ds AS (
  SELECT s.sku, x.lv.d AS drift, x.lv.s AS severity,
         CASE WHEN len(x.lv.det) > 0 THEN array_to_string(x.lv.det, ', ') ELSE '—' END AS detectors,
         CASE WHEN x.lv.d AND x.lv.s >= 0.5 THEN 'HIGH' WHEN x.lv.d THEN 'MEDIUM' WHEN x.lv.w THEN 'LOW'
              ELSE 'NONE' END AS label,
         x.drift_events, s.mean_residual, s.std_residual
  FROM (SELECT sku, arg_max({'d': drift_detected, 's': severity, 'det': detectors, 'w': ddm_warning}, n) AS lv,
               count(*) FILTER (WHERE drift_detected) AS drift_events FROM rp2 GROUP BY sku) x
       JOIN (SELECT sku, avg(residual) AS mean_residual, stddev_pop(residual) AS std_residual FROM res GROUP BY sku) s
         ON s.sku = x.sku)
"""
COUNTS_SQL = fin("""
SELECT count(*) FILTER (WHERE drift) AS drift_skus, count(*) FILTER (WHERE label = 'LOW') AS warning_skus,
       count(*) FILTER (WHERE label = 'NONE') AS stable_skus, count(*) AS total_skus,
       avg(mean_residual) AS avg_mean_residual, avg(std_residual) AS avg_std_residual FROM ds""",
    ints=["drift_skus", "warning_skus", "stable_skus", "total_skus"], dbls=["avg_mean_residual", "avg_std_residual"])


@query("drift_summary", sql=REPLAY_SQL + VERDICT_SQL + fin(
    "SELECT * FROM ds", ints=["drift_events"], dbls=["severity", "mean_residual", "std_residual"],
    keep=["sku", "drift", "detectors", "label"]))
def drift_summary(spark, sf_dir):
    """D13, D14."""
    return rp.last_verdicts(q_drift.residuals_df(spark, sf_dir))


@query("drift_counts", sql=REPLAY_SQL + VERDICT_SQL + COUNTS_SQL)
def drift_counts(spark, sf_dir):
    """D15."""
    return dr.drift_counts(rp.last_verdicts(q_drift.residuals_df(spark, sf_dir)))


@query("drift_listing", sql=REPLAY_SQL + VERDICT_SQL + fin("""
SELECT *, GREATEST((SELECT count(*) FROM ds) - 30, 0) AS n_more FROM (
SELECT row_number() OVER (ORDER BY r, sku) AS listing_rank, sku, label, severity, mean_residual, std_residual
FROM (SELECT *, CASE WHEN drift THEN 0 WHEN label = 'LOW' THEN 1 ELSE 2 END AS r FROM ds)
ORDER BY r, sku LIMIT 30)""", ints=["listing_rank", "n_more"], dbls=["severity", "mean_residual", "std_residual"],
    keep=["sku", "label"]))
def drift_listing(spark, sf_dir):
    """D16."""
    return dr.drift_listing(rp.last_verdicts(q_drift.residuals_df(spark, sf_dir)), 30)


@query("monitor_counts", sql=REPLAY_SQL + VERDICT_SQL + COUNTS_SQL)
def monitor_counts(spark, sf_dir):
    """D15 for the monitor page: the same counts as the drift report."""
    return dr.drift_counts(rp.last_verdicts(q_drift.residuals_df(spark, sf_dir)))


ARRIVAL_DAYS, ARRIVAL_SHIFT = 28, 14
ARRIVALS_SQL = f"""
newer AS (SELECT sku, date + {ARRIVAL_SHIFT} AS date FROM pos WHERE date > (SELECT max(date) FROM pos) - {ARRIVAL_DAYS}),
extended AS (SELECT sku, count(DISTINCT date) AS n_rows FROM (SELECT sku, date FROM pos UNION ALL SELECT * FROM newer)
             GROUP BY sku)
"""


def newly_arrived(pos):
    """New observations: the last weeks of the table, repeated two weeks later with one unit more."""
    last = pos.agg(F.max("date")).first()[0]
    return (pos.where(F.col("date") > F.date_sub(F.lit(last), ARRIVAL_DAYS))
            .withColumn("date", F.date_add("date", ARRIVAL_SHIFT)).withColumn("units_sold", F.col("units_sold") + 1))


def retrained(spark, sf_dir):
    """The stored models (version 1) meet the history merged with newer observations (existing rows win, J11)."""
    from shelfcast.functions.dates import holiday_dimension
    from shelfcast.operators import reshape as rs
    pos = fx.pos(spark, sf_dir)
    _, models = trained(spark, sf_dir)
    merged = rs.incremental_merge(pos, newly_arrived(pos)).drop("_src")
    feats = fe.prepare_features(fc.partition_for_training(merged), holiday_dimension(fx.calendar_raw(spark, sf_dir)))
    return fc.train_models(feats, fe.FEATURE_COLUMNS, prior=models, retrain=False)


@query("incremental_retrain")
def incremental_retrain(spark, sf_dir):
    """SKUs with new observations are trained again (version 2), the others keep their stored model."""
    return retrained(spark, sf_dir).select(*METRIC_COLS)


# ------------------------------------------------------- learner rows that SQL can state
TRAINED_SQL = """
trained AS (SELECT sku, count(*) AS n_rows, CAST(ceil(CAST(0.2 AS DOUBLE) * count(*)) AS BIGINT) AS val_samples
            FROM pos GROUP BY sku HAVING count(*) >= 50),
last7 AS (SELECT sku, date FROM (SELECT sku, date, row_number() OVER (PARTITION BY sku ORDER BY date DESC) AS rd FROM pos)
          WHERE rd <= 7)
"""


@query("train_audit", sql=with_adapter(TRAINED_SQL) + fin("""
SELECT sku, n_rows, n_rows - val_samples AS train_samples, val_samples, 1 AS version,
       CAST(NULL AS VARCHAR) AS error, true AS sound FROM trained
UNION ALL SELECT sku, count(*), NULL, NULL, NULL, printf('%d rows, at least %d needed', count(*), 50), NULL
FROM pos GROUP BY sku HAVING count(*) < 50""",
    ints=["n_rows", "train_samples", "val_samples", "version"], keep=["sku", "error", "sound"]))
def train_audit(spark, sf_dir):
    """Each model's samples and version, and whether its metrics and importances are sound."""
    _, models = trained(spark, sf_dir)
    weight = F.aggregate("importance", F.lit(0.0), lambda a, x: a + x)
    sound = ((F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae") - 1e-9) & (F.col("r2") <= 1) & (F.col("mape") >= 0)
             & F.col("best_iteration").between(0, 100) & ((F.abs(weight - 1) < 1e-6) | (weight == 0)))
    return models.select("sku", "n_rows", "train_samples", "val_samples", "version", "error", sound.alias("sound"))


@query("retrain_audit", sql=with_adapter(TRAINED_SQL, ARRIVALS_SQL) + fin("""
SELECT e.sku, e.n_rows, CASE WHEN e.n_rows > t.n_rows THEN 2 ELSE 1 END AS version,
       CASE WHEN e.n_rows > t.n_rows THEN 'trained' ELSE 'reloaded' END AS status
FROM extended e JOIN trained t ON t.sku = e.sku""", ints=["n_rows", "version"], keep=["sku", "status"]))
def retrain_audit(spark, sf_dir):
    """Rows, version and status of the models after new observations."""
    done = retrained(spark, sf_dir).where(F.col("version").isNotNull())
    return done.select("sku", "n_rows", "version", "status")


EARLY, LATER, SILENT = "1995-08-01", "1996-01-01", "EUROPE"
EARLY_SQL = f"""
grown AS (SELECT sku, count(*) FILTER (WHERE date < DATE '{EARLY}') AS n1,
                 count(*) FILTER (WHERE date < DATE '{EARLY}' OR (date < DATE '{LATER}' AND store_id <> '{SILENT}')) AS n2
          FROM pos GROUP BY sku),
portfolio AS (
  SELECT 1 AS run, sku, n1 AS n_rows, CASE WHEN n1 >= 50 THEN 1 END AS version,
         CASE WHEN n1 >= 50 THEN 'trained' ELSE 'skipped' END AS status FROM grown WHERE n1 > 0
  UNION ALL
  SELECT 2, sku, n2, CASE WHEN n1 >= 50 AND n2 > n1 THEN 2 WHEN n2 >= 50 THEN 1 END,
         CASE WHEN n2 < 50 THEN 'skipped' WHEN n1 >= 50 AND n2 = n1 THEN 'reloaded' ELSE 'trained' END
  FROM grown WHERE n2 > 0)
"""


@query("portfolio_audit", sql=with_adapter(EARLY_SQL) + fin("""
SELECT *, CASE WHEN status = 'skipped' THEN printf('%d rows, at least %d needed', n_rows, 50) END AS error FROM portfolio""",
    ints=["run", "n_rows", "version"], keep=["sku", "status", "error"]))
def portfolio_audit(spark, sf_dir):
    """M2: a portfolio trained on a short history, then again when all stores but one have more:
    series too short are reported, unchanged ones keep their stored model, the others continue their version."""
    from shelfcast.functions.dates import holiday_dimension
    pos = fx.pos(spark, sf_dir)
    hol = holiday_dimension(fx.calendar_raw(spark, sf_dir))
    early = F.col("date") < F.lit(EARLY).cast("date")
    later = (F.col("date") < F.lit(LATER).cast("date")) & (F.col("store_id") != SILENT)

    def run(seen, stored):
        feats = fe.prepare_features(fc.partition_for_training(seen), hol)
        return fc.train_models(feats, fe.FEATURE_COLUMNS, prior=stored, retrain=False)

    first = run(pos.where(early), None).checkpoint(eager=True)
    second = run(pos.where(early | later), first)
    return (first.withColumn("run", F.lit(1).cast("bigint")).unionByName(second.withColumn("run", F.lit(2).cast("bigint")))
            .select("run", "sku", "n_rows", "version", "status", "error"))


@query("one_sku_history", sql=with_adapter(HIST_SQL) + fin(
    "SELECT version, mae, rmse, r2, mape, training_samples, trained_at FROM runs WHERE sku = (SELECT min(sku) FROM runs)",
    ints=["version", "training_samples"], dbls=["mae", "rmse", "r2", "mape"], keep=["trained_at"]))
def one_sku_history(spark, sf_dir):
    """The history of one SKU (here the first in order)."""
    runs = history_runs(spark, sf_dir)
    sku = runs.agg(F.min("sku")).first()[0]
    return hi.sku_history(runs, sku).select("version", "mae", "rmse", "r2", "mape", "training_samples", "trained_at")


@query("model_dashboard", sql=with_adapter(TRAINED_SQL) + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM trained) AS models_trained, CAST(0 AS BIGINT) AS models_failed,
       0.0::DOUBLE AS mae_gap, 0.0::DOUBLE AS rmse_gap, 0.0::DOUBLE AS r2_gap, 0.0::DOUBLE AS mape_gap""")
def model_dashboard(spark, sf_dir):
    """A10: the averages of the model table against those of its hold-out predictions (``model_averages`` has the numbers)."""
    feats, models = trained(spark, sf_dir)
    from shelfcast.functions.metrics import metric_aggs
    from shelfcast.functions.scalars import combine_scalars
    each = fc.score(feats, models).where("split = 'val'").groupBy("sku").agg(*metric_aggs())
    again = each.agg(*[F.avg(m).alias(f"_{m}") for m in ("mae", "rmse", "r2", "mape")])
    both = combine_scalars(model_averages_of(models), again)
    gaps = [F.round(F.abs(F.col(f"avg_{m}") - F.col(f"_{m}")), 4).alias(f"{m}_gap") for m in ("mae", "rmse", "r2", "mape")]
    return both.select("models_trained", "models_failed", *gaps)


def model_averages_of(models):
    return models.agg(F.count_if(F.col("model").isNotNull()).alias("models_trained"),
                      F.count_if(F.col("status") == fc.FAILED).alias("models_failed"),
                      *[F.avg(m).alias(f"avg_{m}") for m in ("mae", "rmse", "r2", "mape")])


@query("model_averages")
def model_averages(spark, sf_dir):
    """A10: number of models and the averages of their hold-out metrics, from the model table."""
    return model_averages_of(trained(spark, sf_dir)[1])


@query("score_audit", sql=with_adapter(TRAINED_SQL) + fin("SELECT sku, val_samples, 0.0 AS mae_gap, true AS floored FROM trained",
                                                          ints=["val_samples"], dbls=["mae_gap"], keep=["sku", "floored"]))
def score_audit(spark, sf_dir):
    """The stored hold-out error against the one recomputed from the predictions."""
    feats, models = trained(spark, sf_dir)
    val = fc.score(feats, models).where("error IS NULL").groupBy("sku").agg(
        F.count_if(F.col("split") == "val").alias("val_samples"), (F.min("predicted") >= 0).alias("floored"),
        F.avg(F.when(F.col("split") == "val", F.abs(F.col("actual") - F.col("predicted")))).alias("_mae"))
    return val.join(models.select("sku", "mae"), "sku").select(
        "sku", "val_samples", F.round(F.abs(F.col("mae") - F.col("_mae")), 4).alias("mae_gap"), "floored")


@query("predict_audit", sql=with_adapter(TRAINED_SQL) + fin("""
SELECT l.sku, l.date, 1 AS model_version, true AS floored, CAST(NULL AS VARCHAR) AS error
FROM last7 l JOIN trained t ON t.sku = l.sku""",
    ints=["model_version"], keep=["sku", "date", "floored", "error"]))
def predict_audit(spark, sf_dir):
    """Dates and model version of the tail forecast."""
    return fc.predict_tail(*trained(spark, sf_dir), 7).select(
        "sku", "date", "model_version", (F.col("forecast") >= 0).alias("floored"), "error")


@query("forecast_one_sku", sql=with_adapter(TRAINED_SQL) + fin("""
SELECT sku, date, 1 AS model_version FROM last7 WHERE sku = (SELECT min(sku) FROM trained)""",
    ints=["model_version"], keep=["sku", "date"]))
def forecast_one_sku(spark, sf_dir):
    """One SKU trained and its last rows scored (here the first in order)."""
    feats = features_df(spark, sf_dir, for_training=True)
    sku = feats.groupBy("sku").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 50).agg(F.min("sku")).first()[0]
    return fc.forecast_one(feats, sku, fe.FEATURE_COLUMNS).select("sku", "date", "model_version")


@query("first_skus_rows", sql=with_adapter() + """
SELECT sku, CAST(count(*) AS BIGINT) AS n_rows FROM pos
WHERE sku IN (SELECT DISTINCT sku FROM pos ORDER BY sku LIMIT 30) GROUP BY sku""")
def first_skus_rows(spark, sf_dir):
    """M3: the user's choice of the first n SKUs (n is the feature)."""
    return fc.first_skus(fx.pos(spark, sf_dir), 30).groupBy("sku").agg(F.count(F.lit(1)).alias("n_rows"))


@query("fold_audit", sql=with_adapter() + fin("""
SELECT sku, k AS fold, n - (4 - k) * (n // 4) AS train_samples, n // 4 AS val_samples, true AS sound
FROM (SELECT sku, count(*) AS n FROM pos GROUP BY sku) c CROSS JOIN (VALUES (1), (2), (3)) f(k) WHERE n > 50""",
    ints=["fold", "train_samples", "val_samples"], keep=["sku", "sound"]))
def fold_audit(spark, sf_dir):
    """M5: fold sizes, and whether each fold's metrics are sound."""
    folds = fc.cv_fold_metrics(features_df(spark, sf_dir, for_training=True), fe.FEATURE_COLUMNS)
    sound = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae") - 1e-9) & (F.col("r2") <= 1)
    return folds.select("sku", "fold", "train_samples", "val_samples", sound.alias("sound"))


@query("refreshed_predictions", sql=REPLAY_SQL + VERDICT_SQL + "," + TRAINED_SQL + fin("""
SELECT l.sku, l.date, CASE WHEN d.drift THEN 2 ELSE 1 END AS model_version
FROM last7 l JOIN trained t ON t.sku = l.sku JOIN ds d ON d.sku = l.sku""", ints=["model_version"], keep=["sku", "date"]))
def refreshed_predictions(spark, sf_dir):
    """Drifted SKUs are retrained and their tail forecasts replace the old ones."""
    feats, models = trained(spark, sf_dir)
    drifted = rp.last_verdicts(q_drift.residuals_df(spark, sf_dir)).where("drift").select("sku")
    newer = fc.retrain_subset(feats, drifted, fe.FEATURE_COLUMNS, prior=models)
    fresh = fc.predict_tail(feats, newer, 7).checkpoint(eager=True)
    return fc.replace_predictions(fc.predict_tail(feats, models, 7), fresh).select("sku", "date", "model_version")
