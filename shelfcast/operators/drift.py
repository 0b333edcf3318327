"""Drift detection on residuals, window-SQL form (D1, D3 no-reset, D4-D7, D9, D10, D13-D16).

Every detector statistic is a running window over one residual series
(``partitionBy(sku).orderBy(n)``). Series are the last 100 observations of a
SKU, so a window partition never exceeds 100 rows whatever the table size.
The order-dependent replay with resets (ADWIN, full DDM) is in
``operators/drift_replay.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.hashing import md5_mod
from shelfcast.functions.prefix import global_running_sum
from shelfcast.operators.features import add_rolling_features
from shelfcast.operators.orders import tail_rows

MONITOR_ROWS = 100          # last pairs fed per SKU
# Drift and input-drift message texts.
DRIFT_MESSAGE = "Drift detected by %s. Recent MAE: %.2f"
KS_MESSAGE = "%s: %s (p=%.4f)"
KS_DRIFT, KS_NO_DRIFT, KS_INSUFFICIENT = "Drift detected", "No drift", "Insufficient data"
DDM_MIN_INSTANCES = 30
DDM_WARNING, DDM_DRIFT = 2.0, 3.0
RECENT = 7                  # severity / message window


def residual_series(pos: DataFrame, shift: float = 60.0, shifted_rows: int = 40) -> DataFrame:
    """D1 on the fixture: (sku, date, n, actual, predicted, residual) for the last 100 rows.

    The predictor is the 7-row rolling mean; in about a quarter of the SKUs
    (hash draw) the last ``shifted_rows`` actuals are raised by ``shift``, so
    the detectors have something to find. ``n`` is 1 for the oldest pair.
    """
    last = tail_rows(pos.select("sku", "date", "units_sold"), MONITOR_ROWS + 7)     # all that the windows can see
    f = add_rolling_features(last, windows=(7,))
    rd = F.row_number().over(Window.partitionBy("sku").orderBy(F.col("date").desc()))
    t = f.withColumn("_rd", rd).where(F.col("_rd") <= MONITOR_ROWS)
    cnt = F.count(F.lit(1)).over(Window.partitionBy("sku"))
    hit = (md5_mod(F.col("sku"), 4) == 0) & (F.col("_rd") <= shifted_rows)
    actual = (F.col("units_sold") + F.when(hit, F.lit(shift)).otherwise(F.lit(0.0))).cast("double")
    predicted = F.coalesce(F.col("rolling_mean_7"), F.lit(0.0))
    return t.select("sku", "date", (cnt - F.col("_rd") + 1).cast("bigint").alias("n"),
                    actual.alias("actual"), predicted.alias("predicted"),
                    (actual - predicted).alias("residual"))


def _running(key: str = "sku", order: str = "n"):
    return Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def binary_errors(res: DataFrame) -> DataFrame:
    """error = |r| > running mean of |r| (current row included)."""
    a = F.abs(F.col("residual"))
    return (res.withColumn("abs_residual", a)
            .withColumn("running_mae", F.avg(a).over(_running()))
            .withColumn("binary_error", (F.col("abs_residual") > F.col("running_mae")).cast("int")))


def ddm_no_reset(res: DataFrame, min_instances: int = DDM_MIN_INSTANCES) -> DataFrame:
    """D3 up to the first detection, as running windows.

    p = running error rate, s = sqrt(p(1-p)/n); from n >= min_instances the
    minimum of p + s so far (earliest on ties) is tracked with ``min_by``; a row
    is a drift when p + s > p_min + 3 s_min, a warning when > p_min + 2 s_min.
    Until the first drift (which resets the detector) this equals the online
    detector exactly.
    """
    b = binary_errors(res)
    p = F.avg("binary_error").over(_running())
    b = b.withColumn("p", p).withColumn("s", F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n")))
    ok = F.col("n") >= min_instances
    best = F.min_by(F.when(ok, F.struct(F.col("p").alias("bp"), F.col("s").alias("bs"))),
                    F.when(ok, F.struct((F.col("p") + F.col("s")).alias("k"), F.col("n").alias("kn")))
                    ).over(_running())
    b = b.withColumn("best", best)
    lvl = F.col("p") + F.col("s")
    drift = ok & (lvl > F.col("best.bp") + DDM_DRIFT * F.col("best.bs"))
    warn = ok & ~drift & (lvl > F.col("best.bp") + DDM_WARNING * F.col("best.bs"))
    return b.withColumn("ddm_drift", drift.cast("int")).withColumn("ddm_warning", warn.cast("int"))


def severity_expr(n: Column, recent_sum: Column, recent_cnt: Column, cum_sum: Column, first7_sum: Column) -> Column:
    """D6 score from running sums of |r| (0.5 under 10 residuals)."""
    recent = recent_sum / recent_cnt
    base = F.when(n > 2 * RECENT, (cum_sum - recent_sum) / (n - RECENT)).otherwise(first7_sum / F.least(n, F.lit(RECENT)))
    base = F.when(base == 0, recent).otherwise(base)
    ratio = F.when(base != 0, recent / base).otherwise(F.lit(1.0))
    score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (ratio - 1) / 2)), 2)
    return F.when(n < 10, F.lit(0.5)).otherwise(score)


def with_severity(res: DataFrame) -> DataFrame:
    """Add ``severity_score`` (D6) and ``recent_mae`` (D7) for every position."""
    a = F.abs(F.col("residual"))
    w = Window.partitionBy("sku").orderBy("n")
    rec = w.rowsBetween(-(RECENT - 1), 0)
    out = (res.withColumn("_rs", F.sum(a).over(rec)).withColumn("_rc", F.count(a).over(rec))
           .withColumn("_cs", F.sum(a).over(_running()))
           .withColumn("_f7", F.sum(F.when(F.col("n") <= RECENT, a)).over(Window.partitionBy("sku"))))
    out = out.withColumn("severity_score", severity_expr(F.col("n"), F.col("_rs"), F.col("_rc"), F.col("_cs"),
                                                         F.col("_f7")))
    return out.withColumn("recent_mae", F.col("_rs") / F.col("_rc")).drop("_rs", "_rc", "_cs", "_f7")


def residual_stats(res: DataFrame) -> DataFrame:
    """Mean, population std, MAE and count of the residuals per SKU."""
    return res.groupBy("sku").agg(F.avg("residual").alias("mean_residual"),
                                  F.stddev_pop("residual").alias("std_residual"),
                                  F.avg(F.abs("residual")).alias("mae"), F.count(F.lit(1)).alias("n_obs"))


def drift_counts(summary: DataFrame) -> DataFrame:
    """Drift / warning / stable / total and the average residual statistics."""
    return summary.agg(F.count_if(F.col("drift")).alias("drift_skus"),
                       F.count_if(F.col("label") == "LOW").alias("warning_skus"),
                       F.count_if(F.col("label") == "NONE").alias("stable_skus"),
                       F.count(F.lit(1)).alias("total_skus"),
                       F.avg("mean_residual").alias("avg_mean_residual"),
                       F.avg("std_residual").alias("avg_std_residual"))


def drift_listing(summary: DataFrame, n: int = 30) -> DataFrame:
    """Drifted, then warned, then stable SKUs; the first ``n`` (a display top-k)."""
    r = F.when(F.col("drift"), 0).when(F.col("label") == "LOW", 1).otherwise(2)
    top = summary.withColumn("_r", r).orderBy("_r", "sku").limit(n)
    from shelfcast.operators.orders import with_remainder
    return with_remainder(top.select(F.row_number().over(Window.orderBy("_r", "sku")).alias("listing_rank"), "sku",
                                     "label", "severity", "mean_residual", "std_residual"), summary, n)


def ks_statistic(snap: DataFrame) -> DataFrame:
    """D10 statistic: snap has (sku, feature, side in {'before','after'}, value).

    D = max |F_before(v) - F_after(v)| over the pooled values, from running
    counts over the distinct values of each (sku, feature) group; NULL when a
    side is empty (the test then reports no drift with p = 1).
    """
    c = snap.groupBy("sku", "feature", "value").agg(
        F.count_if(F.col("side") == "before").alias("_c1"), F.count_if(F.col("side") == "after").alias("_c2"))
    g = Window.partitionBy("sku", "feature")
    run = g.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    c = (c.withColumn("_n1", F.sum("_c1").over(g)).withColumn("_n2", F.sum("_c2").over(g))
         .withColumn("_d", F.abs(F.try_divide(F.sum("_c1").over(run), F.col("_n1"))
                                 - F.try_divide(F.sum("_c2").over(run), F.col("_n2")))))
    return c.groupBy("sku", "feature").agg(F.min("_n1").alias("n_before"), F.min("_n2").alias("n_after"),
                                           F.max("_d").alias("ks_statistic"))


def ks_statistic_pooled(snap: DataFrame) -> DataFrame:
    """D10 statistic of each feature over the whole portfolio, whatever the number of its values.

    A feature's distinct values may be very many, so no window holds them: the
    counts get running sums over range partitions (``prefix.global_running_sum``) in the order (feature, value),
    and the totals of earlier features, one row a feature, are taken off.
    """
    c = snap.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == "before").alias("_c1"), F.count_if(F.col("side") == "after").alias("_c2"))
    order = [F.col("feature").asc(), F.col("value").asc()]
    run = global_running_sum(global_running_sum(c, order, "_c1", "_r1"), order, "_c2", "_r2")
    before = Window.orderBy("feature").rowsBetween(Window.unboundedPreceding, -1)
    totals = (c.groupBy("feature").agg(F.sum("_c1").alias("n_before"), F.sum("_c2").alias("n_after"))
              .select("*", F.coalesce(F.sum("n_before").over(before), F.lit(0)).alias("_o1"),
                      F.coalesce(F.sum("n_after").over(before), F.lit(0)).alias("_o2")))
    d = F.abs(F.try_divide(F.col("_r1") - F.col("_o1"), F.col("n_before"))
              - F.try_divide(F.col("_r2") - F.col("_o2"), F.col("n_after")))
    return run.join(totals, "feature").groupBy("feature").agg(
        F.first("n_before").alias("n_before"), F.first("n_after").alias("n_after"), F.max(d).alias("ks_statistic"))


def feature_snapshots(res: DataFrame, split_n: int = MONITOR_ROWS // 2) -> DataFrame:
    """Before/after snapshots of two model inputs: the first and second half of the window.

    One pass that generates both rows: series keep their place, so what follows needs no exchange by SKU.
    """
    side = F.when(F.col("n") <= split_n, "before").otherwise("after")
    both = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in ("actual", "predicted")])
    return (res.select("sku", side.alias("side"), F.explode(both).alias("_s"))
            .select("sku", "_s.feature", "side", "_s.value"))


def ks_tests(stats: DataFrame, method: str = "exact") -> DataFrame:
    """D10 verdicts: p-value by the caller's ``method`` (pandas UDF over (D, n1, n2)), drift when p < 0.05,
    statistic and p rounded to 4 places, and the per-feature message."""
    from shelfcast.functions.ks import ALPHA, MIN_SAMPLES, ks_pvalue_udf
    p = ks_pvalue_udf(method)(F.col("ks_statistic"), F.col("n_before"), F.col("n_after"))
    out = stats.withColumn("_p", p)
    drift = F.col("_p") < ALPHA
    enough = (F.col("n_before") >= MIN_SAMPLES) & (F.col("n_after") >= MIN_SAMPLES) & F.col("ks_statistic").isNotNull()
    msg = F.when(~enough, F.lit(KS_INSUFFICIENT)).otherwise(F.format_string(
        KS_MESSAGE, F.col("feature"), F.when(drift, KS_DRIFT).otherwise(KS_NO_DRIFT), F.col("_p")))
    return out.select("sku", "feature", "n_before", "n_after", F.round("ks_statistic", 4).alias("ks_statistic"),
                      F.round("_p", 4).alias("p_value"), drift.alias("drift_detected"), msg.alias("message"), F.lit(method).alias("method"))
