"""Hand-worked golden cases (FIXTURES.md §3) for the domain operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.ks import ks_pvalue
from shelfcast.operators import budget as bg
from shelfcast.operators import evaluate as ev
from shelfcast.operators import features as fe
from shelfcast.operators import history as hi
from shelfcast.operators import orders as od
from shelfcast.operators.drift_replay import SeriesState, ddm_flags, new_segment

RULE_CASES = [
    # f, s, cap, cost, budget, days, demand, final, explanation
    (100, 87, 1000, 1.0, 500, 14, 20.0, 13, "Within all constraints"),
    (63, 76, 1000, 1.0, 500, 14, 20.0, 0, "Within all constraints"),
    (50, 120, 100, 1.0, 500, 14, 20.0, 0, "Within all constraints"),
    (200, 30, 100, 1.0, 500, 14, 20.0, 70, "Capped by shelf capacity (100)"),
    (200, 0, 1000, 3.0, 500, 14, None, 166, "Capped by budget ($500)"),
    (200, 0, 1000, 1.0, 500, 7, 10.5, 73, "Capped by perishability (7 days)"),
    (200, 0, 1000, 1.0, 500, 7, 0.0, 200, "Within all constraints"),
    (900, 0, 600, 2.0, 500, 7, 20.0, 140,
     "Capped by shelf capacity (600); Capped by budget ($500); Capped by perishability (7 days)"),
]


def test_rules_golden(spark):
    rows = [(f"s{i}",) + c[:7] for i, c in enumerate(RULE_CASES)]
    df = spark.createDataFrame(rows, "sku string, f long, s long, cap long, cost double, bud long, days long, dd double")
    fc = df.select("sku", F.col("f").alias("forecast_qty")).union(
        spark.createDataFrame([("norule", 10)], "sku string, forecast_qty long"))
    stock = df.select("sku", F.col("s").alias("current_stock")).union(
        spark.createDataFrame([("norule", 4)], "sku string, current_stock long"))
    rules = df.select("sku", F.lit("X").alias("category"), F.col("cap").alias("max_shelf_capacity"),
                      F.col("cost").alias("unit_cost"), F.col("bud").alias("max_budget_per_order"),
                      F.col("days").alias("perishability_days"), F.lit(1).cast("long").alias("safety_stock_days"))
    dem = df.select("sku", F.col("dd").alias("daily_demand"))
    out = {r.sku: (r.final_qty, r.explanation) for r in od.apply_rules(fc, stock, rules, dem).collect()}
    for i, c in enumerate(RULE_CASES):
        assert out[f"s{i}"] == (c[7], c[8]), (i, out[f"s{i}"])
    assert out["norule"] == (6, od.NO_RULE_NOTE)


def test_zero_cost_does_not_cap(spark):
    rules = spark.createDataFrame([("a", "X", 1000, 0.0, 500, 7, 2)],
                                  "sku string, category string, max_shelf_capacity long, unit_cost double, "
                                  "max_budget_per_order long, perishability_days long, safety_stock_days long")
    fc = spark.createDataFrame([("a", 50)], "sku string, forecast_qty long")
    st = spark.createDataFrame([("a", 0)], "sku string, current_stock long")
    r = od.apply_rules(fc, st, rules).collect()[0]
    assert (r.final_qty, r.explanation) == (50, "Within all constraints")


def _sequential_budget(rows, budget):
    spent, out = 0, {}
    for sku, margin, cost, qty in sorted(rows, key=lambda r: (-r[1], r[0])):
        f = min(qty, (budget - spent) // cost)
        out[sku] = f
        spent += f * cost
    return out


def test_global_budget_golden(spark):
    rows = [("A", 900, 3000, 2), ("B", 800, 2500, 3), ("C", 700, 2000, 1), ("D", 600, 500, 10)]
    df = spark.createDataFrame(rows, "sku string, margin_cents long, cost_cents long, qty long")
    got = {r.sku: r.final_qty for r in bg.allocate(df, 10000).collect()}
    assert got == {"A": 2, "B": 1, "C": 0, "D": 3}


def test_global_budget_matches_sequential(spark):
    rng = np.random.default_rng(7)
    for trial in range(3):
        k = int(rng.integers(20, 120))
        rows = [(f"k{i:03d}", int(rng.integers(0, 50)), int(rng.integers(1, 400)), int(rng.integers(0, 30)))
                for i in range(k)]
        budget = int(sum(r[2] * r[3] for r in rows) * rng.uniform(0.1, 0.9))
        df = spark.createDataFrame(rows, "sku string, margin_cents long, cost_cents long, qty long")
        want = _sequential_budget(rows, budget)
        assert {r.sku: r.final_qty for r in bg.allocate(df, budget).collect()} == want


def test_rolling_and_lags_golden(spark):
    df = spark.createDataFrame([("a", d, u) for d, u in zip(["2020-01-01", "2020-01-02", "2020-01-03"], [3, 5, 4])],
                               "sku string, date string, units_sold long").withColumn("date", F.to_date("date"))
    out = fe.fill_numeric_nulls(fe.add_rolling_features(fe.add_lag_features(df))).orderBy("date").collect()
    assert [r.rolling_mean_7 for r in out] == [0, 3, 4]
    assert [round(r.rolling_std_7, 4) for r in out] == [0, 0, 1.4142]
    assert [r.lag_1 for r in out] == [0, 3, 5]


def test_mape_and_holdout_golden(spark):
    from shelfcast.functions.metrics import metric_aggs
    df = spark.createDataFrame([(0.0, 1.0), (4.0, 3.0)], "actual double, predicted double")
    assert df.agg(*metric_aggs()).collect()[0].mape == pytest.approx(62.5)
    s = spark.createDataFrame([("a", i) for i in range(11)], "sku string, date long")
    assert ev.holdout_split(s).where("split = 'val'").count() == 3


def test_ddm_golden():
    drift, warn, left = ddm_flags(new_segment(), np.asarray([0] * 30 + [1]))
    assert drift.tolist() == [False] * 30 + [True] and not warn.any() and left == new_segment()
    first, _, segment = ddm_flags(new_segment(), np.asarray([0] * 12))
    second, _, _ = ddm_flags(segment, np.asarray([0] * 18 + [1]))
    assert np.concatenate([first, second]).tolist() == drift.tolist()      # chunks fold alike
    values = [0.0] * 30 + [1.0]
    assert SeriesState().advance(values)["ddm_drift"][-1]
    assert not SeriesState(compat=True).advance(values)["ddm_drift"][-1]   # Q2: the flag is swallowed as coded


def test_adwin_golden():
    d = SeriesState()
    got = d.advance([0.0] * 11 + [10.0] * 10)["adwin_drift"]
    assert [i + 1 for i, hit in enumerate(got) if hit] == [21] and len(d.window) == 11


def test_chunks_fold_alike():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 150), rng.normal(0, 6, 150), rng.normal(3, 1, 100)])
    whole, state, parts = SeriesState().advance(values), SeriesState(), []
    for part in np.split(values, [1, 5, 29, 30, 31, 200, 201]):
        state = SeriesState.from_row(state.to_row(), state.window)
        parts.append(state.advance(part))
    assert any(whole["adwin_drift"]) and any(whole["ddm_drift"])
    assert {k: sum((p[k] for p in parts), []) for k in whole} == whole


def test_severity_golden(monkeypatch):
    from shelfcast.operators import drift_replay
    monkeypatch.setattr(drift_replay, "adwin_flags", lambda w, v: (np.ones(len(v), bool), np.ones(len(v), int), w))

    def sev(values):                       # every row counts as a drift, so every score shows
        return SeriesState().advance(np.asarray(values, float))["severity"][-1]
    assert sev([1] * 10 + [2] * 7) == 0.5
    assert sev([1] * 5) == 0.5
    assert sev([3] * 12) == 0.0


def test_improvement_golden(spark):
    h = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 8.0), ("b", 1, 8.0), ("b", 2, 10.0), ("c", 1, 5.0)],
                              "sku string, version long, mae double")
    out = {r.sku: r for r in hi.improvement_report(h).collect()}
    assert (out["a"].mae_improvement_pct, out["a"].improved, out["a"].message) == (20.0, True, "MAE improved by 20.0%")
    assert (out["b"].mae_improvement_pct, out["b"].message) == (-25.0, "Model needs more data")
    assert out["c"].message == "Insufficient history"


def test_ks_pvalues():
    assert ks_pvalue(0.6, 5, 5) == pytest.approx(0.357142857, abs=1e-6)
    assert ks_pvalue(1.0, 5, 5) == pytest.approx(1 / 126, abs=1e-9)
    assert ks_pvalue(0.5, 4, 50) == 1.0
    assert 0 <= ks_pvalue(0.05, 2000, 2000) <= 1 and math.isfinite(ks_pvalue(0.05, 2000, 2000))


def test_holiday_dimension_golden(spark):
    import datetime as dt
    from shelfcast.functions.dates import holiday_dimension
    days = spark.createDataFrame([(dt.date(1995, 1, 2),), (dt.date(2000, 6, 1),)], "date date")
    got = {(r.holiday_date, r.holiday_name) for r in holiday_dimension(days).collect()}
    for d, name in [((1995, 1, 16), "Martin Luther King Jr. Day"), ((1995, 5, 29), "Memorial Day"),
                    ((1995, 7, 4), "Independence Day"), ((1995, 11, 23), "Thanksgiving"),
                    ((1998, 7, 3), "Independence Day (observed)"),        # July 4 1998 was a Saturday
                    ((1999, 12, 31), "New Year's Day (observed)"),        # Jan 1 2000 was a Saturday
                    ((1995, 9, 4), "Labor Day"), ((1995, 10, 9), "Columbus Day"),
                    ((1995, 2, 20), "Washington's Birthday"), ((1995, 12, 25), "Christmas Day")]:
        assert (dt.date(*d), name) in got, (d, name)
    assert not any(n.startswith("Juneteenth") for _, n in got)          # only from 2021


def test_gbt_closed_form():
    from shelfcast.operators.gbt import HistGBT
    X = np.array([[0.0], [0.0], [1.0], [1.0]])
    y = np.array([0.0, 0.0, 10.0, 10.0])
    # one stump, no shrinkage: base 5, gradients +-5, leaf weight -G / (H + lambda)
    m = HistGBT(n_estimators=1, max_depth=1, learning_rate=1.0, reg_lambda=0.0).fit(X, y)
    assert np.allclose(m.predict(X), y)
    m = HistGBT(n_estimators=1, max_depth=1, learning_rate=1.0, reg_lambda=1.0).fit(X, y)
    assert np.allclose(m.predict(X), [5 - 10 / 3, 5 - 10 / 3, 5 + 10 / 3, 5 + 10 / 3])
    # the split threshold sits between the two values: x < 1 goes left
    assert np.allclose(m.predict(np.array([[0.5], [1.5]])), [5 - 10 / 3, 5 + 10 / 3])
    # early stopping keeps the best iteration on the validation set
    rng = np.random.default_rng(3)
    Xr = rng.normal(size=(300, 3))
    yr = Xr[:, 0] * 2 + rng.normal(scale=0.1, size=300)
    m = HistGBT(early_stopping_rounds=10).fit(Xr[:240], yr[:240], Xr[240:], yr[240:])
    assert 0 <= m.best_iteration < len(m.trees) <= 100
    assert np.sqrt(np.mean((m.predict(Xr[240:]) - yr[240:]) ** 2)) < 0.5
