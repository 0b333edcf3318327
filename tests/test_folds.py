"""Folds fitted in the JVM: number for number what the NumPy learner gives, and no row in a Python worker."""

import datetime

import numpy as np
import pytest

from shelfcast.operators import forecast as fc
from shelfcast.operators.gbt import HistGBT

COLS = ["a", "b", "c", "d", "e", "f"]
DAY = datetime.date(2010, 1, 1)


def series(n, seed, holes=False):
    """Few and many values, more than the bins hold, an equal feature, a constant one, and nulls if wanted."""
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 7, n), rng.integers(0, 2, n), rng.normal(size=n)
    X = np.column_stack([a, b, c, c, np.full(n, 3.0), np.round(rng.normal(size=n), 1)]).astype(float)
    y = np.round(20 + 5 * a - 8 * b + 3 * rng.normal(size=n), 2) * (1 - (np.arange(n) % 50 == 7))
    if holes:
        X[::11, 5] = np.nan
        X[3::400, 2] = np.nan
    return X, y


def wanted(X, y, params):
    n, out = len(y), {}
    for k in (1, 2, 3):
        start = n - (4 - k) * (n // 4)
        m = HistGBT(**{**params, "early_stopping_rounds": None}).fit(X[:start], y[:start])
        part = slice(start, start + n // 4)
        out[k] = (start, n // 4, *fc.np_metrics(y[part], np.maximum(m.predict(X[part]), 0)))
    return out


def frame(spark, found):
    rows = [(sku, DAY + datetime.timedelta(i), None if np.isnan(t) else float(t), *[None if np.isnan(v) else float(v) for v in x])
            for sku, (X, y) in found.items() for i, (x, t) in enumerate(zip(X, y))]
    np.random.default_rng(0).shuffle(rows)
    return spark.createDataFrame([tuple(r) for r in rows], "sku string, date date, y double, " + ", ".join(f"{c} double" for c in COLS))


@pytest.mark.parametrize("params", [fc.GBT_PARAMS, dict(n_estimators=7, max_depth=3, max_bin=16, min_child_weight=4.0, reg_lambda=0.5)])
def test_folds_are_those_of_the_numpy_learner(spark, params):
    found = {f"s{n}": series(n, n) for n in (50, 51, 64, 131, 1500)} | {None: series(90, 1), "holes": series(120, 2, True)}
    found["many holes"] = series(900, 3, True)
    found["flat"] = (found["s64"][0], np.full(64, 4.0))
    got = {}
    for r in fc.cv_fold_metrics(frame(spark, found), COLS, "y", params=params).collect():
        got.setdefault(r.sku, {})[r.fold] = tuple(r)[2:]
    want = {sku: wanted(X, y, params) for sku, (X, y) in found.items() if len(y) > 50}
    assert got == want


def test_unknown_targets_give_no_metric_only_where_they_count(spark):
    X, y = series(100, 5)
    y[60] = np.nan
    got = {r.fold: tuple(r)[4:] for r in fc.cv_fold_metrics(frame(spark, {"s": (X, y)}), COLS, "y").collect()}
    assert got[1] == wanted(X, y, fc.GBT_PARAMS)[1][2:] and got[2] == got[3] == (None,) * 4


def test_no_row_goes_to_a_python_worker(spark):
    folds = fc.cv_fold_metrics(frame(spark, {"s": series(60, 1)}), COLS, "y")
    plan = folds._jdf.queryExecution().executedPlan().toString()
    assert "MapPartitions" in plan and "Pandas" not in plan and "Arrow" not in plan
    assert folds.count() == 3 and fc.cv_fold_metrics(frame(spark, {"s": series(50, 1)}), COLS, "y").count() == 0


def test_fold_audit_counts_every_fold_without_python(spark, tmp_path):
    from shelfcast.plans.q_forecast import fold_audit
    from shelfcast.sources import fixture as fx
    days = [datetime.datetime(1996, 1, 1) + datetime.timedelta(i) for i in range(120)]
    tables = {
        "lineitem": ([(s, float(1 + (i * s) % 9), 100.0 + i, d) for s in (1, 2, 5, 9) for i, d in enumerate(days[:60 if s == 9 else 120])],
                     "l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp"),
        "supplier": ([(s, s % 2) for s in (1, 2, 5, 9)], "s_suppkey bigint, s_nationkey bigint"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey bigint, n_regionkey bigint"),
        "region": ([(0, "EAST"), (1, "WEST")], "r_regionkey bigint, r_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    audit = fold_audit(spark, str(tmp_path))
    sizes = {r.sku: r["count"] for r in fx.pos(spark, str(tmp_path)).groupBy("sku").count().collect()}
    assert len(sizes) == 4 and min(sizes.values()) > 50
    assert sorted(tuple(r) for r in audit.collect()) == sorted(
        (sku, k, n - (4 - k) * (n // 4), n // 4, True) for sku, n in sizes.items() for k in (1, 2, 3))
    assert "Pandas" not in audit._jdf.queryExecution().executedPlan().toString()
