"""Series fitted together: each gives what it gives alone, in NumPy and in Spark."""

import datetime

import numpy as np
import pandas as pd

from shelfcast.operators import forecast as fc
from shelfcast.operators.gbt import HistGBT, fit_many

PARAMS = dict(n_estimators=25, max_depth=4, early_stopping_rounds=5)


def series(n, seed):
    rng = np.random.default_rng(seed)
    X = np.column_stack([rng.integers(0, 7, n), rng.integers(0, 2, n), rng.normal(size=n), np.ones(n), rng.integers(0, 90, n)]).astype(float)
    X = np.column_stack([X, X[:, 2]])                       # an equal feature: the first one wins
    return X, np.round(20 + 5 * X[:, 0] - 8 * X[:, 1] + 3 * rng.normal(size=n))


def plain_root(X, y, lam=1.0):
    """The best first split by trying every one: (gain, feature, threshold)."""
    g, best = y.mean() - y, (1e-12, -1, 0.0)
    for f in range(X.shape[1]):
        for x in np.unique(X[:, f])[1:]:
            left = X[:, f] < x
            a, b = g[left].sum(), g[~left].sum()
            gain = a ** 2 / (left.sum() + lam) + b ** 2 / ((~left).sum() + lam) - g.sum() ** 2 / (len(y) + lam)
            if gain > best[0] + 1e-9:
                best = (gain, f, x)
    return best


def test_series_fitted_together_are_those_fitted_alone():
    data = [(X[:-9], y[:-9], X[-9:], y[-9:]) for X, y in (series(n, n) for n in (10, 12, 60, 61, 200))]
    data.append((data[3][0], np.full(52, 4.0), None, None))       # nothing to split, nothing held out
    together = fit_many([HistGBT(**PARAMS) for _ in data], data)
    for m, d in zip(together, data):
        alone = HistGBT(**PARAMS).fit(*d)
        assert alone.to_bytes() == m.to_bytes() and alone.best_iteration == m.best_iteration
        assert np.array_equal(alone.feature_importance(), m.feature_importance())
        assert np.array_equal(alone.predict(d[0]), m.predict(d[0]))


def test_first_split_is_the_best_of_all():
    for n in (20, 75, 150):
        X, y = series(n, 3 * n)
        _, f, x = plain_root(X, y)
        feat, thr, _ = HistGBT(n_estimators=1).fit(X, y).trees[0]
        assert (feat[0], thr[0]) == (f, x)


def test_series_cross_batches():
    rows = pd.DataFrame([(s, r + 1) for s, n in enumerate((1, 5, 3, 8)) for r in range(n)], columns=["sku", "_rn"])
    cut = [rows.iloc[i:i + 4] for i in range(0, len(rows), 4)] + [rows.iloc[:0]]
    lists = list(fc.series_lists(cut, 3))
    assert [[len(x) for x in found] for found in lists] == [[1, 5, 3], [8]]
    assert list(fc.series_lists([rows.iloc[:0]], 3)) == []


def test_portfolio_with_null_sku_and_a_failing_series(spark):
    day = datetime.date(2020, 1, 1)
    rows = [(sku, day + datetime.timedelta(i), None if sku == "bad" else i % 7, float(i % 5))
            for sku in ("a", None, "bad", "short") for i in range(10 if sku == "short" else 60)]
    feats = spark.createDataFrame(rows, "sku string, date date, units_sold int, x double")
    first = {r.sku: r for r in fc.train_models(feats, ["x"]).collect()}
    assert {k: (r.status, r.version, r.n_rows) for k, r in first.items()} == {
        "a": ("trained", 1, 60), None: ("trained", 1, 60), "bad": (first["bad"].status, first["bad"].version, 60),
        "short": ("skipped", None, 10)}
    stored = fc.train_models(feats, ["x"]).checkpoint()
    more = feats.where("sku = 'a'").withColumn("date", (feats.date + datetime.timedelta(90)).cast("date"))
    again = {r.sku: r for r in fc.train_models(feats.where("sku is null or sku = 'a'").unionByName(more), ["x"], prior=stored,
                                               retrain=False).collect()}
    assert (again["a"].status, again["a"].version, again["a"].n_rows) == ("trained", 2, 120)
    assert (again[None].status, again[None].version, again[None].model) == ("reloaded", 1, first[None].model)
