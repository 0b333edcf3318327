"""Figures that must not grow faster than the input: partitions, exchanges, micro-batches."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import clean as cl
from shelfcast.operators import drift as dr
from shelfcast.operators import reshape as rs
from shelfcast.operators.gbt import HistGBT
from shelfcast.sources import fixture as fx
from shelfcast.sources import materialize as mt
from shelfcast.sources import store
from shelfcast.streaming import drift_stream as ds
from shelfcast.streaming import pos_stream as ps

T0 = dt.datetime(2024, 1, 1)
DAY = dt.date(2020, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_buckets_grow_with_the_input(spark, tmp_path):
    """A bucket stands for few series."""
    (tmp_path / "t").write_bytes(b"0" * (40 * 2 ** 20))
    assert mt.bucket_count(spark, [str(tmp_path / "t")]) >= 10


def test_snapshots_need_no_exchange_behind_a_partitioned_series(spark):
    """The statistic of each SKU is found where its residuals are."""
    rows = [(s, n, float(n % 7), float(n % 5)) for s in "abc" for n in range(1, 101)]
    res = spark.createDataFrame(rows, "sku string, n int, actual double, predicted double")
    stat = dr.ks_statistic(dr.feature_snapshots(res.repartition(3, "sku")))
    assert exchanges(stat) == 1
    assert stat.count() == 6 and stat.where("n_before = 50 and n_after = 50").count() == 6


def test_wide_rows_are_made_behind_one_exchange(spark, monkeypatch):
    """The pivot moves narrow rows only, in a number of partitions that is not coalesced."""
    rows = [("i%d" % i, "s", "c", "d_%d" % d, d) for i in range(5) for d in (1, 2, 3, 3)]
    long = spark.createDataFrame(rows, "item_id string, store_id string, cat_id string, d string, units_sold bigint")
    wide = fx._pivot(long)
    assert exchanges(wide) == 1
    assert {tuple(r)[3:] for r in wide.collect()} == {(1, 2, 6)}
    monkeypatch.setattr(mt, "WIDE_BYTES", 100)
    assert mt.wide_partitions(spark.createDataFrame(pd.DataFrame({"x": range(10_000)}))) > 8


def test_wide_rows_merge_like_long_ones(spark):
    """also with repeated rows, prices and days, and with keys that are null."""
    days = ["d_1", "d_2", "d_9"]
    wide = spark.createDataFrame([("i1", "s1", "c", [1, 0, 5]), ("i1", "s1", "c", [1, 0, 5]), ("i2", "s1", "c", [0, 2, 4]),
                                  ("i1", None, "c", [3, 3, 3])],
                                 "item_id string, store_id string, cat_id string, units array<bigint>")
    cal = spark.createDataFrame([("d_1", DAY, 1, 0), ("d_2", DAY, 1, 1), ("d_2", DAY, 2, 1), ("d_7", DAY, 2, 0), (None, DAY, 1, 0),
                                 ("d_9", DAY, None, 0)], "d string, date date, wm_yr_wk int, promo_flag int")
    prices = spark.createDataFrame([("s1", "i1", 1, 2.5), ("s1", "i1", 1, 3.5), ("s1", "i1", 2, None), ("s1", "i2", 2, 4.0),
                                    (None, "i1", 1, 1.0), ("s1", "i2", None, 9.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    got = rs.merge_pos(wide, cal, prices, days)
    want = rs.merge_pos(cl.melt_units(wide, days), cal, prices)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 9


def test_trees_are_walked_together():
    """F8: predictions are those of one tree after the other."""
    rng = np.random.default_rng(3)
    X = np.column_stack([rng.integers(0, 9, 300), rng.normal(size=300)]).astype(float)
    m = HistGBT(n_estimators=30).fit(X, X[:, 0] * 3 + rng.normal(size=300))
    X[5, 1] = np.nan
    want = np.full(300, m.base_score)
    for feat, thr, val in m.trees:
        for i in range(300):
            node = 0
            while feat[node] >= 0:
                node = 2 * node + (1 if X[i, feat[node]] < thr[node] else 2)
            want[i] += val[node]
    assert np.array_equal(m.predict(X), want) and np.array_equal(m.predict(X[:1]), want[:1])
    assert m.predict(X[:0]).shape == (0,)


def test_a_slice_is_one_batch_of_several_files(spark, monkeypatch):
    """no task writes or reads a whole slice; slices of few rows get empty files."""
    monkeypatch.setattr(ds, "FILE_ROWS", 10)
    rows = [("s%d" % (i % 3), i, T0 + dt.timedelta(minutes=i), float(i % 4), 0 if i < 40 else 2) for i in range(45)]
    frame = spark.createDataFrame(rows, "sku string, event_id long, ts timestamp, actual double, slice int")
    src = store.unique_path(spark, "t_many_src")
    each = ds.write_slices(frame, src, "slice")
    assert each == 4
    out = ds.run_to_outputs(spark, src, frame.drop("slice").schema, store.unique_path(spark, "t_many"),
                            store.unique_path(spark, "t_many_ck"), max_files=each)
    got = out["late"].groupBy("batch_id").agg(F.sum("n_rows").alias("n"), F.sum("n_late").alias("late")).collect()
    assert {tuple(r) for r in got} == {(0, 40, 0), (1, 5, 0)}


def test_micro_batches_do_not_grow_with_the_rows(spark, monkeypatch):
    """five stretches, whatever their number of files."""
    monkeypatch.setattr(ds, "FILE_ROWS", 10)
    rows = [("s%d" % (i % 3), T0 + dt.timedelta(minutes=i), i, float(i % 4)) for i in range(200)]
    frame = spark.createDataFrame(rows, "sku string, ts timestamp, event_id long, actual double")
    src = store.unique_path(spark, "t_stretch_src")
    each = ds.write_arrivals(frame, src)
    assert each == 4 and spark.read.parquet(src).select("_metadata.file_name").distinct().count() <= 5 * each


def test_skus_of_a_group_are_monitored_as_each_alone():
    """One visit for all SKUs of a group, batch after batch, with late and repeated rows and a null SKU."""
    class Value:
        stored = None

        def get(self):
            return self.stored

        def update(self, row):
            self.stored = row

    rng = np.random.default_rng(5)
    skus = ["a", None, "b"]
    group, alone = ds.Monitors(), {s: ds.Monitor() for s in skus}
    for m in [group, *alone.values()]:
        m.values = Value()
    got, want = [], []
    for batch in range(3):
        ids = rng.permutation(np.append(np.arange(batch * 80, batch * 80 + 90), [3, 3]))
        frames = [pd.DataFrame({"sku": pd.Series([skus[i] for i in rng.integers(0, 2 + batch // 2, len(part))], dtype=object),
                                "ts": pd.to_datetime(part, unit="s"), "event_id": part, "actual": part % 6 + 40.0 * (part > 150)})
                  for part in np.array_split(ids, 4)]
        got += list(group.handleInputRows((0,), iter(frames), None))
        for sku, m in alone.items():
            mine = [f[f.sku.isna() if sku is None else f.sku == sku] for f in frames]
            mine = [f for f in mine if len(f)]
            want += list(m.handleInputRows((sku,), iter(mine), None)) if mine else []
    key = lambda r: (str(r["sku"]), r["ts"], bool(r["late"]))
    rows = lambda frames: sorted((r for f in frames for r in f.to_dict("records")), key=key)
    assert [repr(r) for r in rows(got)] == [repr(r) for r in rows(want)] and any(r["late"] for r in rows(got))
    assert len(group.values.stored[0]) == 3


@pytest.mark.parametrize("rows, slices", [(10, 16), (100, 20)])
def test_slices_of_the_history_grow_with_it(spark, monkeypatch, rows, slices):
    """F18."""
    monkeypatch.setattr(ps, "SLICE_ROWS", 5)
    assert ps.slices_for(spark.range(rows)) == slices


def test_a_batch_meets_only_the_dates_it_brings(spark, monkeypatch):
    """the history of other days is not read for it; existing rows still win, rows without a date are new."""
    path = store.unique_path(spark, "t_span")
    schema = "sku string, date date, units_sold bigint, src int"
    ps.start_history(spark.createDataFrame([("s", DAY + dt.timedelta(days=d), d, 0) for d in range(50)], schema), path, slices=2)
    seen, join = [], type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, other, *a: (seen.append(other.count()), join(self, other, *a))[1])
    batch = [("s", DAY + dt.timedelta(days=d), 100 + d, 1, 0) for d in (48, 49, 50)] + [("s", None, 7, 1, 0)]
    ps.merge_batch(spark.createDataFrame(batch, schema + ", src_order int"), 0, path)
    assert seen == [2]
    out = {r.date: r.units_sold for r in ps.read_history(spark, path).collect()}
    assert (len(out), out[DAY + dt.timedelta(days=49)], out[DAY + dt.timedelta(days=50)], out[None]) == (52, 49, 150, 7)
    ps.merge_batch(spark.createDataFrame([("s", None, 8, 1, 0)], schema + ", src_order int"), 1, path)
    assert ps.read_history(spark, path).count() == 53
