"""Streams: order inside a batch, late rows, and the sliced history."""

import datetime as dt

import pytest

from shelfcast.sources import store
from shelfcast.streaming import drift_stream as ds
from shelfcast.streaming import pos_stream as ps

DAY = dt.date(2020, 1, 1)
ARRIVALS = "sku string, date date, units_sold bigint, src int, src_order int"


def rows_of(batch: int, skus: int = 8) -> list:
    return [(f"s{k}", DAY + dt.timedelta(days=batch + j), 100 * batch + j, 1, j) for k in range(skus) for j in (0, 1)]


def merged(spark, path):
    return {(r.sku, r.date): r.units_sold for r in ps.read_history(spark, path).collect()}


def test_files_read_do_not_grow_and_retries_are_exact(spark):
    path = store.unique_path(spark, "t_sliced")
    start = spark.createDataFrame([("s0", DAY, 7, 0)], "sku string, date date, units_sold bigint, src int")
    ps.start_history(start, path, slices=4)
    want = {("s0", DAY): 7}
    for batch in range(9):
        rows = rows_of(batch)
        frame = spark.createDataFrame(rows, ARRIVALS)
        ps.merge_batch(frame, batch, path, deltas=2)
        ps.merge_batch(frame.withColumn("units_sold", frame.units_sold + 1), batch, path, deltas=2)     # a retry
        for sku, day, units, _, _ in rows:
            want.setdefault((sku, day), units)
    assert merged(spark, path) == want
    assert max(ps.folders_read(spark, path).values()) <= 4 * 3


def test_batch_that_failed_midway_is_done_over(spark, monkeypatch):
    path = store.unique_path(spark, "t_sliced")
    ps.start_history(spark.createDataFrame([], "sku string, date date, units_sold bigint, src int"), path, slices=4)
    frame = spark.createDataFrame(rows_of(0), ARRIVALS)
    with monkeypatch.context() as m:
        def lost(*_):
            raise OSError("lost before the ledger")
        m.setattr(ps, "_publish_ledger", lost)
        with pytest.raises(OSError):
            ps.merge_batch(frame, 0, path)
    assert merged(spark, path) == {}
    ps.merge_batch(frame, 0, path)
    assert len(merged(spark, path)) == 16


def test_rows_wait_for_their_order_in_bounded_numbers(spark, monkeypatch):
    """Chunks of a batch that overlap in time come out in order; half of what waits is folded when there is too much."""
    seen = []

    class Value:
        def get(self):
            return None

        def update(self, row):
            seen.append(row)

    monkeypatch.setattr(ds, "HELD", 10)
    import numpy as np
    import pandas as pd
    monitor = ds.Monitor()
    monitor.values = Value()
    when = np.random.default_rng(1).permutation(40)
    when = np.concatenate([np.sort(when[a:a + 4]) for a in range(0, 40, 4)]).reshape(10, 4)
    when = when[np.argsort(when.mean(axis=1))]                      # chunks overlap, but drift forward
    frames = [pd.DataFrame({"ts": pd.to_datetime(w, unit="s"), "event_id": w, "actual": w.astype(float)}) for w in when]
    out = pd.concat(monitor.handleInputRows(("a",), iter(frames), None))
    fresh = out[~out.late]
    assert len(out) == 40 and fresh.event_id.is_monotonic_increasing and seen[0][0] == len(fresh)
    monkeypatch.setattr(ds, "HELD", 100)
    whole = pd.concat(monitor.handleInputRows(("a",), iter(frames), None))
    assert not whole.late.any() and whole.event_id.tolist() == list(range(40))


def test_rows_of_a_batch_are_never_late_by_their_number(monkeypatch):
    """Any order of arrival inside a batch gives the verdicts of the ordered rows, however few may wait in memory."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(5)
    when = np.repeat(np.arange(150), 2)
    rows = pd.DataFrame({"sku": "a", "ts": pd.to_datetime(when, unit="s"), "event_id": np.arange(300),
                         "actual": np.round(rng.normal(9, 3, 300)) + 40 * (when > 90)})
    again = rows.iloc[[7, 250]]                                 # equal positions: the first to arrive counts
    mixed = pd.concat([rows.iloc[rng.permutation(300)], again.assign(actual=-1.0)])

    class Value:
        def get(self):
            return None

        def update(self, row):
            self.row = row

    def verdicts(kind, frame, held):
        monkeypatch.setattr(ds, "HELD", held)
        monitor = kind()
        monitor.values = Value()
        chunks = [frame.iloc[i:i + 13] for i in range(0, len(frame), 13)]
        out = pd.concat(monitor.handleInputRows(("a",), iter(chunks), None))
        return out.reset_index(drop=True), monitor.values.row

    for kind in (ds.Monitor, ds.Monitors):
        whole, state = verdicts(kind, mixed, 1000)
        assert whole.late.sum() == 2 and whole[~whole.late].event_id.tolist() == list(range(300)) and whole.drift_detected.any()
        for held in (5, 13, 40, 280):
            got, left = verdicts(kind, mixed, held)
            assert got.drop(columns=["predicted", "residual"]).equals(whole.drop(columns=["predicted", "residual"]))
            assert np.allclose(got.residual, whole.residual, equal_nan=True)
            assert str(left)[:40] == str(state)[:40]


def test_outputs_of_one_stream(spark):
    schema = "sku string, event_id long, ts timestamp, actual double, slice int"
    t0 = dt.datetime(2024, 1, 1)
    rows = [("s", i, t0 + dt.timedelta(minutes=i), 1.0 if i < 60 else 90.0, i // 40) for i in range(100) if i != 10]
    rows += [("s", 10, t0 + dt.timedelta(minutes=10), 5.0, 2)]
    src = store.unique_path(spark, "t_out_src")
    frame = spark.createDataFrame(rows, schema)
    ds.write_slices(frame, src, "slice")
    out = ds.run_to_outputs(spark, src, frame.drop("slice").schema, store.unique_path(spark, "t_outs"),
                            store.unique_path(spark, "t_outs_ck"), max_files=1)
    assert {r.batch_id: (r.n_rows, r.n_late) for r in out["late"].collect()} == {0: (39, 0), 1: (40, 0), 2: (21, 1)}
    assert out["verdicts"].count() == 100
    events = out["events"].collect()
    assert events and all(e.ts >= t0 + dt.timedelta(minutes=60) and e.message for e in events)
