"""Cleaning in file order, and audits observed in the pass that cleans."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfcast.operators import clean as cl
from shelfcast.plans import q_prep
from shelfcast.sources import materialize, store

from conftest import SF_SMALL

PRICE_SCHEMA = "store_id string, item_id string, wm_yr_wk int, sell_price double"


def price_lines(n, seed=3):
    rng = random.Random(seed)
    return [(f"S{rng.randrange(3)}", f"I{rng.randrange(6)}", rng.randrange(4), rng.choice([None, 0.0, -1.0, *range(1, 40)]))
            for _ in range(n)]


def first_prices(lines, items=None):
    kept = {}
    for s, i, w, p in lines:
        if p is not None and p > 0 and (items is None or i in items):
            kept.setdefault((s, i, w), float(p))
    return sorted((*k, p) for k, p in kept.items())


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_the_first_price_in_file_order_stays(spark, tmp_path, kind):
    lines = price_lines(3000)
    for number in range(3):
        part = spark.createDataFrame([(*r[:3], None if r[3] is None else float(r[3])) for r in lines[number * 1000:number * 1000 + 1000]],
                                     PRICE_SCHEMA).coalesce(1)
        writer = part.write.mode("append").option("header", True)
        getattr(writer, kind)(str(tmp_path / f"raw/part={number}"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")       # several blocks a file
    try:
        scan = spark.read.schema(PRICE_SCHEMA).option("header", True).format(kind).load(str(tmp_path / "raw"))
        placed = store.with_file_position(scan.select("store_id", "item_id", "wm_yr_wk", "sell_price"))
        if kind == "csv":
            assert placed.select("_file", "_block").distinct().count() > 6
        got = cl.clean_prices(placed, order=cl.POSITION)
        assert got.columns == ["store_id", "item_id", "wm_yr_wk", "sell_price"]
        assert sorted(map(tuple, got.collect())) == first_prices(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_the_first_item_in_file_order_stays(spark, tmp_path):
    rows = [("b", "S2", 1, None), ("a", "S2", 0, 0), ("b", "S1", 5, 5), ("a", "S9", -3, 2), ("a", "S1", 4, 4), ("b", "S2", 7, -1)]
    spark.createDataFrame(rows, "item_id string, store_id string, d_1 int, d_2 int").coalesce(1).write.option(
        "header", True).csv(str(tmp_path / "sales"))
    scan = spark.read.option("header", True).schema("item_id string, store_id string, d_1 int, d_2 int").csv(str(tmp_path / "sales"))
    got = cl.clean_sales_wide(store.with_file_position(scan), order=cl.POSITION)
    assert got.columns == ["item_id", "store_id", "units"]
    assert sorted((r.item_id, r.store_id, list(r.units)) for r in got.collect()) == [
        ("a", "S9", [0, 2]), ("b", "S2", [1, 0]), ("b", "S2", [7, 0])]


def observed_counts(df, counts, path):
    df.write.parquet(str(path))
    return {k: v or 0 for k, v in counts.get.items()}


def test_price_audit(spark, tmp_path):
    lines = price_lines(2000, seed=4) + [(None, "I1", 1, 3.0), (None, "I1", 1, 4.0), ("S1", None, 1, 2.0)]
    items = {"I1", "I2", "I4"}
    frame = spark.createDataFrame([(*r[:3], None if r[3] is None else float(r[3]), n) for n, r in enumerate(lines)],
                                  PRICE_SCHEMA + ", src_rank int").repartition(7)
    valid = spark.createDataFrame([(i,) for i in sorted(items) * 3], "item_id string")
    counts = Observation("t")
    cleaned = cl.clean_prices(frame, valid, counts=counts)
    got = observed_counts(cleaned, counts, tmp_path / "out")
    inside = [r for r in lines if r[1] in items]
    good = [r for r in inside if r[3] is not None and r[3] > 0]
    kept = first_prices(lines[:2000], items)
    assert got == {"rows_before": len(lines), "invalid_items_removed": len(lines) - len(inside),
                   "bad_prices_removed": len(inside) - len(good), "duplicates_removed": len(good) - len(kept) - 1,
                   "rows_after": len(kept) + 1}
    plain = cl.clean_prices(frame, valid)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.columns == plain.columns and stored.exceptAll(plain).isEmpty() and plain.exceptAll(stored).isEmpty()
    assert sorted(tuple(r) for r in stored.where("store_id is not null").collect()) == kept


def test_calendar_and_sales_audits(spark, tmp_path):
    days = spark.createDataFrame(
        [("2020-01-01", "d_1", 1, None, "x", 1), ("2020-01-01", "d_1", 1, None, "x", 1), ("never", "d_2", 1, None, None, 0),
         (None, "d_3", 1, "e", None, 0), ("2020-01-04", "d_4", 1, "e", None, 0), ("2020-01-04", "d_4", 1, "e", None, 1)],
        "date string, d string, wm_yr_wk int, event_name_1 string, event_type_1 string, snap_A int")
    counts = Observation("c")
    got = observed_counts(cl.clean_calendar(days.repartition(3), counts), counts, tmp_path / "cal")
    assert got == {"rows_before": 6, "invalid_dates": 2, "events_filled": 4, "duplicates_removed": 1, "rows_after": 3}
    assert spark.read.parquet(str(tmp_path / "cal")).exceptAll(cl.clean_calendar(days)).isEmpty()
    sales = spark.createDataFrame([("a", "S1", -1, None), ("a", "S2", 3, -2), ("a", "S3", 1, 1), ("b", "S1", None, 2)],
                                  "item_id string, store_id string, d_1 int, d_2 int")
    counts = Observation("s")
    got = observed_counts(cl.clean_sales_wide(sales, counts=counts), counts, tmp_path / "sales")
    assert got == {"rows_before": 4, "negatives_fixed": 2, "nulls_filled": 2, "zero_items_removed": 1,
                   "duplicates_removed": 1, "rows_after": 2}
    counts = Observation("none")
    got = observed_counts(cl.clean_sales_wide(sales.limit(0), counts=counts), counts, tmp_path / "empty")
    assert set(got.values()) == {0}


def test_observed_table_is_cleaned_in_one_scan_and_kept(spark):
    built = []

    def build(counts):
        built.append(1)
        return spark.range(10).observe(counts, F.count(F.lit(1)).alias("n"), F.sum(F.lit(None).cast("int")).alias("none"))

    inputs = [f"{SF_SMALL}/region.parquet"]
    name = f"t_observed_{random.random()}".replace(".", "_")
    for _ in range(2):
        table, audit = materialize.observed(spark, name, inputs, build)
        assert table.count() == 10 and sorted(map(tuple, audit.collect())) == [("n", 10), ("none", 0)]
    assert built == [1]
    counts = Observation("plan")
    from shelfcast.sources import fixture as fx
    plan = cl.clean_sales_wide(fx.sales_wide_dirty(spark, SF_SMALL), counts=counts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert q_prep.cleaning_audit(spark, SF_SMALL).count() == 16
