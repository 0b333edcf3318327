"""Stored tables: commits of two writers, sorted files, stored models."""

import threading

from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfcast.operators import features as fe
from shelfcast.operators import forecast as fc
from shelfcast.plans import q_features
from shelfcast.sources import store


def test_two_writers_take_two_versions(spark):
    path = store.unique_path(spark, "t_commits")
    runs = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], "sku string, mae double, run_order int")
    errors = []

    def write():
        try:
            store.append_history(spark, path, runs)
        except Exception as exc:
            errors.append(exc)
    threads = [threading.Thread(target=write) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = sorted((r.sku, r.version) for r in store.read_history(spark, path).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert not store._claim(spark, path, 2, "rows-of-a-late-writer")


def test_sorted_files_do_not_overlap_and_prune(spark):
    path = store.unique_path(spark, "t_sorted")
    rows = spark.range(5000).select(F.concat(F.lit("s"), F.lpad((F.col("id") % 97).cast("string"), 2, "0")).alias("sku"),
                                    F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 97).cast("int")).alias("date"))
    store.write_sorted(rows, path, ("sku", "date"), files=6)
    ranges = store.file_ranges(spark, path, ("sku", "date")).collect()
    assert sum(r.n_rows for r in ranges) == 5000 and len(ranges) > 3 and not any(r.overlaps for r in ranges)
    held = spark.read.parquet(path).where("sku = 's05'").select("_metadata.file_name").distinct().count()
    assert held <= 2
    store.write_sorted(rows.union(rows), path, ("date",), files=3)
    assert store.file_ranges(spark, path, ("sku", "date")).where("overlaps").count() > 0


def test_stored_models_are_reloaded_continued_or_trained_again(spark):
    feats = q_features.features_df(spark, SF_SMALL, for_training=True)
    skus = [r.sku for r in feats.groupBy("sku").count().where("count >= 60").orderBy("sku").limit(4).collect()]
    four = feats.where(F.col("sku").isin(skus)).checkpoint(eager=True)
    first = fc.train_models(four, fe.FEATURE_COLUMNS).checkpoint(eager=True)
    assert {(r.version, r.status) for r in first.collect()} == {(1, fc.TRAINED)}
    junk = F.when(F.col("sku") == skus[1], F.lit(b"junk").cast("binary")).otherwise(F.col("model"))
    last = four.groupBy("sku").agg(F.max("date").alias("date"))
    shorter = four.join(last, ["sku", "date"], "left_anti")
    newer = four.where(F.col("sku").isin(skus[:2])).unionByName(shorter.where(F.col("sku") == skus[2]))
    got = {r.sku: r for r in fc.train_models(newer, fe.FEATURE_COLUMNS, prior=first.withColumn("model", junk),
                                             retrain=False).collect()}
    assert [(got[s].version, got[s].status) for s in skus] == [(1, fc.RELOADED), (2, fc.TRAINED), (2, fc.TRAINED), (1, fc.RELOADED)]
    assert got[skus[1]].error and got[skus[0]].error is None
    few = four.where(F.col("sku") == skus[0]).orderBy("date").limit(10)
    row, = fc.train_models(few, fe.FEATURE_COLUMNS).collect()
    assert (row.status, row.version, row.error) == (fc.SKIPPED, None, "10 rows, at least 50 needed")
    kept, = fc.train_models(few, fe.FEATURE_COLUMNS, prior=first, retrain=False).where(F.col("sku") == skus[0]).collect()
    assert (kept.status, kept.version) == (fc.RELOADED, 1) and kept.model is not None


def test_bucketed_table_needs_no_exchange(spark):
    feats = q_features.features_df(spark, SF_SMALL, for_training=True)
    counted = feats.groupBy("sku").agg(F.max("date"))
    counted.collect()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    plain = q_features.features_df(spark, SF_SMALL).select(feats.columns)
    assert plain.exceptAll(feats).isEmpty() and plain.count() == feats.count()
