"""Per-SKU forecasting: train, score, tail forecast, importance, folds.

Each SKU is an independent series (at most one row per calendar day). The feature
table is already hash-partitioned on ``sku`` by its windows, so series are read
from sorted partitions (no extra exchange); a task holds ``TOGETHER`` of them at a time and grows their
trees together. With stored models, features and models are cogrouped by a hash of ``sku``.
Models are rows of a model table (S15): bytes plus metrics, so scoring is a
``cogroup`` of features and models on ``sku``, never one Spark job per SKU.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.evaluate import CV_FOLDS, MIN_TRAIN_ROWS, TEST_SHARE
from shelfcast.operators.gbt import HistGBT, fit_many
from shelfcast.operators.jvm import map_partitions
from shelfcast.operators.orders import tail_rows

# The reason of a skipped series.
SKIP_NOTE = "%d rows, at least %d needed"
# Learner hyper-parameters of the reference model.
GBT_PARAMS = dict(n_estimators=100, max_depth=5, learning_rate=0.1, reg_lambda=1.0, min_child_weight=1.0,
                  max_bin=256, early_stopping_rounds=10)

MODEL_SCHEMA = ("sku string, n_rows long, train_samples long, val_samples long, best_iteration long, "
                "mae double, rmse double, r2 double, mape double, model binary, "
                "feature_columns array<string>, importance array<double>, error string, "
                "version long, status string, trained_at date")
MODEL_COLS = [c.split()[0] for c in MODEL_SCHEMA.split(", ")]
#: What a run did with a SKU (``train_models``).
TRAINED, RELOADED, SKIPPED, FAILED = "trained", "reloaded", "skipped", "failed"
SCORE_SCHEMA = ("sku string, date date, actual double, predicted double, split string, model_version long, "
                "error string")
FOLD_SCHEMA = "sku string, fold long, train_samples long, val_samples long, mae double, rmse double, r2 double, mape double"


#: Bytes read that one training partition may stand for, and one of a scan that folds a series' last rows.
PARTITION_BYTES, SCAN_BYTES = 4 * 2 ** 20, 16 * 2 ** 20


#: A leaf this large is one of unknown size (a checkpoint, an RDD).
UNKNOWN_BYTES = 2 ** 60


def leaf_bytes(df: DataFrame) -> list[int]:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]


def read_bytes(df: DataFrame) -> int:
    """The estimated bytes of the tables that ``df`` reads; those of unknown size count nothing."""
    return sum(n for n in leaf_bytes(df) if n < UNKNOWN_BYTES)


def partition_for_training(df: DataFrame, key: str = "sku", per_core: int = 2, partitions: int | None = None,
                           bytes_each: int = PARTITION_BYTES) -> DataFrame:
    """Hash-partition on ``key`` into a fixed number of partitions.

    Grouped Python work costs per group, not per byte, so AQE's size-based
    coalescing would pile every series into a few tasks. A user-specified
    partition count is never coalesced; applied before the feature windows,
    this one exchange serves the windows and the grouped map alike. The count is at least two a core and
    grows with the bytes read (``bytes_each``), unless given.
    """
    return df.repartition(partitions or training_partitions(df, per_core, bytes_each), key)


def training_partitions(df: DataFrame, per_core: int = 2, bytes_each: int = PARTITION_BYTES) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism * per_core, -(-read_bytes(df) // bytes_each))


#: Series whose trees grow together, and groups of series a partition of ``train_models`` with stored models.
TOGETHER, GROUPS = 8, 16


def in_series(df: DataFrame) -> DataFrame:
    """``df`` with its series whole, in date order, one after another in a partition; ``_rn`` counts the rows of each."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy("sku").orderBy("date")))


def series_lists(batches: Iterable[pd.DataFrame], together: int) -> Iterator[list[pd.DataFrame]]:
    """The series of a partition of ``in_series``, up to ``together`` at a time."""
    found, rest = [], None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        starts = np.flatnonzero(b["_rn"].to_numpy() == 1)
        if not len(starts):
            continue                                      # an empty batch
        for first, end in zip(starts[:-1], starts[1:]):
            found.append(b.iloc[first:end])
            if len(found) == together:
                yield found
                found = []
        rest = b.iloc[starts[-1]:]
    if rest is not None:
        found.append(rest)
    if found:
        yield found


def np_metrics(y: np.ndarray, p: np.ndarray) -> tuple[float, float, float, float]:
    e = y - p
    sse = float(np.sum(e * e))
    sst = float(np.sum((y - y.mean()) ** 2)) if len(y) else 0.0
    r2 = (1.0 if sse == 0 else 0.0) if sst == 0 else 1.0 - sse / sst
    return (float(np.mean(np.abs(e))), float(math.sqrt(np.mean(e * e))), r2,
            float(np.mean(np.abs(e) / np.maximum(y, 1)) * 100))


def _fit(series: list[pd.DataFrame], feature_cols: list[str], target: str, test_share: float, params: dict) -> list[dict]:
    """Model bytes, samples and hold-out metrics of each series (in date order)."""
    data, sizes = [], []
    for pdf in series:
        n = len(pdf)
        X = pdf[feature_cols].to_numpy(dtype=float)
        y = pdf[target].to_numpy(dtype=float)
        n_val = int(math.ceil(test_share * n))
        n_tr = n - n_val
        data.append((X[:n_tr], y[:n_tr], X[n_tr:], y[n_tr:]))
        sizes.append((n_tr, n_val))
    out = []
    for m, (_, _, X, y), (n_tr, n_val) in zip(fit_many([HistGBT(**params) for _ in data], data), data, sizes):
        mae, rmse, r2, mape = np_metrics(y, np.maximum(m.predict(X), 0))
        out.append(dict(train_samples=n_tr, val_samples=n_val, best_iteration=m.best_iteration, mae=mae, rmse=rmse, r2=r2,
                        mape=mape, model=m.to_bytes(), importance=m.feature_importance().tolist()))
    return out


def _trained(waiting: list[tuple[dict, pd.DataFrame, int]], *how) -> list[dict]:
    """The rows of the series in ``waiting`` (row so far, series, version), fitted together."""
    try:
        fits = _fit([pdf for _, pdf, _ in waiting], *how)
    except Exception:                                     # fitted one by one, so each tells its own error
        fits = []
        for _, pdf, _ in waiting:
            try:
                fits += _fit([pdf], *how)
            except Exception as exc:  # a failing SKU yields an error row, not an abort (M1)
                fits.append(dict(error=f"{type(exc).__name__}: {exc}", status=FAILED))
    return [row | (fit if "status" in fit else fit | dict(version=version, status=TRAINED))
            for (row, _, version), fit in zip(waiting, fits)]


def _portfolio_fn(feature_cols: list[str], target: str, min_rows: int, test_share: float, params: dict, retrain: bool):
    how = (feature_cols, target, test_share, params)

    def decide(pdf: pd.DataFrame, last: dict | None):
        """A finished row, or (row so far, series, version) if the series is to be fitted."""
        n, day = len(pdf), pdf["date"].iloc[-1]
        row = dict.fromkeys(MODEL_COLS) | dict(sku=pdf["sku"].iloc[0], n_rows=n, feature_columns=list(feature_cols),
                                               trained_at=day)
        if n < min_rows:
            reason = SKIP_NOTE % (n, min_rows)
            return (last or row) | dict(status=RELOADED if last else SKIPPED, error=reason)
        if last and not retrain and int(last["n_rows"]) == n and pd.Timestamp(last["trained_at"]) == pd.Timestamp(day):
            try:
                HistGBT.from_bytes(last["model"])
                return last | dict(status=RELOADED, error=None)
            except Exception as exc:                      # an unreadable model is trained again and says so
                row["error"] = f"{type(exc).__name__}: {exc}"
        return row, pdf, (int(last["version"]) if last else 0) + 1

    def rows_of(pairs) -> list[dict]:
        rows, waiting = [], []
        for pdf, last in pairs:
            done = decide(pdf, last)
            if isinstance(done, dict):
                rows.append(done)
                continue
            waiting.append(done)
            if len(waiting) == TOGETHER:
                rows += _trained(waiting, *how)
                waiting = []
        return rows + (_trained(waiting, *how) if waiting else [])

    def table(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=MODEL_COLS, dtype=object)

    def first(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in series_lists(batches, TOGETHER):
            yield table(rows_of((pdf, None) for pdf in found))

    def again(key, feats: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        stored = stored[stored["model"].notna()].sort_values("version")
        # a null sku is a series, too
        lasts = {None if pd.isna(sku) else sku: x.iloc[-1].to_dict() for sku, x in stored.groupby("sku", dropna=False)}
        pairs, seen = [], set()
        for sku, pdf in feats.groupby("sku", dropna=False):
            sku = None if pd.isna(sku) else sku
            seen.add(sku)
            pdf = pdf.sort_values("date", kind="stable")
            pairs.append((pdf, lasts[sku] | dict(sku=sku) if sku in lasts else None))
        rows = rows_of(pairs)
        if not retrain:                                   # nothing new: the stored model stays
            rows += [last | dict(sku=sku, status=RELOADED) for sku, last in lasts.items() if sku not in seen]
        return table([{c: r.get(c) for c in MODEL_COLS} for r in rows])

    return first, again


def train_models(features: DataFrame, feature_cols: list[str], target: str = "units_sold",
                 min_rows: int = MIN_TRAIN_ROWS, test_share: float = TEST_SHARE, params: dict | None = None,
                 prior: DataFrame | None = None, retrain: bool = True) -> DataFrame:
    """M1/M2/M4/M6/M7/M8: one row per SKU with its model, hold-out metrics, version and what was done.

    Features are cogrouped with the stored models ``prior`` by groups of SKUs (none: every SKU
    starts at version 1, and partitions stay as they are). A trained SKU's version is its last one + 1. With ``retrain=False`` a SKU whose
    series has not changed since its model was stored, or that has no features, keeps that
    model (``reloaded``); one whose model cannot be read is trained again with the error noted. A series
    below ``min_rows`` gives a row with the reason (``skipped``, or ``reloaded`` if it has a model);
    a failing fit gives its error (``failed``). With ``retrain=True`` only SKUs with features come out.
    """
    cols = ["sku", "date", target] + feature_cols
    first, again = _portfolio_fn(feature_cols, target, min_rows, test_share, params or GBT_PARAMS, retrain)
    if prior is None:
        return in_series(features.select(*cols)).mapInPandas(first, MODEL_SCHEMA)
    n = training_partitions(features)
    groups = n * GROUPS * (64 if max(leaf_bytes(features), default=0) >= UNKNOWN_BYTES else 1)     # unknown: about one a series
    group = F.pmod(F.xxhash64("sku"), F.lit(groups)).alias("_group")
    dealt = lambda df, names: df.select(group, *names).repartition(n, "_group").groupBy("_group")
    return dealt(features, cols).cogroup(dealt(prior, MODEL_COLS)).applyInPandas(again, MODEL_SCHEMA)


def _score_fn(target: str, test_share: float):
    def score(key, feats: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in SCORE_SCHEMA.split(", ")]
        if feats.empty or models.empty:
            return pd.DataFrame(columns=names)
        latest = models.sort_values("version").iloc[-1]
        try:
            feats = feats.sort_values("date", kind="stable")
            p = np.maximum(HistGBT.from_bytes(latest["model"]).predict(
                feats[list(latest["feature_columns"])].to_numpy(dtype=float)), 0)
        except Exception as exc:  # an unreadable model is reported and skipped, it does not end the job (S15)
            row = dict.fromkeys(names) | dict(sku=latest["sku"], model_version=latest["version"],
                                              error=f"{type(exc).__name__}: {exc}")
            return pd.DataFrame({name: pd.Series([row[name]], dtype=object) for name in names})
        n = len(feats)
        n_val = int(math.ceil(test_share * n))
        split = np.where(np.arange(n) >= n - n_val, "val", "train")
        return pd.DataFrame({"sku": feats["sku"].to_numpy(), "date": feats["date"].to_numpy(),
                             "actual": feats[target].to_numpy(dtype=float), "predicted": p, "split": split,
                             "model_version": latest["version"], "error": None}, columns=names)
    return score


def score(features: DataFrame, models: DataFrame, target: str = "units_sold",
          test_share: float = TEST_SHARE) -> DataFrame:
    """Predictions (floored at 0) for every row of every trained SKU, by its latest model.

    A SKU whose model cannot be read gives one row with its error.
    """
    m = models.where(F.col("model").isNotNull()).select("sku", "model", "feature_columns", "version")
    return (features.groupBy("sku").cogroup(m.groupBy("sku"))
            .applyInPandas(_score_fn(target, test_share), SCORE_SCHEMA))


def predict_tail(features: DataFrame, models: DataFrame, horizon: int = 7, target: str = "units_sold") -> DataFrame:
    """Score the last ``horizon`` observed rows of each SKU, with the model version (Q8).

    A SKU whose model cannot be read has one row with its error and no forecast.
    """
    t = tail_rows(features, horizon)
    s = score(t, models, target, test_share=1.0)
    return s.select("sku", "date", F.col("predicted").alias("forecast"), "model_version", "error")


def feature_importance(models: DataFrame) -> DataFrame:
    """(sku, feature, importance, rank) from the stored feature list (Q9)."""
    z = models.where(F.col("importance").isNotNull()).select(
        "sku", F.explode(F.arrays_zip(F.col("feature_columns").alias("feature"),
                                      F.col("importance").alias("importance"))).alias("z"))
    out = z.select("sku", F.col("z.feature").alias("feature"), F.col("z.importance").alias("importance"))
    w = Window.partitionBy("sku").orderBy(F.col("importance").desc(), "feature")
    return out.withColumn("rank", F.row_number().over(w))


def cv_fold_metrics(features: DataFrame, feature_cols: list[str], target: str = "units_sold",
                    folds: int = CV_FOLDS, min_rows: int = MIN_TRAIN_ROWS, params: dict | None = None) -> DataFrame:
    """M5: expanding-window folds, each fold model scored on its block (emitted, Q6).

    The models of ``HistGBT`` without early stopping, fitted in the JVM (``FoldFits.java``) from the sorted partitions:
    a fold's metrics are all that is kept of it, so no row goes to a Python worker.
    """
    p = HistGBT(**(params or GBT_PARAMS))
    numbers = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate([target, *feature_cols])]
    rows = in_series(features.select("sku", "date", target, *feature_cols)).select("sku", "_rn", *numbers)
    settings = (len(feature_cols), folds, min_rows, p.n_estimators, p.max_depth, p.max_bin, float(p.learning_rate),
                float(p.reg_lambda), float(p.min_child_weight), float(p.gamma))
    return map_partitions(rows, "FoldFits", settings, FOLD_SCHEMA)


def retrain_subset(features: DataFrame, skus: DataFrame, feature_cols: list[str], prior: DataFrame) -> DataFrame:
    """Retrain only the given SKUs; versions continue from ``prior``."""
    sub = features.join(skus.select("sku").distinct(), "sku", "left_semi")
    return train_models(sub, feature_cols, prior=prior)


def replace_predictions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Predictions of retrained SKUs replace the old ones (anti-join + union)."""
    return old.join(new.select("sku").distinct(), "sku", "left_anti").unionByName(new)


def first_skus(df: DataFrame, n: int) -> DataFrame:
    """M3: restrict to the first ``n`` SKUs in sorted order (a user-requested limit).

    The SKU list is a distributed top-n; the planner picks the semi-join.
    """
    keep = df.select("sku").distinct().orderBy("sku").limit(n)
    return df.join(keep, "sku", "left_semi")


def train_pooled(features: DataFrame, feature_cols: list[str], target: str = "units_sold",
                 test_share: float = TEST_SHARE, max_iter: int = 100, max_depth: int = 5, step: float = 0.1,
                 seed: int = 42, validation_tol: float = 0.0):
    """M6, pooled form: one Spark ML ``GBTRegressor`` over every SKU's rows.

    Each SKU's chronological hold-out (M4) is the validation set that drives
    early stopping (``validationIndicatorCol``); ``validationTol`` is set
    explicitly (the default stops after very few trees). Training is a
    distributed Spark job per boosting iteration. Returns (model, assembled frame).
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from shelfcast.operators.evaluate import holdout_split
    split = holdout_split(features.select("sku", "date", target, *feature_cols), test_share)
    data = VectorAssembler(inputCols=feature_cols, outputCol="features").transform(
        split.withColumn("is_val", F.col("split") == "val").withColumn("label", F.col(target).cast("double")))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step, seed=seed, validationIndicatorCol="is_val", validationTol=validation_tol,
                       maxBins=256)
    return gbt.fit(data), data


def score_pooled(model, data: DataFrame, target: str = "units_sold") -> DataFrame:
    """M9 for the pooled model: (sku, date, actual, predicted >= 0, split)."""
    return model.transform(data).select("sku", "date", F.col(target).cast("double").alias("actual"),
                                        F.greatest(F.col("prediction"), F.lit(0.0)).alias("predicted"), "split")


def forecast_one(features: DataFrame, sku: str, feature_cols: list[str], horizon: int = 7) -> DataFrame:
    """Train one SKU's model and score its last ``horizon`` observed rows."""
    one = features.where(F.col("sku") == sku)
    return predict_tail(one, train_models(one, feature_cols), horizon)
