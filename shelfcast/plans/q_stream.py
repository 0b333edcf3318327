"""Registered queries: streaming drift monitor (T1-T3) and its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

import shelfcast.plans.q_prep  # noqa: F401  (registers incremental_merge and its oracle first)
from shelfcast.plans.oracle_base import fin, with_adapter
from shelfcast.plans.q_drift import DETECT_SQL, EVENTS_RES_DEF
from shelfcast.plans.q_forecast import ADWIN_REC_SQL, DDM_REC_SQL, EVENTS_REPLAY_SQL, REPLAY_TAIL
from shelfcast.plans.registry import ORACLE
from shelfcast.sources import fixture as fx
from shelfcast.sources import store
from shelfcast.streaming import pos_stream as ps
from shelfcast.sources.tables import read_table
from shelfcast.streaming import drift_stream as ds
from shelfcast.plans.registry import query


MONITOR_SQL = EVENTS_REPLAY_SQL + fin("""
SELECT r.sku, r.event_id, CAST(r.ts AS TIMESTAMP) AS ts, false AS late, r.n, r.actual, r.predicted, r.residual,
       p.drift_detected, p.detectors, p.severity, p.message
FROM res r JOIN rp2 p ON p.sku = r.sku AND p.n = r.n""", ints=["event_id", "n"],
    dbls=["actual", "predicted", "residual", "severity"], keep=["sku", "ts", "late", "drift_detected", "detectors", "message"])

# Late arrivals: every 40th event reaches the stream one stretch (a fifth of the time span) later.
# A row is late if its SKU had a later position in an earlier stretch; the others are replayed in order.
SLICED_SQL = """
sliced AS (
  SELECT CAST(user_id AS VARCHAR) AS sku, event_id, CAST(ts AS TIMESTAMP) AS ts, value,
         CAST(floor(5.0 * (epoch_us(CAST(ts AS TIMESTAMP)) - lo) / (hi - lo + 1)) AS BIGINT)
         + CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END AS slice
  FROM events, (SELECT min(epoch_us(CAST(ts AS TIMESTAMP))) AS lo, max(epoch_us(CAST(ts AS TIMESTAMP))) AS hi FROM events)),
arrived AS (
  SELECT *, COALESCE((ts, event_id) < max((ts, event_id)) OVER (
    PARTITION BY sku ORDER BY slice RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM sliced),
"""
LATE_REPLAY_SQL = with_adapter(SLICED_SQL + EVENTS_RES_DEF.replace("CAST(user_id AS VARCHAR) AS sku", "sku").replace(
    "FROM events WINDOW w AS (PARTITION BY user_id", "FROM arrived WHERE NOT late WINDOW w AS (PARTITION BY sku")
    + DETECT_SQL) + DDM_REC_SQL + ADWIN_REC_SQL + REPLAY_TAIL


def _wall_clock(df):
    """Event times as TIMESTAMP_NTZ: the same wall-clock values whatever the reader's zone."""
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_drift", sql=MONITOR_SQL)
def stream_drift(spark, sf_dir):
    """T1/T2 on the ``events`` table: arrivals are written as files in time order
    and consumed one stretch of time (its files) per micro-batch by the stateful monitor
    (``availableNow``), so state is carried across batches."""
    obs = ds.events_as_observations(read_table(spark, sf_dir, "events"))
    src = store.unique_path(spark, "events_stream_src")
    each = ds.write_arrivals(obs, src)
    return _wall_clock(ds.run_to_table(spark, src, obs.schema, store.unique_path(spark, "stream_out"),
                                       store.unique_path(spark, "stream_ckpt"), max_files=each))


@query("events_drift_batch", sql=MONITOR_SQL)
def events_drift_batch(spark, sf_dir):
    """Batch twin of ``stream_drift`` (same oracle)."""
    return _wall_clock(ds.batch_monitor(ds.events_as_observations(read_table(spark, sf_dir, "events"))))


def late_arrivals(spark, sf_dir):
    """The events as arrival slices: every 40th event comes one slice later than its time."""
    obs = ds.events_as_observations(read_table(spark, sf_dir, "events"))
    at = F.unix_micros("ts")
    span = obs.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    on_time = F.floor(5.0 * (at - F.lit(span.lo or 0)) / F.lit((span.hi or 0) - (span.lo or 0) + 1))
    return obs.withColumn("slice", on_time + F.when(F.col("event_id") % 40 == 0, 1).otherwise(0))


def late_outputs(spark, sf_dir):
    """The three outputs of one stream over late arrivals; a slice is a micro-batch."""
    arrivals = late_arrivals(spark, sf_dir)
    src = store.unique_path(spark, "late_stream_src")
    each = ds.write_slices(arrivals, src, "slice")
    return ds.run_to_outputs(spark, src, arrivals.drop("slice").schema, store.unique_path(spark, "late_out"),
                             store.unique_path(spark, "late_ckpt"), max_files=each)


@query("stream_late_counts", sql=LATE_REPLAY_SQL + """
SELECT sku, slice - (SELECT min(slice) FROM arrived) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE late) AS BIGINT) AS n_late FROM arrived GROUP BY sku, slice""")
def stream_late_counts(spark, sf_dir):
    """Rows and late rows of each SKU and micro-batch, written beside the verdicts."""
    return late_outputs(spark, sf_dir)["late"].select("sku", F.col("batch_id").cast("bigint").alias("batch_id"), "n_rows", "n_late")


@query("stream_events", sql=LATE_REPLAY_SQL + fin("""
SELECT p.sku, p.n, r.event_id, r.ts, p.detectors, p.severity, p.message FROM rp2 p JOIN res r ON r.sku = p.sku AND r.n = p.n
WHERE p.drift_detected""", ints=["n", "event_id"], dbls=["severity"], keep=["sku", "ts", "detectors", "message"]))
def stream_events(spark, sf_dir):
    """D8 on the stream: dated drift events; late rows do not touch the detectors."""
    return _wall_clock(late_outputs(spark, sf_dir)["events"].drop("batch_id"))


@query("stream_pos_history", sql=ORACLE["incremental_merge"])
def stream_pos_history(spark, sf_dir):
    """history = POS before 2000; arrivals = POS from mid-1999 on (units + 1), a batch a half-year, with the
    rows of 2000 again in later files (units + 2), merged batch by batch so that existing rows win. Same result as the
    batch ``incremental_merge`` (J11), hence the same oracle."""
    pos = fx.pos(spark, sf_dir).select("sku", "date", "units_sold")
    history = pos.where(F.col("date") < F.lit("2000-01-01").cast("date")).withColumn("src", F.lit(0))
    half = (F.year("date") - 1999) * 2 + F.when(F.month("date") > 6, 1).otherwise(0)
    late = pos.where(F.col("date") >= F.lit("1999-07-01").cast("date"))
    again = late.where(F.year("date") == 2000)
    arrivals = (late.select("sku", "date", (F.col("units_sold") + 1).alias("units_sold"), half.alias("wave"))
                .unionByName(again.select("sku", "date", (F.col("units_sold") + 2).alias("units_sold"), (half + 4).alias("wave")))
                .withColumn("src", F.lit(1)).withColumn("src_order", F.col("wave")))
    src = store.unique_path(spark, "pos_arrivals")
    each = ds.write_slices(arrivals, src, "wave")
    return ps.stream_into_history(spark, history, src, arrivals.drop("wave").schema, store.unique_path(spark, "pos_history"),
                                  store.unique_path(spark, "pos_history_ckpt"), max_files=each, slices=ps.slices_for(history))
