"""The serving metrics as streams over the events table, run until all input is processed."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from framegate.bindings.profiles import KS_P
from framegate.bindings.registry import INFERENCES, as_inferences, query, rounded, table
from framegate.config import AnomalyConfig
from framegate.operators import anomaly, profiling
from framegate.session import shared_dir
from framegate.sources import event_store
from framegate.streaming import inference, panes


def _event_stream(spark, d):
    """The events table as a file stream (timestamps with zone, as watermarks need them)."""
    schema = table(spark, d, "events").schema
    return as_inferences(spark.readStream.schema(schema).parquet(f"{d}/events*.parquet"))


def _folders(spark, name: str) -> tuple[str, str]:
    base = f"{shared_dir(spark)}/framegate/stream-{name}-{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/state"


def _collected(spark, stream, name: str, mode: str = "append"):
    out, state = _folders(spark, name)
    inference.run_available(stream, out, state, mode)
    return spark.read.schema(stream.schema).parquet(out)


# A window is emitted once the watermark (latest event minus the delay) has passed its end.
_CLOSED = "window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTES"


def _plain_times(df):
    """Window bounds as text, which does not depend on time zone types."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@query(
    "stream_minute_metrics",
    f"""WITH {INFERENCES}, w AS (SELECT DATE_TRUNC('minute', ts) AS window_start, DATE_TRUNC('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  COUNT(*) AS requests, ROUND(COUNT(*) FILTER (status = 'success') / COUNT(*), 6) AS success_rate, ROUND(AVG(latency_ms), 6) AS avg_latency_ms, ROUND(QUANTILE_DISC(latency_ms, 0.95), 6) AS p95_latency_ms FROM inferences GROUP BY ALL)
SELECT STRFTIME(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, STRFTIME(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, requests, success_rate, avg_latency_ms, p95_latency_ms
FROM w WHERE {_CLOSED}""",
)
def stream_minute_metrics(spark, d):
    stream = inference.minute_metrics(_event_stream(spark, d))
    return rounded(_plain_times(_collected(spark, stream, "minutes")))


@query(
    "stream_sliding_metrics",
    f"""WITH {INFERENCES}, w AS (SELECT TIME_BUCKET(INTERVAL 30 MINUTES, ts) - o * INTERVAL 30 MINUTES AS window_start, * FROM inferences, (VALUES (0), (1)) s(o)),
g AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, COUNT(*) AS requests, ROUND(COUNT(*) FILTER (status = 'success') / COUNT(*), 6) AS success_rate,
  ROUND(AVG(latency_ms), 6) AS avg_latency_ms, ROUND(QUANTILE_DISC(latency_ms, 0.95), 6) AS p95_latency_ms FROM w GROUP BY window_start)
SELECT STRFTIME(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, STRFTIME(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, requests, success_rate, avg_latency_ms, p95_latency_ms
FROM g WHERE {_CLOSED}""",
)
def stream_sliding_metrics(spark, d):
    stream = inference.minute_metrics(_event_stream(spark, d), window="1 hour", slide="30 minutes")
    return rounded(_plain_times(_collected(spark, stream, "sliding")))


_PANE = timedelta(minutes=15)
# Panes are closed by the watermark, windows by the end of the latest closed pane.
_PANES_CLOSED = """c AS (SELECT MAX(TIME_BUCKET(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES) AS closed FROM events
  WHERE TIME_BUCKET(INTERVAL 15 MINUTES, ts) + INTERVAL 15 MINUTES <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTES)"""


def _pane_windows(minutes: int, slide: int, measures: str, where: str = "TRUE") -> str:
    return f"""SELECT '{minutes} by {slide}' AS shape, STRFTIME(s, '%Y-%m-%d %H:%M:%S') AS window_start, STRFTIME(s + INTERVAL {minutes} MINUTES, '%Y-%m-%d %H:%M:%S') AS window_end, {measures}
FROM (SELECT TIME_BUCKET(INTERVAL {slide} MINUTES, ts) - o * INTERVAL {slide} MINUTES AS s, * FROM inferences, RANGE({minutes // slide}) r(o)), c
WHERE s + INTERVAL {minutes} MINUTES <= closed AND {where} GROUP BY s"""


_SHAPES = ((30, 15), (120, 60))
_REQUESTS = """COUNT(*) AS requests, ROUND(COUNT(*) FILTER (status = 'success') / COUNT(*), 6) AS success_rate,
  ROUND(SUM(latency_ms), 4) AS latency_sum, ROUND(QUANTILE_DISC(latency_ms, 0.95), 6) AS p95_latency_ms"""
_PREDICTIONS = "COUNT(*) AS total_predictions, ROUND(AVG(prediction), 6) AS positive_prediction_rate, ROUND(AVG(probability), 6) AS average_probability, " + ", ".join(
    f"ROUND(QUANTILE_DISC(probability, 0.{p}), 6) AS p{p}_probability" for p in (50, 90, 95)
)


def _from_panes(spark, d, name: str, merge):
    """Windows of two shapes from the panes of one stream."""
    closed = _collected(spark, panes.pane_stream(_event_stream(spark, d), pane=_PANE), name)
    shaped = [
        merge(closed, timedelta(minutes=m), timedelta(minutes=s), _PANE).select(F.lit(f"{m} by {s}").alias("shape"), "*") for m, s in _SHAPES
    ]
    return rounded(_plain_times(shaped[0].unionByName(shaped[1])))


@query("stream_pane_requests", f"WITH {INFERENCES}, {_PANES_CLOSED} " + " UNION ALL ".join(_pane_windows(m, s, _REQUESTS) for m, s in _SHAPES))
def stream_pane_requests(spark, d):
    """The mean is compared as a sum: means of amounts with two digits often lie halfway between two rounded numbers."""
    found = _from_panes(spark, d, "pane-requests", lambda *shape: _with_sum(panes.request_windows(*shape)))
    return found.drop("avg_latency_ms")


def _with_sum(windows):
    return windows.withColumn("latency_sum", F.round(F.col("avg_latency_ms") * F.col("requests"), 4))


@query(
    "stream_pane_predictions",
    f"WITH {INFERENCES}, {_PANES_CLOSED} "
    + " UNION ALL ".join(_pane_windows(m, s, _PREDICTIONS, "event_type = 'single_inference' AND status = 'success'") for m, s in _SHAPES),
)
def stream_pane_predictions(spark, d):
    return _from_panes(spark, d, "pane-predictions", panes.prediction_windows)


@query(
    "stream_predictions",
    f"""WITH {INFERENCES}, w AS (SELECT DATE_TRUNC('hour', ts) AS window_start, DATE_TRUNC('hour', ts) + INTERVAL 1 HOUR AS window_end, COUNT(*) AS total_predictions,
  ROUND(AVG(prediction), 6) AS positive_prediction_rate, ROUND(AVG(probability), 6) AS average_probability,
  ROUND(QUANTILE_DISC(probability, 0.5), 6) AS p50_probability, ROUND(QUANTILE_DISC(probability, 0.9), 6) AS p90_probability, ROUND(QUANTILE_DISC(probability, 0.95), 6) AS p95_probability FROM inferences
  WHERE event_type = 'single_inference' AND status = 'success' GROUP BY ALL)
SELECT STRFTIME(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, STRFTIME(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, total_predictions, positive_prediction_rate, average_probability,
  p50_probability, p90_probability, p95_probability FROM w WHERE window_end <= (SELECT MAX(ts) FROM inferences WHERE event_type = 'single_inference' AND status = 'success') - INTERVAL 10 MINUTES""",
)
def stream_predictions(spark, d):
    stream = inference.prediction_distribution(_event_stream(spark, d))
    return rounded(_plain_times(_collected(spark, stream, "predictions")))


@query(
    "stream_validated",
    f"""WITH {INFERENCES} SELECT request_id, prediction IN (0, 1) AND probability BETWEEN 0 AND 1 AS prediction_valid, e.event_type = 'purchase' AND e.value < 20 AS payload_valid
FROM inferences i JOIN events e USING (event_id)""",
)
def stream_validated(spark, d):
    stream = inference.validated_stream(_event_stream(spark, d), ["k", "m"])
    return _collected(spark, stream.select("request_id", "prediction_valid", "payload_valid"), "validated")


@query("stream_dedup", f"WITH {INFERENCES} SELECT DISTINCT request_id, status FROM inferences")
def stream_dedup(spark, d):
    events = _event_stream(spark, d)
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return _collected(spark, inference.without_repeats(twice).select("request_id", "status"), "dedup")


@query(
    "stream_outliers",
    """WITH q AS (SELECT QUANTILE_CONT(value, 0.05) AS lo, QUANTILE_CONT(value, 0.95) AS hi FROM events)
SELECT event_id, CAST(value < lo OR value > hi AS INTEGER) AS outlier_count, CASE WHEN value < lo OR value > hi THEN 'latency_ms' ELSE '' END AS outlier_cols FROM events, q""",
)
def stream_outliers(spark, d):
    baseline = as_inferences(table(spark, d, "events")).select("latency_ms")
    bounds = anomaly.quantile_bounds(baseline, AnomalyConfig(q_low=0.05, q_high=0.95))
    flagged = inference.outlier_stream(_event_stream(spark, d).select("event_id", "latency_ms"), bounds)
    return _collected(spark, flagged.select("event_id", "outlier_count", "outlier_cols"), "outliers")


@query(
    "stream_failure_split",
    f"""WITH {INFERENCES} SELECT 'events' AS log, status, COUNT(*) AS n FROM inferences GROUP BY status
UNION ALL SELECT 'failures', status, COUNT(*) FROM inferences WHERE status = 'failed' GROUP BY status""",
)
def stream_failure_split(spark, d):
    out, state = _folders(spark, "split")
    inference.run_batches(_event_stream(spark, d), inference.split_failures(f"{out}/events", f"{out}/failures"), state)
    side = lambda n: spark.read.schema("request_id string, status string").json(f"{out}/{n}/*").withColumn("log", F.lit(n))
    return side("events").unionByName(side("failures")).groupBy("log", "status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_drift_batches",
    """SELECT CAST(COUNT(*) AS BIGINT) AS events, TRUE AS every_batch_drifts FROM events""",
)
def stream_drift_batches(spark, d):
    """Several micro-batches against a reference that is counted once: tests and summary of each."""
    events = as_inferences(table(spark, d, "events")).select("latency_ms")
    out, state = _folders(spark, "batches")
    for k in range(3):
        events.filter(F.pmod(F.xxhash64("latency_ms"), F.lit(3)) == k).coalesce(1).write.parquet(f"{out}/in/part={k}")
    reference = events.select((F.col("latency_ms") * 0.5).alias("latency_ms"))
    stream = spark.readStream.schema("latency_ms double").option("maxFilesPerTrigger", 1).parquet(f"{out}/in/*")
    step = inference.drift_per_batch(profiling.profile(reference), reference, ["latency_ms"], f"{out}/found")
    inference.run_batches(stream, step, state)
    summary = spark.read.parquet(f"{out}/found/summary").agg(F.bool_and("dataset_drift").alias("s"), F.count(F.lit(1)).alias("batches"))
    tests = spark.read.parquet(f"{out}/found/tests").agg(F.bool_and("drifted").alias("t"))
    read = spark.read.schema("latency_ms double").parquet(f"{out}/in/*").agg(F.count(F.lit(1)).alias("events"))
    s, t = summary.first(), tests.first()
    return read.select("events", F.lit(bool(s["s"] and t["t"] and s["batches"] == 3)).alias("every_batch_drifts"))


_BATCH_TESTS = " UNION ALL ".join(
    f"""SELECT statistic, n FROM (SELECT MAX(ABS(fa - fb)) AS statistic FROM (SELECT SUM(a) OVER (ORDER BY x) / (SELECT COUNT(*) FROM events) AS fa,
  SUM(b) OVER (ORDER BY x) / (SELECT COUNT(*) FROM events WHERE event_id % 3 = {k}) AS fb FROM (SELECT x, SUM(a) AS a, SUM(b) AS b FROM
  (SELECT value * 1.1::DOUBLE AS x, 1 AS a, 0 AS b FROM events UNION ALL SELECT value, 0, 1 FROM events WHERE event_id % 3 = {k}) GROUP BY x))),
  (SELECT COUNT(*) AS n FROM events WHERE event_id % 3 = {k})"""
    for k in range(3)
)


@query(
    "stream_drift_tests",
    f"""WITH t AS ({_BATCH_TESTS}), z AS (SELECT statistic, statistic * SQRT(n * (SELECT COUNT(*) FROM events) / (n + (SELECT COUNT(*) FROM events))) AS x FROM t),
p AS (SELECT statistic, CASE WHEN x < 0.2 THEN 1 ELSE {KS_P} END AS p FROM z)
SELECT 'latency_ms' AS feature, ROUND(statistic, 9) AS statistic, ROUND(CAST(p AS DOUBLE), 9) AS p_value, p < 0.05 AS drifted FROM p""",
)
def stream_drift_tests(spark, d):
    """The tests of three micro-batches, each a third of the events, against all of them with other latencies."""
    events = as_inferences(table(spark, d, "events"))
    out, state = _folders(spark, "tests")
    for k in range(3):
        events.filter(F.col("event_id") % 3 == k).select("latency_ms").coalesce(1).write.parquet(f"{out}/in/part={k}")
    reference = events.select((F.col("latency_ms") * 1.1).alias("latency_ms"))
    stream = spark.readStream.schema("latency_ms double").option("maxFilesPerTrigger", 1).parquet(f"{out}/in/*")
    step = inference.drift_per_batch(profiling.profile(reference), reference, ["latency_ms"], f"{out}/found")
    inference.run_batches(stream, step, state)
    return rounded(spark.read.parquet(f"{out}/found/tests").drop("batch"), 9)


@query(
    "stream_published_events",
    f"""WITH {INFERENCES} SELECT 'events' AS log, status, COUNT(*) AS n, ROUND(SUM(latency_ms), 4) AS latency FROM inferences GROUP BY status
UNION ALL SELECT 'failures', status, COUNT(*), ROUND(SUM(latency_ms), 4) FROM inferences WHERE status = 'failed' GROUP BY status""",
)
def stream_published_events(spark, d):
    """Micro-batches into an event store, all run a second time from the first one on, as after a lost checkpoint."""
    out, state = _folders(spark, "published")
    for k in range(3):
        part = table(spark, d, "events").filter(F.col("event_id") % 3 == k)
        part.coalesce(1).write.parquet(f"{out}/in/part={k}")
    schema = table(spark, d, "events").schema
    for run in range(2):
        stream = as_inferences(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in/*"))
        inference.run_batches(stream, inference.publish_batches(f"{out}/store", "events"), f"{state}-{run}")
    side = lambda n: event_store.read_published(spark, f"{out}/store", n).withColumn("log", F.lit(n))
    both = side("events").unionByName(side("failures"))
    return both.groupBy("log", "status").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("latency_ms"), 4).alias("latency"))


@query(
    "stream_drift",
    """WITH b AS (SELECT QUANTILE_CONT(value, 0.5) * 0.7::DOUBLE AS base, QUANTILE_CONT(value, 0.5) AS cur FROM events),
r AS (SELECT ABS(cur - base) / (ABS(base) + 1e-8) AS x FROM b)
SELECT 'latency_ms' AS feature, ROUND(x, 6) AS relative_change, CASE WHEN x >= 0.5 THEN 'fail' WHEN x >= 0.2 THEN 'warn' ELSE 'pass' END AS status FROM r""",
)
def stream_drift(spark, d):
    """Against a baseline in which every latency was 30 % lower."""
    reference = as_inferences(table(spark, d, "events")).select((F.col("latency_ms") * 0.7).alias("latency_ms"))
    out, state = _folders(spark, "drift")
    step = inference.drift_per_batch(profiling.profile(reference), reference, ["latency_ms"], out)
    inference.run_batches(_event_stream(spark, d), step, state)
    return rounded(spark.read.parquet(f"{out}/profile/*").drop("message"))
