"""Scoring, payload checks and log metrics on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framegate.bindings.models import _QUALITY_FEATURES, _quality, _setup, _SMALL_FOREST
from framegate.bindings.registry import INFERENCES, SCORED, inferences, query, rounded, scored
from framegate.operators import monitoring, preparation, scoring, tuning
from framegate.session import shared_dir
from framegate.sources import writers


@query("threshold_decision", f"WITH {SCORED} SELECT event_id, ROUND(p, 9) AS p, CAST(p >= 0.42::DOUBLE AS INTEGER) AS prediction, 0.42::DOUBLE AS threshold_used FROM scored")
def threshold_decision(spark, d):
    return rounded(scoring.decide(scored(spark, d).select("event_id", "p"), "p", 0.42), 9)


@query(
    "row_responses",
    f"WITH {SCORED} SELECT event_id, ROUND(p, 6) AS probability, CAST(p >= 0.5::DOUBLE AS INTEGER) AS prediction, 0.5::DOUBLE AS threshold_used FROM scored",
)
def row_responses(spark, d):
    return scoring.serve_rows(scored(spark, d).select("event_id", "p"), "p", 0.5)


@query(
    "batch_scoring",
    """WITH o AS (SELECT doc_id, quality, CAST(n_chars AS DOUBLE) AS chars, CAST('0x' || SUBSTR(MD5(CONCAT_WS('|', CAST(doc_id AS VARCHAR), '42')), 1, 13) AS BIGINT) AS h
  FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY h) - 1 AS rn, COUNT(*) OVER (PARTITION BY quality) AS n FROM o)
SELECT doc_id, quality, chars, 0.6::DOUBLE AS threshold_used, TRUE AS decided, TRUE AS inside FROM r WHERE rn < FLOOR(n * 0.2::DOUBLE + 0.5)""",
)
def batch_scoring(spark, d):
    """Train on one part, save the package, load it and score the other part: input columns stay, the threshold decides."""
    import uuid

    split = preparation.stratified_split(_quality(spark, d), "quality", ["doc_id"], portable=True)
    model = tuning.train_final(split.filter(~F.col("is_test")), _setup(), _SMALL_FOREST)
    folder = f"{shared_dir(spark)}/framegate/package-{uuid.uuid4().hex}"
    scoring.ModelPackage(model, _QUALITY_FEATURES, 0.6, "quality", "p1").save(spark, folder)
    scored = scoring.score_batch(split.filter("is_test"), scoring.ModelPackage.load(spark, folder))
    return scored.select(
        "doc_id",
        "quality",
        "chars",
        "threshold_used",
        (F.col("prediction") == (F.col("prediction_proba") >= 0.6).cast("int")).alias("decided"),
        F.col("prediction_proba").between(0.0, 1.0).alias("inside"),
    )


# The payload of an event: {"k": n}, with an unexpected "x" for clicks and "m" for purchases, which
# is NULL from 20 on; expected are k and m.
_PAYLOADS = f"""{INFERENCES}, checked AS (SELECT i.event_id,
  CAST(e.event_type <> 'purchase' AS INTEGER) AS missing_count, CAST(e.event_type = 'click' AS INTEGER) AS unexpected_count,
  CAST(e.event_type = 'purchase' AND e.value >= 20 AS INTEGER) AS invalid_value_count,
  e.event_type = 'purchase' AND e.value < 20 AS payload_valid,
  CASE WHEN e.event_type = 'click' THEN 'Missing features: [m] | Unexpected features: [x]' WHEN e.event_type <> 'purchase' THEN 'Missing features: [m]'
    WHEN e.value >= 20 THEN 'Invalid numeric values for: [m]' END AS payload_error
  FROM inferences i JOIN events e USING (event_id) WHERE JSON_EXISTS(e.props, '$.k'))"""


def _payloads(spark, d):
    return scoring.validate_payloads(inferences(spark, d), ["k", "m"])


@query("payload_validity", f"WITH {_PAYLOADS} SELECT * FROM checked")
def payload_validity(spark, d):
    return _payloads(spark, d).select(
        "event_id", "missing_count", "unexpected_count", "invalid_value_count", "payload_valid", "payload_error"
    )


@query(
    "data_reliability",
    f"""WITH {_PAYLOADS} SELECT COUNT(*) AS total_payloads, COUNT(*) FILTER (payload_valid) AS valid_payload_count, COUNT(*) FILTER (NOT payload_valid) AS invalid_payload_count,
ROUND(COUNT(*) FILTER (payload_valid) / COUNT(*), 4) AS schema_validity_rate, ROUND(COUNT(*) FILTER (NOT payload_valid) / COUNT(*), 4) AS invalid_payload_rate,
CAST(SUM(missing_count) AS BIGINT) AS total_missing_features, CAST(SUM(unexpected_count) AS BIGINT) AS total_unexpected_features,
CAST(SUM(invalid_value_count) AS BIGINT) AS total_invalid_values FROM checked""",
)
def data_reliability(spark, d):
    return monitoring.data_reliability(_payloads(spark, d))


_VALID = "prediction IN (0, 1) AND probability BETWEEN 0 AND 1"


@query(
    "prediction_validity",
    f"""WITH {INFERENCES} SELECT event_id, {_VALID} AS prediction_valid, CASE WHEN prediction NOT IN (0, 1) THEN 'Invalid prediction value: ' || prediction
WHEN NOT probability BETWEEN 0 AND 1 THEN 'Probability out of range [0,1]: ' || probability END AS prediction_error FROM inferences""",
)
def prediction_validity(spark, d):
    return scoring.validate_predictions(inferences(spark, d)).select("event_id", "prediction_valid", "prediction_error")


@query(
    "prediction_reliability",
    f"""WITH {INFERENCES} SELECT COUNT(*) AS total_predictions, COUNT(*) FILTER (NOT ({_VALID})) AS invalid_prediction_count,
ROUND(COUNT(*) FILTER ({_VALID}) / COUNT(*), 4) AS prediction_validity_rate, ROUND(COUNT(*) FILTER ({_VALID} AND prediction = 1) / COUNT(*) FILTER ({_VALID}), 4) AS positive_prediction_rate,
ROUND(AVG(probability) FILTER ({_VALID}), 4) AS average_probability FROM inferences""",
)
def prediction_reliability(spark, d):
    return monitoring.prediction_reliability(scoring.validate_predictions(inferences(spark, d)))


@query(
    "request_metrics",
    f"""WITH {INFERENCES}, last AS (SELECT ts, latency_ms FROM inferences ORDER BY ts DESC, event_id DESC LIMIT 5000),
l AS (SELECT ROUND(AVG(latency_ms), 3) AS a, ROUND(QUANTILE_CONT(latency_ms, 0.95), 3) AS p, COUNT(*) FILTER (ts >= (SELECT MAX(ts) FROM inferences) - INTERVAL 60 SECONDS) AS r FROM last)
SELECT COUNT(*) AS total_requests, ROUND(COUNT(*) FILTER (status = 'success') / COUNT(*), 4) AS success_rate, ROUND(COUNT(*) FILTER (status <> 'success') / COUNT(*), 4) AS error_rate,
  ANY_VALUE(a) AS avg_latency_ms, ANY_VALUE(p) AS p95_latency_ms, ANY_VALUE(r) AS throughput_requests_per_min,
  COUNT(*) FILTER (event_type = 'single_inference') AS single_inference_count, COUNT(*) FILTER (event_type = 'batch_inference') AS batch_request_count,
  CAST(SUM(n_rows) FILTER (event_type = 'batch_inference') AS BIGINT) AS total_batch_rows, ROUND(AVG(n_rows) FILTER (event_type = 'batch_inference'), 3) AS avg_rows_per_batch
FROM inferences, l""",
)
def request_metrics(spark, d):
    return monitoring.request_metrics(inferences(spark, d), order=("ts", "event_id"))


_MONITOR = """SELECT COUNT(*) AS total_predictions, ROUND(AVG(prediction), 4) AS positive_prediction_rate, ROUND(AVG(probability), 4) AS average_probability,
ROUND(QUANTILE_CONT(probability, 0.5), 4) AS p50_probability, ROUND(QUANTILE_CONT(probability, 0.9), 4) AS p90_probability,
ROUND(QUANTILE_CONT(probability, 0.95), 4) AS p95_probability FROM inferences WHERE event_type = 'single_inference'"""


@query("prediction_monitor", f"WITH {INFERENCES} {_MONITOR} AND status = 'success'")
def prediction_monitor(spark, d):
    return monitoring.prediction_monitor(inferences(spark, d))


@query("prediction_monitor_with_failed", f"WITH {INFERENCES} {_MONITOR}")
def prediction_monitor_with_failed(spark, d):
    return monitoring.prediction_monitor(inferences(spark, d), include_failed=True)


@query(
    "logged_features",
    """SELECT CAST(JSON_EXTRACT(props, '$.k') AS DOUBLE) AS k, CASE WHEN event_type = 'purchase' AND value < 20 THEN value END AS m,
CASE WHEN event_type = 'click' THEN value END AS x FROM events WHERE event_type NOT IN ('view', 'error')""",
)
def logged_features(spark, d):
    log = inferences(spark, d)
    return monitoring.logged_features(log, sorted(r["feature"] for r in monitoring.logged_feature_names(log).collect()))


@query("failed_events", f"WITH {INFERENCES} SELECT request_id, prediction, probability, latency_ms FROM inferences WHERE status = 'failed'")
def failed_events(spark, d):
    return writers.failed_events(inferences(spark, d)).select("request_id", "prediction", "probability", "latency_ms")


@query(
    "scored_events",
    f"""WITH {_PAYLOADS} SELECT CAST(event_id AS VARCHAR) AS request_id, CASE WHEN payload_valid THEN 'success' ELSE 'failed' END AS status,
CASE WHEN payload_valid THEN CAST(value / (value + 50) >= 0.2::DOUBLE AS INTEGER) ELSE -1 END AS prediction,
CASE WHEN payload_valid THEN ROUND(value / (value + 50), 6) ELSE -1.0::DOUBLE END AS probability, ROUND(value, 3) AS latency_ms, payload_error AS error_message
FROM checked JOIN events USING (event_id)""",
)
def scored_events(spark, d):
    rows = _payloads(spark, d).withColumn("p", F.col("latency_ms") / (F.col("latency_ms") + 50))
    out = scoring.single_events(
        rows, "p1", 0.2, request_id=F.col("event_id"), at=F.col("ts"), probability="p", latency_ms=F.col("latency_ms")
    )
    return out.select("request_id", "status", "prediction", "probability", "latency_ms", "error_message")
