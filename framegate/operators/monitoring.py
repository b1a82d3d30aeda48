"""Serving metrics from inference logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.functions.longform import scalar_struct
from framegate.functions.nulls import col, holds, ratio
from framegate.functions.quantiles import exact_quantiles

# Requests whose latency counts, and the window of the throughput count.
HISTORY = 5000
RECENT_SECONDS = 60


def prediction_reliability(df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """One row over rows with a `prediction_valid` flag; rates of valid predictions only, rounded to 4."""
    return df.agg(*prediction_reliability_aggregates(prediction, probability)).select(*prediction_reliability_result())


def prediction_reliability_aggregates(prediction: str, probability: str) -> list[Column]:
    valid = holds(F.col("prediction_valid"))
    return [
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(~valid).alias("invalid_prediction_count"),
        F.count_if(valid & (col(prediction) == 1)).alias("positive"),
        F.coalesce(F.sum(F.when(valid, col(probability).cast("double"))), F.lit(0.0)).alias("probability_sum"),
    ]


def prediction_reliability_result() -> list[Column]:
    good = F.col("total_predictions") - F.col("invalid_prediction_count")
    return [
        F.col("total_predictions"),
        F.col("invalid_prediction_count"),
        F.round(ratio(good, F.col("total_predictions")), 4).alias("prediction_validity_rate"),
        F.round(ratio(F.col("positive"), good), 4).alias("positive_prediction_rate"),
        F.round(ratio(F.col("probability_sum"), good), 4).alias("average_probability"),
    ]


def data_reliability(df: DataFrame) -> DataFrame:
    """One row over validated payloads (see `scoring.validate_payloads`)."""
    valid = holds(F.col("payload_valid"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total_payloads"),
        F.count_if(valid).alias("valid_payload_count"),
        F.count_if(~valid).alias("invalid_payload_count"),
        F.round(ratio(F.count_if(valid), n), 4).alias("schema_validity_rate"),
        F.round(ratio(F.count_if(~valid), n), 4).alias("invalid_payload_rate"),
        total("missing_count").alias("total_missing_features"),
        total("unexpected_count").alias("total_unexpected_features"),
        total("invalid_value_count").alias("total_invalid_values"),
    )


def request_metrics(
    events: DataFrame, now: Column | None = None, order: Sequence[str] = ("ts", "request_id"), history: int = HISTORY
) -> DataFrame:
    """One row of request totals, latency of the latest `history` requests and requests of the last minute.

    Columns read: ts, event_type, status, latency_ms, n_rows. The latest requests come from a
    distributed top-k, which is bounded by `history`. The throughput counts every event of the
    minute up to `now`, which defaults to the latest event time, and of the time after it.
    """
    ok = F.col("status") == "success"
    batch = F.col("event_type") == "batch_inference"
    totals = events.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(holds(ok)).alias("success"),
        F.count_if(holds(F.col("event_type") == "single_inference")).alias("single_inference_count"),
        F.count_if(holds(batch)).alias("batch_request_count"),
        F.coalesce(F.sum(F.when(batch, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("total_batch_rows"),
    )
    last = events.orderBy(*[F.desc(o) for o in order]).limit(history).select("latency_ms")
    r = scalar_struct(last.agg(F.avg("latency_ms").alias("avg"), F.percentile("latency_ms", F.lit(0.95)).alias("p95")))
    latest = now if now is not None else scalar_struct(events.agg(F.max("ts").alias("latest")))["latest"]
    since = latest - F.expr(f"INTERVAL {RECENT_SECONDS} SECONDS")
    rpm = scalar_struct(events.filter(F.col("ts") >= since).agg(F.count(F.lit(1)).alias("rpm")))["rpm"]
    n = F.col("total_requests")
    return totals.select(
        "total_requests",
        F.round(ratio(F.col("success"), n), 4).alias("success_rate"),
        F.round(ratio(n - F.col("success"), n), 4).alias("error_rate"),
        F.round(F.coalesce(r["avg"], F.lit(0.0)), 3).alias("avg_latency_ms"),
        F.round(F.coalesce(r["p95"], F.lit(0.0)), 3).alias("p95_latency_ms"),
        rpm.alias("throughput_requests_per_min"),
        "single_inference_count",
        "batch_request_count",
        "total_batch_rows",
        F.round(ratio(F.col("total_batch_rows"), F.col("batch_request_count")), 3).alias("avg_rows_per_batch"),
    )


def prediction_monitor(events: DataFrame, include_failed: bool = False) -> DataFrame:
    """One row: count, positive rate, mean and p50/p90/p95 probability of single inferences, rounded to 4.

    Failed events carry -1 marks and are left out unless `include_failed`.
    """
    single = events.filter(F.col("event_type") == "single_inference")
    if not include_failed:
        single = single.filter(F.col("status") == "success")
    points = exact_quantiles(single, ["probability"], [0.5, 0.9, 0.95])["probability"]
    if points[0] is None:
        raise ValueError("No predictions found in the log")
    named = dict(zip(("p50_probability", "p90_probability", "p95_probability"), points))
    return single.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.round(F.avg("prediction"), 4).alias("positive_prediction_rate"),
        F.round(F.avg("probability"), 4).alias("average_probability"),
        *[F.round(F.max(F.lit(v)), 4).alias(n) for n, v in named.items()],
    )


def logged_features(events: DataFrame, features: Sequence[str], only_successful: bool = True) -> DataFrame:
    """The logged payloads of single inferences as a table with one column per feature."""
    single = events.filter(F.col("event_type") == "single_inference")
    if only_successful:
        single = single.filter(F.col("status") == "success")
    return single.select(*[F.col("features")[f].alias(f) for f in features])


def logged_feature_names(events: DataFrame) -> DataFrame:
    """(feature): the distinct payload keys of the log."""
    names = events.filter(F.col("features").isNotNull()).select(F.explode(F.map_keys("features")).alias("feature"))
    return names.distinct()
