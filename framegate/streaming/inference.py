"""The serving metrics as Structured Streaming jobs over the inference log."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from framegate.config import DriftConfig
from framegate.functions.longform import scalar_struct
from framegate.functions.nulls import holds, ratio
from framegate.functions.status import overall
from framegate.operators.anomaly import Bounds, flag_outliers
from framegate.operators.distribution import drift_from_saved, save_distribution
from framegate.operators.drift import profile_drift
from framegate.operators.profiling import profile
from framegate.operators.scoring import prediction_columns, validate_payloads
from framegate.sources.readers import EVENT_SCHEMA, parse_events
from framegate.session import checkpoint
from framegate.sources.event_store import publish_events
from framegate.sources.writers import failed_events

WATERMARK = "10 minutes"
SKETCH_ACCURACY = 1000


def event_stream(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, max_files: int | None = None) -> DataFrame:
    """Parsed inference events from a growing folder of JSON-lines files."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_events(reader.text(path), schema)


def validated_stream(events: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Payload and prediction validity per event: stateless, so no watermark is needed."""
    checked = validate_payloads(events, expected)
    return checked.withColumns(prediction_columns(F.col("prediction"), F.col("probability")))


def without_repeats(events: DataFrame, key: str = "request_id", delay: str = WATERMARK) -> DataFrame:
    """First event per request id; ids are remembered for the watermark delay only."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def _watermarked(events: DataFrame, delay: str | None) -> DataFrame:
    """A stream has one watermark: pass no delay where an earlier step has set it."""
    return events.withWatermark("ts", delay) if delay else events


def minute_metrics(
    events: DataFrame, delay: str | None = WATERMARK, window: str = "1 minute", slide: str | None = None
) -> DataFrame:
    """Requests, success rate, mean and p95 latency per tumbling or sliding window.

    The p95 is a bounded sketch: exact percentiles would keep every latency of a window in state.
    """
    ok = F.col("status") == "success"
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    grouped = _watermarked(events, delay).groupBy(span.alias("w"))
    return grouped.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(holds(ok)).alias("successes"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.percentile_approx("latency_ms", 0.95, SKETCH_ACCURACY).alias("p95_latency_ms"),
    ).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "requests",
        ratio(F.col("successes"), F.col("requests")).alias("success_rate"),
        "avg_latency_ms",
        "p95_latency_ms",
    )


def prediction_distribution(events: DataFrame, delay: str | None = WATERMARK, window: str = "1 hour") -> DataFrame:
    """Count, positive rate, mean and p50/p90/p95 probability of successful single inferences per window."""
    single = events.filter("event_type = 'single_inference' and status = 'success'")
    points = F.percentile_approx("probability", [0.5, 0.9, 0.95], SKETCH_ACCURACY)
    return (
        _watermarked(single, delay)
        .groupBy(F.window("ts", window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_predictions"),
            F.avg("prediction").alias("positive_prediction_rate"),
            F.avg("probability").alias("average_probability"),
            points.alias("q"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "total_predictions",
            "positive_prediction_rate",
            "average_probability",
            F.col("q")[0].alias("p50_probability"),
            F.col("q")[1].alias("p90_probability"),
            F.col("q")[2].alias("p95_probability"),
        )
    )


def outlier_stream(rows: DataFrame, bounds: Bounds) -> DataFrame:
    """Outlier flags of arriving rows against the bounds of a saved baseline: stateless."""
    return flag_outliers(rows, bounds)


def drift_per_batch(
    baseline_profile: DataFrame,
    reference: DataFrame,
    columns: Sequence[str],
    sink: str,
    cfg: DriftConfig = DriftConfig(),
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` step: profile drift and two-sample tests of every micro-batch, appended to `sink`.

    The reference is counted and ordered here, once, under `sink`/reference; a batch looks its own values up
    in it and never adds up its counts again. A batch is written under its own id and overwritten on a
    retry, so results appear once.
    """
    counted = save_distribution(reference, f"{sink}/reference", columns)
    baseline_profile = checkpoint(baseline_profile)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns).persist()
        try:
            if rows.isEmpty():
                return
            changes = profile_drift(profile(rows), baseline_profile, cfg)
            gate = overall(changes)
            tests, summary = drift_from_saved(counted, rows)
            changes.write.mode("overwrite").parquet(f"{sink}/profile/batch={batch_id}")
            tests.write.mode("overwrite").parquet(f"{sink}/tests/batch={batch_id}")
            s = scalar_struct(summary)
            whole = gate.select("*", *[s[c].alias(c) for c in summary.columns])
            whole.write.mode("overwrite").parquet(f"{sink}/summary/batch={batch_id}")
        finally:
            rows.unpersist()

    return step


def split_failures(log: str, failures: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` step that writes all events and, apart, the failed ones."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").json(f"{log}/batch={batch_id}")
            failed_events(batch).write.mode("overwrite").json(f"{failures}/batch={batch_id}")
        finally:
            batch.unpersist()

    return step


def publish_batches(root: str, name: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` step into an event store; a batch that is run again is published once. `name` is the stream's."""

    def step(batch: DataFrame, batch_id: int) -> None:
        publish_events(batch, root, f"{name}-{batch_id}")

    return step


def run_available(stream: DataFrame, sink: str, state: str, mode: str = "append") -> None:
    """Process everything that has arrived into Parquet files, then stop."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", state)
    query.trigger(availableNow=True).start(sink).awaitTermination()


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], state: str) -> None:
    query: StreamingQuery = (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
