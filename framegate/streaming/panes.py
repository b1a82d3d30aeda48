"""Serving metrics of any sliding window from panes that a stream has closed.

A stream that groups by sliding windows keeps every event's share in as many open windows as cover it. Here it keeps one
row of state per pane, a short stretch of time: counts, sums and two sketches of bounded size. Closed panes are a table, and
windows of any length and slide that are whole numbers of panes are merged from it, long after the events are gone.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.functions.nulls import holds, ratio

PANE = timedelta(minutes=5)
# Up to this many values a sketch is exact; beyond it ranks are off by some 0.3 %, and it stays below 30 kB.
SKETCH_SIZE = 1024


def _span(length: timedelta) -> str:
    return f"{round(length.total_seconds() * 1000)} milliseconds"


def pane_stream(events: DataFrame, delay: str | None = "10 minutes", pane: timedelta = PANE) -> DataFrame:
    """One row per pane with events: counts, sums and sketches of latencies and of single predictions.

    For a stream (append: a pane appears once, when the watermark has passed its end) or a table. Null measures
    count nowhere; a pane whose events have none gives null sums and null or empty sketches.
    """
    timed = events.withWatermark("ts", delay) if delay else events
    single = holds((F.col("event_type") == "single_inference") & (F.col("status") == "success"))
    predicted = lambda c: F.when(single, F.col(c)).cast("double")
    latency = F.col("latency_ms").cast("double")
    sketch = lambda c: F.kll_sketch_agg_double(c, SKETCH_SIZE)
    return (
        timed.groupBy(F.window("ts", _span(pane)).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(holds(F.col("status") == "success")).alias("successes"),
            F.count(latency).alias("latencies"),
            F.sum(latency).alias("latency_sum"),
            sketch(latency).alias("latency_sketch"),
            F.count_if(single).alias("singles"),
            F.count(predicted("prediction")).alias("predictions"),
            F.sum(predicted("prediction")).alias("prediction_sum"),
            F.count(predicted("probability")).alias("probabilities"),
            F.sum(predicted("probability")).alias("probability_sum"),
            sketch(predicted("probability")).alias("probability_sketch"),
        )
        .select(F.col("w.start").alias("pane_start"), F.col("w.end").alias("pane_end"), "*")
        .drop("w")
    )


def _windows(panes: DataFrame, window: timedelta, slide: timedelta | None, pane: timedelta) -> DataFrame:
    """Panes with the windows that cover them, as far as all panes of a window have been closed."""
    slide = slide or window
    if window % pane or slide % pane or slide > window:
        raise ValueError(f"Windows of {window} every {slide} are not made of whole panes of {pane}")
    covered = panes.withColumn("w", F.window("pane_start", _span(window), _span(slide)))
    # Panes close in the order of their ends, so nothing is open before the end of the latest.
    closed = panes.agg(F.struct(F.max("pane_end").alias("end"))).scalar()
    return covered.filter(F.col("w.end") <= closed["end"])


def _points(sketch: str, ranks: tuple[float, ...]) -> Column:
    """Quantiles of the merged sketch; NULL where no value went in."""
    merged = F.kll_merge_agg_double(sketch, SKETCH_SIZE)
    point = lambda r: F.kll_sketch_get_quantile_double(merged, F.lit(r))
    return F.when(F.kll_sketch_get_n_double(merged) > 0, F.array(*[point(r) for r in ranks]))


def request_windows(panes: DataFrame, window: timedelta, slide: timedelta | None = None, pane: timedelta = PANE) -> DataFrame:
    """Requests, success rate, mean and p95 latency of every window with requests that has closed."""
    return (
        _windows(panes, window, slide, pane)
        .groupBy("w")
        .agg(
            F.sum("requests").alias("requests"),
            ratio(F.sum("successes"), F.sum("requests")).alias("success_rate"),
            F.try_divide(F.sum("latency_sum"), F.sum("latencies")).alias("avg_latency_ms"),
            _points("latency_sketch", (0.95,))[0].alias("p95_latency_ms"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def prediction_windows(panes: DataFrame, window: timedelta, slide: timedelta | None = None, pane: timedelta = PANE) -> DataFrame:
    """Count, positive rate, mean and p50/p90/p95 probability of successful single inferences, per closed window with any."""
    return (
        _windows(panes, window, slide, pane)
        .filter("singles > 0")
        .groupBy("w")
        .agg(
            F.sum("singles").alias("total_predictions"),
            F.try_divide(F.sum("prediction_sum"), F.sum("predictions")).alias("positive_prediction_rate"),
            F.try_divide(F.sum("probability_sum"), F.sum("probabilities")).alias("average_probability"),
            _points("probability_sketch", (0.5, 0.9, 0.95)).alias("q"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "*",
            *[F.col("q")[i].alias(f"p{p}_probability") for i, p in enumerate((50, 90, 95))],
        )
        .drop("w", "q")
    )
