"""Inference log to monitoring reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from framegate.operators import drift, evaluation, monitoring, scoring
from framegate.sources.readers import read_events, read_table
from framegate.sources.writers import write_report


@dataclass(frozen=True)
class MonitoringConfig:
    log_path: str
    reports_dir: str
    features: Sequence[str]
    reference_path: str | None = None
    exclude: Sequence[str] = ()


def run_monitoring_cycle(spark: SparkSession, cfg: MonitoringConfig) -> dict[str, DataFrame]:
    """Request, payload, prediction and drift reports from one log, each written and returned."""
    events = read_events(spark, cfg.log_path)
    single = events.filter("event_type = 'single_inference'")
    out = {
        "requests": monitoring.request_metrics(events),
        "payloads": monitoring.data_reliability(scoring.validate_payloads(single, cfg.features)),
        "predictions": monitoring.prediction_reliability(scoring.validate_predictions(single)),
        "prediction_distribution": monitoring.prediction_monitor(events),
    }
    if cfg.reference_path:
        reference = read_table(spark, cfg.reference_path, strict=True)
        current = monitoring.logged_features(events, cfg.features)
        out["drift_tests"], out["drift"] = drift.dataset_drift(reference, current, cfg.exclude)
    for name, df in out.items():
        write_report(df, f"{cfg.reports_dir}/{name}", "json")
    return out


def check_decay(
    labelled: DataFrame, label: str, prediction: str, reference: Mapping[str, float], threshold: float = 0.05
) -> DataFrame:
    """Metrics of predictions joined with their later labels against reference values."""
    return evaluation.metric_decay(evaluation.label_metrics(labelled, label, prediction), reference, threshold)
