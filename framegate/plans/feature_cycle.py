"""Validated table to feature table: guard, derive, check, explore."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegate.config import CorrelationConfig, FeatureConfig, FeatureQAConfig, LeakageConfig, SkewConfig
from framegate.functions.nulls import numeric_columns
from framegate.functions.status import FAIL, GateError
from framegate.operators import contracts, correlation, eda, features, importance, information, profiling, quality
from framegate.sources.readers import read_table
from framegate.sources.writers import fingerprint, write_report, write_table


@dataclass(frozen=True)
class FeatureCycleConfig:
    input_path: str
    features_path: str
    reports_dir: str
    leakage: LeakageConfig
    features: FeatureConfig
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    exclude: Sequence[str] = ()
    sort_by: Sequence[str] = ()
    qa: FeatureQAConfig = FeatureQAConfig()
    distinct_method: str = "exact"
    explore: bool = True
    skew: SkewConfig = SkewConfig()
    score_method: str = "anova"
    correlation: CorrelationConfig = CorrelationConfig()
    extras: bool = True
    importance_trees: int = 50
    importance_depth: int = 5
    components: int = 10


@dataclass
class FeatureCycleResult:
    table: DataFrame
    reports: dict[str, str] = field(default_factory=dict)
    statuses: dict[str, str] = field(default_factory=dict)


def run_feature_cycle(spark: SparkSession, cfg: FeatureCycleConfig) -> FeatureCycleResult:
    """Leakage, feature contract and quality gate stop the cycle; the exploratory tables only report.

    The feature table is written once, before the exploration, which then scans the file.
    """
    target = cfg.leakage.target
    source = read_table(spark, cfg.input_path)
    result = FeatureCycleResult(source)

    def report(name: str, df: DataFrame, fmt: str = "json") -> str:
        path = f"{cfg.reports_dir}/{name}"
        write_report(df, path, fmt)
        result.reports[name] = path
        return path

    leak = quality.leakage_report(source, cfg.leakage)
    saved = spark.read.schema(leak.schema).json(report("leakage_report", leak)).first()
    result.statuses["leakage"] = saved["status"]
    if cfg.leakage.enabled and saved["status"] == FAIL:
        raise GateError("Leakage guard failed:\n- " + "\n- ".join(saved["details"]))
    safe = quality.without_leaks(source, cfg.leakage)
    wide = features.add_features(safe, cfg.features)

    enabled = {f.name for f in features.enabled_features(cfg.features)}
    contracts.validate_features(wide, {n: r for n, r in cfg.ranges.items() if n in enabled})
    excluded = tuple(dict.fromkeys([*cfg.exclude, target]))
    qa = quality.feature_qa(wide, excluded, cfg.qa, cfg.distinct_method)
    found = spark.read.schema(qa.schema).json(report("feature_qa", qa)).first()
    result.statuses["feature_qa"] = found["status"]
    if found["status"] == FAIL:
        raise GateError("Feature QA failed:\n- " + "\n- ".join(found["details"]))

    write_table(wide, cfg.features_path, cfg.sort_by)
    table = result.table = spark.read.parquet(cfg.features_path)
    columns = numeric_columns(table, excluded)
    if cfg.explore and columns:
        report("target_balance", profiling.target_distribution(table, target, as_percent=True, keep_missing=False))
        report("histograms", eda.histograms(table, columns))
        report("skew_report", eda.skew_report(table, columns, cfg.skew), "csv")
        report("feature_scores", feature_scores(table, target, columns, cfg.score_method), "csv")
    if cfg.correlation.enabled:
        _correlation_step(table, cfg, result, report)
    if cfg.extras and columns:
        report("missing_table", profiling.missing_table(table, columns), "csv")
        report("class_histograms", eda.class_histograms(table, target, columns))
        if len(columns) > 1:
            ranked = importance.forest_importance(
                table, target, columns, trees=cfg.importance_trees, max_depth=cfg.importance_depth
            )
            report("feature_importance", importance.importance_table(table, ranked), "csv")
        if len(columns) > 2:
            report("explained_variance", importance.explained_variance(table, columns, cfg.components), "csv")
    report("feature_manifest", fingerprint(table))
    return result


def feature_scores(df: DataFrame, target: str, columns: Sequence[str], method: str = "anova") -> DataFrame:
    if method == "anova":
        return eda.anova_scores(df, target, columns)
    if method == "mutual_info":
        return information.neighbour_mutual_information(df, target, columns)
    if method == "binned_mutual_info":
        return eda.binned_mutual_information(df, target, columns)
    raise ValueError(f"Unknown score method: {method}")


def _correlation_step(table: DataFrame, cfg: FeatureCycleConfig, result: FeatureCycleResult, report) -> None:
    exclude = tuple(dict.fromkeys([*cfg.correlation.exclude, cfg.leakage.target]))
    columns = numeric_columns(table, exclude)
    if len(columns) < 2:
        result.statuses["correlation"] = "warn"
        return
    scoped = CorrelationConfig(True, cfg.correlation.threshold, cfg.correlation.method, exclude)
    # The pair table is small; the matrix and the high pairs are read from the saved report.
    path = report("correlation_pairs", correlation.correlation_pairs(table, scoped), "parquet")
    pairs = table.sparkSession.read.parquet(path)
    report("correlation_matrix", correlation.correlation_matrix(pairs, columns), "csv")
    high = correlation.high_correlations(pairs, scoped.threshold)
    report("high_correlations", high, "csv")
    result.statuses["correlation"] = "warn" if high.agg(F.count(F.lit(1))).first()[0] else "pass"
