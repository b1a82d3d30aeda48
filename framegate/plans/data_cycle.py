"""Raw table to validated table: clean, validate, profile, compare, flag."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.config import (
    AnomalyConfig,
    CleaningConfig,
    ColumnContract,
    DriftConfig,
    Roles,
    StatCheckConfig,
    ValidationConfig,
)
from framegate.functions.status import FAIL, GateError, enforce, overall
from framegate.operators import anomaly, cleaning, contracts, drift, profiling
from framegate.sources.readers import read_csv_contract, read_table
from framegate.sources.writers import fingerprint, write_report, write_table


@dataclass(frozen=True)
class DataCycleConfig:
    raw_path: str
    interim_path: str
    processed_path: str
    reports_dir: str
    roles: Roles
    contract: Sequence[ColumnContract]
    sort_by: Sequence[str] = ()
    cleaning: CleaningConfig = CleaningConfig()
    validation: ValidationConfig = ValidationConfig()
    save_profile: bool = True
    quantile_method: str = "exact"
    distinct_method: str = "exact"
    stats: StatCheckConfig = StatCheckConfig()
    drift_enabled: bool = False
    baseline_path: str | None = None
    fail_on_drift: bool = True
    drift: DriftConfig = DriftConfig()
    anomaly: AnomalyConfig = AnomalyConfig()
    fail_on_anomaly: bool = False
    save_manifest: bool = True


@dataclass
class DataCycleResult:
    table: DataFrame
    reports: dict[str, str] = field(default_factory=dict)
    drift_state: str = "disabled"
    anomaly_status: str = "pass"


# Integers may arrive as text such as `12.0`: they are read as wider numbers and coerced by the contract.
_READ_TYPES = {"int": T.DoubleType(), "bigint": T.DecimalType(38, 6), "double": T.DoubleType(), "float": T.DoubleType()}


def _schema_of(contract: Sequence[ColumnContract]) -> T.StructType:
    return T.StructType([T.StructField(c.name, _READ_TYPES.get(c.type, T.StringType())) for c in contract])


def run_data_cycle(spark: SparkSession, cfg: DataCycleConfig) -> DataCycleResult:
    """Every stage reads the files of the stage before it, so a lost executor never re-runs the whole chain.

    The validated table is written before the statistical gate can fail; drift and outliers
    stop the cycle only where the configuration says so.
    """
    names = [c.name for c in cfg.contract]
    raw = read_csv_contract(spark, cfg.raw_path, names, _schema_of(cfg.contract))
    write_table(cleaning.clean(raw, cfg.roles, cfg.cleaning), cfg.interim_path, cfg.sort_by)

    interim = spark.read.parquet(cfg.interim_path)
    checked = contracts.validate_contract(interim, cfg.contract)
    contracts.validate_rules(checked, cfg.roles, cfg.validation)
    write_table(checked, cfg.processed_path, cfg.sort_by)

    table = spark.read.parquet(cfg.processed_path)
    result = DataCycleResult(table)

    def report(name: str, df: DataFrame, fmt: str = "json") -> str:
        path = f"{cfg.reports_dir}/{name}"
        write_report(df, path, fmt)
        result.reports[name] = path
        return path

    profile_table = None
    if cfg.save_profile:
        path = report("data_profile", profiling.profile(table, method=cfg.quantile_method, distinct=cfg.distinct_method), "parquet")
        profile_table = spark.read.parquet(path)
        if cfg.roles.target:
            report("target_distribution", profiling.target_distribution(table, cfg.roles.target))
        checks = spark.read.schema("check string, status string, columns array<string>, message string").json(
            report("data_checks", profiling.stat_checks(table, cfg.roles.target, cfg.stats, profile_table))
        )
        enforce(checks, title="Statistical checks failed")

    _drift_step(spark, cfg, result, profile_table, report)

    bounds = anomaly.quantile_bounds(table, cfg.anomaly)
    if bounds:
        report("outlier_rates", anomaly.outlier_rates(table, bounds))
    found = spark.read.schema("enabled boolean, status string, outlier_rate double, details array<string>").json(
        report("anomaly_report", anomaly.outlier_report(table, bounds, cfg.anomaly))
    ).first()
    result.anomaly_status = found["status"]
    if cfg.fail_on_anomaly and found["status"] == FAIL:
        raise GateError("Outlier detection failed:\n- " + "\n- ".join(found["details"]))

    if cfg.save_manifest:
        stages = {"raw": raw, "interim": interim, "processed": table}
        prints = [fingerprint(d).withColumn("stage", F.lit(s)) for s, d in stages.items()]
        report("run_manifest", prints[0].unionByName(prints[1]).unionByName(prints[2]))
    return result


def _drift_step(spark, cfg, result, profile_table, report) -> None:
    baseline = None
    if cfg.drift_enabled and profile_table is not None and cfg.baseline_path:
        try:
            baseline = spark.read.parquet(cfg.baseline_path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    state = drift.drift_state(cfg.drift_enabled, profile_table is not None, cfg.baseline_path, baseline is not None)
    result.drift_state = state
    if state == "disabled":
        return
    if state != "compared":
        report("drift_report", spark.createDataFrame([(state,)], "status string"))
        return
    changes = spark.read.schema("feature string, relative_change double, status string, message string").json(
        report("drift_report", drift.profile_drift(profile_table, baseline, cfg.drift))
    )
    result.drift_state = overall(changes).first()["status"]
    if cfg.fail_on_drift:
        enforce(changes, title="Drift too high")


def compare_raw_and_cleaned(spark: SparkSession, raw_path: str, cleaned_path: str, out_dir: str, top: int = 4) -> DataFrame:
    """Shift table of two files and shared-bin histograms of the most shifted columns."""
    sides = {"raw": read_table(spark, raw_path), "cleaned": read_table(spark, cleaned_path)}
    shift = drift.distribution_shift(profiling.profile(sides["raw"]), profiling.profile(sides["cleaned"]))
    write_report(shift, f"{out_dir}/distribution_shift", "parquet")
    saved = spark.read.parquet(f"{out_dir}/distribution_shift")
    both = [r["feature"] for r in drift.top_shifted(saved, top).collect() if all(r["feature"] in s.columns for s in sides.values())]
    if both:
        write_report(drift.overlay_histogram(sides, both), f"{out_dir}/overlays", "json")
    return saved
