"""Feature table to packaged model: split, select, tune, refit, evaluate, gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegate.config import Candidate, ForestSelectionConfig, GateConfig, SmoteConfig
from framegate.functions.nulls import col
from framegate.operators import evaluation, importance, preparation, tuning
from framegate.operators.scoring import ModelPackage, score_batch
from framegate.session import checkpoint
from framegate.sources.readers import drop_unlabelled, feature_set, read_table
from framegate.sources.writers import write_report


@dataclass(frozen=True)
class ModelCycleConfig:
    features_path: str
    package_path: str
    reports_dir: str
    target: str
    keys: Sequence[str]
    base_features: Sequence[str]
    engineered_features: Sequence[str] = ()
    explicit_features: Sequence[str] = ()
    mode: str = "all"
    skew_report_path: str | None = None
    selection: ForestSelectionConfig = ForestSelectionConfig()
    scaler: str = "standard"
    smote: SmoteConfig = SmoteConfig()
    candidates: Sequence[Candidate] = ()
    primary: str = "balanced_accuracy"
    metrics: Sequence[str] = ("recall", "accuracy", "roc_auc", "precision")
    threshold_metric: str | None = None
    n_splits: int = 5
    trials: int = 0
    search_space: Mapping[str, Mapping[str, Sequence]] | None = None
    test_share: float = 0.2
    gates: GateConfig = GateConfig()
    previous_f1: float | None = None
    package_id: str = "model"
    seed: int = 42


@dataclass
class ModelCycleResult:
    package: ModelPackage
    selection: tuning.Selection
    features: list[str]
    metrics: DataFrame
    gates: DataFrame
    passed: bool
    reports: dict[str, str] = field(default_factory=dict)


def run_model_cycle(spark: SparkSession, cfg: ModelCycleConfig) -> ModelCycleResult:
    """The package is written before the gates decide, as a failed gate still needs something to inspect."""
    wanted = feature_set(cfg.mode, cfg.base_features, cfg.engineered_features, cfg.explicit_features)
    table = drop_unlabelled(read_table(spark, cfg.features_path), cfg.target)
    columns = list(dict.fromkeys([*cfg.keys, *wanted, cfg.target]))
    split = preparation.stratified_split(
        table.select(*[col(c) for c in columns]), cfg.target, cfg.keys, cfg.test_share, cfg.seed
    )
    train, test = split.filter(~F.col("is_test")), split.filter("is_test")
    chosen, ranked = importance.forest_selection(train, cfg.target, wanted, cfg.selection, cfg.seed)

    plan = {f: preparation.NONE for f in chosen}
    if cfg.skew_report_path:
        skew = spark.read.csv(cfg.skew_report_path, header=True)
        plan = preparation.transform_plan(skew, chosen)
    setup = tuning.TrainingSetup(cfg.target, tuple(chosen), tuple(cfg.keys), plan, cfg.scaler, cfg.smote, cfg.seed)
    folded = checkpoint(preparation.stratified_folds(train, cfg.target, cfg.keys, cfg.n_splits, cfg.seed))
    found = tuning.select_model(
        folded, setup, cfg.candidates, cfg.metrics, cfg.primary, cfg.threshold_metric or cfg.primary, cfg.trials, cfg.search_space
    )
    model = tuning.train_final(folded, setup, found.best.candidate)
    package = ModelPackage(model, tuple(chosen), found.threshold, cfg.target, cfg.package_id)
    package.save(spark, cfg.package_path)

    scored = score_batch(test, package)
    result = ModelCycleResult(package, found, chosen, None, None, False)

    def report(name: str, df: DataFrame, fmt: str = "json") -> DataFrame:
        path = f"{cfg.reports_dir}/{name}"
        write_report(df, path, fmt)
        result.reports[name] = path
        return spark.read.schema(df.schema).format(fmt).load(path)

    if ranked:
        report("feature_selection", importance.importance_table(table, ranked).withColumn("selected", F.col("feature").isin(chosen)))
    rows = [
        (r.candidate.name, r.variant, m, i, v) for r in found.results for m, vs in r.folds.items() for i, v in enumerate(vs)
    ]
    report("cross_validation", spark.createDataFrame(rows, "name string, variant string, metric string, fold int, value double"))
    report("classification_report", evaluation.classification_report(scored, cfg.target, "prediction"))
    result.metrics = report(
        "metrics", evaluation.evaluate_at_thresholds(scored, cfg.target, "prediction_proba", found.threshold)
    )
    tuned = result.metrics.filter("variant = 'tuned'").withColumn("previous_f1", F.lit(cfg.previous_f1).cast("double"))
    result.gates = report("gates", evaluation.promotion_gates(tuned, cfg.gates))
    result.passed = evaluation.gates_passed(result.gates).first()["passed"]
    return result
