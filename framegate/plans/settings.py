"""YAML settings files for the cycles, and the mapping from their keys to configurations."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path
from typing import Any

from framegate import presets
from framegate.config import (
    AnomalyConfig,
    Candidate,
    CleaningConfig,
    CorrelationConfig,
    FeatureConfig,
    FeatureQAConfig,
    ForestSelectionConfig,
    GateConfig,
    LeakageConfig,
    RateFeature,
    Roles,
    SkewConfig,
    SmoteConfig,
    StatCheckConfig,
    ValidationConfig,
)
from framegate.operators import tuning
from framegate.plans.data_cycle import DataCycleConfig
from framegate.plans.feature_cycle import FeatureCycleConfig
from framegate.plans.model_cycle import ModelCycleConfig

# The keys and names of the YAML files, here and in the functions below.
MODEL_KINDS = {
    "random_forest": tuning.FOREST,
    "balanced_random_forest": tuning.BALANCED_FOREST,
    "xgboost": tuning.SECOND_ORDER,
    "gradient_boosting": tuning.BOOSTING,
}
SCORE_METHODS = {"f_classif": "anova", "anova": "anova", "mutual_info": "mutual_info", "binned_mutual_info": "binned_mutual_info"}


def read_settings(path: str) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise RuntimeError("Settings files need the yaml package; build the configuration in code instead") from e
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"Settings not found: {path}")
    return yaml.safe_load(file.read_text()) or {}


def _part(settings: Mapping[str, Any], *names: str) -> Mapping[str, Any]:
    for n in names:
        settings = settings.get(n) or {}
    return settings


def _given(cls, values: Mapping[str, Any], names: Mapping[str, str]):
    """A configuration from the keys that are present; absent ones keep their defaults."""
    return cls(**{field: values[key] for key, field in names.items() if values.get(key) is not None})


def data_cycle_config(settings: Mapping[str, Any], contract=presets.CONTRACT, roles: Roles = presets.ROLES) -> DataCycleConfig:
    dataset, cleaning, checks = settings["dataset"], _part(settings, "cleaning"), _part(settings, "validation")
    anomaly, drift, stats = _part(settings, "anomaly"), _part(settings, "drift"), _part(settings, "stats")
    low, high = cleaning.get("percent_bounds", roles.percent_bounds)
    bound = Roles(
        target=dataset.get("target_col", roles.target),
        id_cols=tuple(filter(None, [dataset.get("id_col")])) or roles.id_cols,
        percent_cols=tuple(cleaning.get("percent_cols", roles.percent_cols)),
        percent_bounds=(float(low), float(high)),
        caps={c: float(cleaning.get("min_cap", cap)) for c, cap in roles.caps.items()},
        non_negative=tuple(cleaning.get("non_negative_cols", roles.non_negative)),
        pairs=roles.pairs,
        sum_identity=roles.sum_identity,
        sum_tolerance=float(checks.get("rebounds_tolerance", roles.sum_tolerance)),
        impute=roles.impute,
    )
    exclude = tuple(anomaly.get("exclude_cols", filter(None, [bound.target])))
    anomaly_names = {
        "enabled": "enabled", "q_low": "q_low", "q_high": "q_high", "min_non_null": "min_non_null",
        "max_outlier_rate_warn": "rate_warn", "max_outlier_rate_fail": "rate_fail", "method": "method",
    }
    return DataCycleConfig(
        raw_path=dataset["raw_path"],
        interim_path=dataset["interim_path"],
        processed_path=dataset["processed_path"],
        reports_dir=_part(settings, "outputs").get("reports_dir", "reports"),
        roles=bound,
        contract=contract,
        sort_by=tuple(_part(settings, "outputs").get("sort_by") or ()),
        cleaning=_given(
            CleaningConfig, cleaning,
            {"drop_duplicates": "drop_duplicates", "impute_3p_pct": "impute_ratio", "correct_impossible_values": "correct_values"},
        ),
        validation=_given(
            ValidationConfig, checks,
            {"enforce_ranges": "ranges", "enforce_made_leq_attempted": "pairs", "enforce_rebounds_identity": "sum_identity"},
        ),
        save_profile=bool(stats.get("save_profile", True)),
        quantile_method=stats.get("quantile_method", "exact"),
        distinct_method=stats.get("distinct_method", "exact"),
        stats=_given(
            StatCheckConfig, stats,
            {
                "missingness_warn_threshold": "missing_warn", "missingness_fail_threshold": "missing_fail",
                "outlier_zscore_threshold": "zscore", "outlier_rate_warn": "outlier_rate_warn",
                "constant_unique_ratio_threshold": "constant_unique_ratio",
            },
        ),
        drift_enabled=bool(drift.get("enabled", False)),
        baseline_path=drift.get("baseline_profile"),
        fail_on_drift=bool(drift.get("fail_on_drift", True)),
        anomaly=_given(AnomalyConfig, {**anomaly, "exclude": exclude}, {**anomaly_names, "exclude": "exclude"}),
        fail_on_anomaly=bool(anomaly.get("fail_pipeline", False)),
        save_manifest=bool(_part(settings, "run_metadata").get("save_manifest", True)),
    )


def feature_cycle_config(
    settings: Mapping[str, Any], spec: Mapping[str, Any] | None = None, features: FeatureConfig = presets.FEATURES
) -> FeatureCycleConfig:
    """`spec` switches features on and off and gives their ranges and epsilon."""
    dataset, outputs, leakage = settings["dataset"], _part(settings, "outputs"), _part(settings, "leakage")
    target = dataset.get("target_col", presets.TARGET)
    ids = tuple(dataset.get("id_cols", ()))
    ranges: Mapping[str, tuple[float, float]] = presets.FEATURE_RANGES
    if spec is not None:
        on = {n: f for n, f in _part(spec, "features").items() if f.get("enabled", True)}
        features = FeatureConfig(features.features, tuple(on), float(_part(spec, "base").get("epsilon", features.eps)))
        ranges = {n: (float(f["range"][0]), float(f["range"][1])) for n, f in on.items() if f.get("range")}
    leak_names = {
        "enabled": "enabled", "drop_id_cols": "drop_id_cols", "check_target_proxy": "check_proxy",
        "max_abs_target_corr_warn": "corr_warn", "max_abs_target_corr_fail": "corr_fail",
        "check_duplicate_columns": "check_duplicates",
    }
    tuples = {
        "target": target, "ids": ids, "forbidden": tuple(leakage.get("forbidden_feature_cols", [target])),
        "required": tuple(leakage.get("required_cols", ())),
    }
    corr = _part(settings, "correlation")
    extras = _part(settings, "eda_extras")
    return FeatureCycleConfig(
        input_path=dataset["input_path"],
        features_path=outputs["features_path"],
        reports_dir=outputs.get("reports_dir", "reports"),
        leakage=_given(
            LeakageConfig, {**leakage, **tuples},
            {**leak_names, "target": "target", "ids": "id_cols", "forbidden": "forbidden", "required": "required"},
        ),
        features=features,
        ranges=ranges,
        exclude=tuple(_part(settings, "eda").get("exclude_cols", [*ids, target])),
        sort_by=tuple(outputs.get("sort_by") or ()),
        qa=_given(
            FeatureQAConfig, _part(settings, "feature_qa"),
            {
                "enabled": "enabled", "missing_warn": "missing_warn", "missing_fail": "missing_fail", "inf_fail": "inf_fail",
                "constant_unique_ratio_warn": "unique_ratio_warn", "constant_unique_ratio_fail": "unique_ratio_fail",
            },
        ),
        explore=bool(_part(settings, "eda").get("enabled", True)),
        skew=_given(
            SkewConfig, _part(settings, "eda", "skew"),
            {"high_threshold": "high", "moderate_threshold": "moderate", "zero_ratio_threshold": "zero_ratio"},
        ),
        score_method=SCORE_METHODS[_part(settings, "eda", "feature_scoring").get("method", "f_classif")],
        correlation=CorrelationConfig(
            bool(corr.get("enabled", True)), float(corr.get("threshold", 0.95)), corr.get("method", "pearson"),
            tuple(corr.get("exclude_cols", [target])),
        ),
        extras=bool(extras.get("enabled", True)),
        importance_trees=int(_part(extras, "feature_importance").get("n_estimators", 50)),
        importance_depth=int(_part(extras, "feature_importance").get("max_depth", 5)),
        components=int(_part(extras, "pca").get("n_components", 10)),
    )


def model_cycle_config(settings: Mapping[str, Any]) -> ModelCycleConfig:
    """Unlike the tables of one machine, a distributed split needs row keys: `dataset.key_cols`, else all features."""
    dataset, features, outputs = settings["dataset"], settings["features"], _part(settings, "outputs")
    base, engineered = features.get("all_base_features", []), features.get("all_engineered_features", [])
    used, metrics, model = _part(features, "selected_for_training"), _part(settings, "metrics"), _part(settings, "model")
    balance, gates, search = _part(settings, "class_imbalance"), _part(settings, "validation_gates"), _part(model, "optuna")
    scaling = _part(features, "scaling")
    candidates = []
    for c in model["candidates"]:
        if c["type"] not in MODEL_KINDS:
            raise ValueError(f"Unknown model type: {c['type']}")
        candidates.append(Candidate(c["name"], MODEL_KINDS[c["type"]], dict(c.get("params", {}))))
    gate = lambda k: float(gates[k]) if gates.get(k) is not None else None
    trials = int(search.get("n_trials", 25)) if search.get("enabled", True) else 0
    return ModelCycleConfig(
        features_path=dataset["processed_path"],
        package_path=f"{outputs.get('package_root', 'packages')}/{outputs.get('package_id', 'model')}",
        reports_dir=outputs.get("reports_dir", "reports"),
        target=dataset["target_col"],
        keys=tuple(dataset.get("key_cols") or [*base, *engineered]),
        base_features=base,
        engineered_features=engineered,
        explicit_features=used.get("cols", ()),
        mode=used.get("use", "all"),
        skew_report_path=_part(features, "transformations").get("skewness_report_csv"),
        selection=_given(
            ForestSelectionConfig,
            {**_part(features, "selection"), "keep": tuple(_part(features, "selection").get("always_keep", ()))},
            {"enabled": "enabled", "top_k": "top_k", "min_importance": "min_importance", "keep": "always_keep"},
        ),
        scaler=scaling.get("scaler", "standard") if scaling.get("enabled", True) else "none",
        smote=SmoteConfig(
            bool(balance.get("enabled", True)) and balance.get("method", "smote") == "smote",
            int(_part(balance, "smote").get("k_neighbors", 5)),
        ),
        candidates=tuple(candidates),
        primary=metrics["primary"],
        metrics=tuple(metrics.get("extra", ("recall", "precision", "accuracy", "roc_auc"))),
        threshold_metric=_part(settings, "threshold_optimization").get("metric"),
        n_splits=int(_part(settings, "cv").get("n_splits", 5)),
        trials=trials,
        test_share=float(_part(settings, "reproducibility").get("test_size", 0.2)),
        gates=GateConfig(gate("min_f1"), gate("min_recall"), gate("max_drop_vs_previous")),
        previous_f1=gates.get("previous_f1"),
        seed=int(_part(settings, "reproducibility").get("random_state", 42)),
    )


def rate_features(spec: Mapping[str, Any]) -> FeatureConfig:
    """Ratio features written as {name: {numerator, denominator, clip}}, for tables other than the preset."""
    made = tuple(
        RateFeature(n, f["numerator"], f["denominator"], tuple(f["clip"]) if f.get("clip") else None) for n, f in spec.items()
    )
    return FeatureConfig(made)
