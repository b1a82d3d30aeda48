"""Settings files and job entry points."""

from __future__ import annotations

import pytest
from conftest import seasons
from test_serving import season_rows

from framegate import presets
from framegate.__main__ import main
from framegate.plans import settings

DATA = """
dataset: {{raw_path: "{d}/raw", interim_path: "{d}/i.parquet", processed_path: "{d}/p.parquet", target_col: TARGET_5Yrs, id_col: Name}}
cleaning: {{drop_duplicates: false, percent_bounds: [0, 90], min_cap: 40, non_negative_cols: [PTS]}}
validation: {{enforce_made_leq_attempted: false, rebounds_tolerance: 0.001}}
stats: {{save_profile: false}}
anomaly: {{enabled: false}}
outputs: {{reports_dir: "{d}/reports", sort_by: [Name]}}
run_metadata: {{save_manifest: false}}
drift: {{enabled: true, baseline_profile: null}}
"""
FEATURES = {
    "dataset": {"input_path": "in.parquet", "target_col": "TARGET_5Yrs", "id_cols": ["Name"]},
    "leakage": {"max_abs_target_corr_warn": 0.7, "required_cols": ["PTS"]},
    "eda": {"feature_scoring": {"method": "mutual_info"}, "skew": {"high_threshold": 2.0}},
    "outputs": {"features_path": "f.parquet"},
}
SPEC = {"base": {"epsilon": 1e-6}, "features": {"FT_rate": {"enabled": True, "range": [0, 2]}, "PTS_per_MIN": {"enabled": False}}}
MODEL = {
    "dataset": {"processed_path": "f.parquet", "target_col": "y", "key_cols": ["id"]},
    "features": {"all_base_features": ["a"], "all_engineered_features": ["b"], "scaling": {"enabled": False}, "selection": {"top_k": 3, "always_keep": ["a"]}},
    "class_imbalance": {"method": "class_weight"},
    "model": {"candidates": [{"name": "x", "type": "xgboost", "params": {"max_depth": 3}}], "optuna": {"enabled": False}},
    "metrics": {"primary": "f1"},
    "validation_gates": {"min_f1": 0.6},
}


def test_data_job(spark, tmp_path):
    seasons(spark, season_rows(12)).coalesce(1).write.csv(str(tmp_path / "raw"), header=True)
    file = tmp_path / "data.yaml"
    file.write_text(DATA.format(d=tmp_path))
    done = main(["data", "--config", str(file)], spark)
    assert done.drift_state == "skipped_no_profile" and done.anomaly_status == "pass"
    assert done.table.count() == 12 and done.table.agg({"MIN": "max"}).first()[0] <= 40
    cfg = settings.data_cycle_config(settings.read_settings(str(file)))
    assert cfg.roles.caps == {"MIN": 40.0} and cfg.roles.non_negative == ("PTS",) and not cfg.validation.pairs
    assert cfg.roles.sum_tolerance == 0.001 and cfg.anomaly.exclude == ("TARGET_5Yrs",) and cfg.stats.missing_warn == 0.2
    with pytest.raises(FileNotFoundError):
        main(["data", "--config", str(tmp_path / "none.yaml")], spark)


def test_feature_settings():
    cfg = settings.feature_cycle_config(FEATURES, SPEC)
    assert cfg.features.enabled == ("FT_rate",) and cfg.features.eps == 1e-6 and cfg.ranges == {"FT_rate": (0.0, 2.0)}
    assert cfg.leakage.corr_warn == 0.7 and cfg.leakage.forbidden == ("TARGET_5Yrs",) and cfg.leakage.required == ("PTS",)
    assert cfg.score_method == "mutual_info" and cfg.skew.high == 2.0 and cfg.exclude == ("Name", "TARGET_5Yrs")
    assert settings.feature_cycle_config(FEATURES).ranges == presets.FEATURE_RANGES


def test_model_settings():
    cfg = settings.model_cycle_config(MODEL)
    assert cfg.scaler == "none" and not cfg.smote.enabled and cfg.trials == 0 and cfg.keys == ("id",)
    assert cfg.candidates[0].kind == "second_order_boosting" and cfg.selection.always_keep == ("a",) and cfg.gates.min_recall is None
    with pytest.raises(ValueError, match="svc"):
        settings.model_cycle_config({**MODEL, "model": {"candidates": [{"name": "s", "type": "svc"}]}})


def test_declared_ratios():
    cfg = settings.rate_features({"r": {"numerator": "a", "denominator": "b", "clip": [0, 1]}})
    assert cfg.features[0].clip == (0, 1)
