"""Log metrics, streams and the whole cycles."""

from __future__ import annotations

import json
import random

import pytest
from conftest import by, season, seasons
from pyspark.sql import functions as F

from framegate import presets
from framegate.config import AnomalyConfig, Candidate, ForestSelectionConfig, GateConfig, StatCheckConfig
from framegate.functions.status import GateError
from framegate.operators import drift, monitoring, profiling, scoring, tuning
from framegate.plans import data_cycle, feature_cycle, model_cycle, monitoring_cycle
from framegate.sources import readers
from framegate.streaming import inference


def event(i, **changes):
    e = {
        "event_type": "single_inference", "timestamp_utc": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}+00:00", "request_id": f"r{i}",
        "package_id": "p", "threshold_used": 0.5, "features": {"a": float(i), "b": 1.0}, "prediction": i % 2,
        "probability": round(i / 100, 2), "n_rows": None, "latency_ms": float(i), "status": "success", "error_message": None,
    }
    e.update(changes)
    return e


@pytest.fixture()
def log(tmp_path):
    events = [event(i) for i in range(100)]
    events[7].update(status="failed", prediction=-1, probability=-1.0, features={"a": 1.0, "z": 2.0}, error_message="bad")
    events[8].update(event_type="batch_inference", n_rows=30, features=None, prediction=None, probability=None)
    events[9].update(probability=1.2)
    path = tmp_path / "log"
    path.mkdir()
    (path / "one.jsonl").write_text("\n".join(json.dumps(e) for e in events) + "\nbroken {\n")
    return str(path)


def test_log_metrics(spark, log):
    events = readers.read_events(spark, log)
    m = monitoring.request_metrics(events, history=50).first()
    assert (m["total_requests"], m["success_rate"], m["single_inference_count"]) == (100, 0.99, 99)
    assert m["avg_latency_ms"] == 74.5 and m["p95_latency_ms"] == pytest.approx(96.55)
    assert m["throughput_requests_per_min"] == 61  # of the whole log, not of the kept history
    assert monitoring.request_metrics(events).first()["throughput_requests_per_min"] == 61
    assert (m["batch_request_count"], m["total_batch_rows"], m["avg_rows_per_batch"]) == (1, 30, 30.0)
    empty = monitoring.request_metrics(events.filter("false")).first()
    assert empty["total_requests"] == 0 and empty["success_rate"] == 0 and empty["p95_latency_ms"] == 0
    single = events.filter("event_type = 'single_inference'")
    r = monitoring.prediction_reliability(scoring.validate_predictions(single)).first()
    assert r["total_predictions"] == 99 and r["invalid_prediction_count"] == 2
    d = monitoring.data_reliability(scoring.validate_payloads(single, ["a", "b"])).first()
    assert (d["invalid_payload_count"], d["total_missing_features"], d["total_unexpected_features"]) == (1, 1, 1)
    assert monitoring.prediction_monitor(events).first()["total_predictions"] == 98
    assert monitoring.prediction_monitor(events, include_failed=True).first()["total_predictions"] == 99
    with pytest.raises(ValueError):
        monitoring.prediction_monitor(events.filter("false"))
    assert sorted(r["feature"] for r in monitoring.logged_feature_names(events).collect()) == ["a", "b", "z"]
    assert monitoring.logged_features(events, ["b", "a"]).columns == ["b", "a"]


def test_scored_events_mark_failures(spark):
    rows = spark.createDataFrame([(1, {"a": 1.0}, 0.7), (2, {"b": 1.0}, 0.7)], "id int, features map<string,double>, p double")
    checked = scoring.validate_payloads(rows, ["a"])
    got = by(
        scoring.single_events(checked, "pk", 0.6, request_id=F.col("id"), at=F.lit("2024-01-01").cast("timestamp"), probability="p"),
        "request_id",
    )
    assert got["1"]["status"] == "success" and got["1"]["prediction"] == 1
    assert got["2"]["status"] == "failed" and got["2"]["prediction"] == -1 and got["2"]["probability"] == -1.0


def test_monitoring_cycle(spark, log, tmp_path):
    reference = spark.range(100).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    reference.write.parquet(str(tmp_path / "ref.parquet"))
    cfg = monitoring_cycle.MonitoringConfig(log, str(tmp_path / "reports"), ["a", "b"], str(tmp_path / "ref.parquet"))
    out = monitoring_cycle.run_monitoring_cycle(spark, cfg)
    assert out["drift"].first()["total_features"] == 2 and not out["drift"].first()["dataset_drift"]
    assert spark.read.json(str(tmp_path / "reports" / "requests")).first()["total_requests"] == 100


# -- streams --------------------------------------------------------------------------------


def test_stream_drops_repeats_and_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write = lambda name, events: (folder / name).write_text("\n".join(json.dumps(e) for e in events))
    at = lambda h, m: f"2024-01-01T{h:02d}:{m:02d}:00+00:00"
    first = [event(1, timestamp_utc=at(0, 0)), event(1, timestamp_utc=at(0, 1)), event(2, timestamp_utc=at(5, 0), status="failed")]
    late = [event(3, timestamp_utc=at(0, 2)), event(4, timestamp_utc=at(9, 0))]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for name, events in (("a.jsonl", first), ("b.jsonl", late)):
        write(name, events)
        stream = inference.minute_metrics(inference.without_repeats(inference.event_stream(spark, str(folder))), delay=None)
        inference.run_available(stream, out, state)
    got = spark.read.parquet(out).orderBy("window_start").collect()
    assert [(r["requests"], r["success_rate"]) for r in got] == [(1, 1.0), (1, 0.0)]  # no repeat, nothing late


def test_stream_validation_and_failures(spark, log, tmp_path):
    events = inference.event_stream(spark, log)
    checked = inference.validated_stream(events, ["a", "b"]).select("request_id", "payload_valid", "prediction_valid")
    inference.run_available(checked, str(tmp_path / "v"), str(tmp_path / "vs"))
    got = by(spark.read.parquet(str(tmp_path / "v")), "request_id")
    assert len(got) == 100 and not got["r7"]["payload_valid"] and not got["r9"]["prediction_valid"] and got["r10"]["payload_valid"]
    step = inference.split_failures(str(tmp_path / "all"), str(tmp_path / "bad"))
    inference.run_batches(events, step, str(tmp_path / "fs"))
    assert spark.read.json(str(tmp_path / "all" / "*")).count() == 100 and spark.read.json(str(tmp_path / "bad" / "*")).count() == 1


def test_stream_outliers_and_drift(spark, log, tmp_path):
    events = inference.event_stream(spark, log).select("request_id", "latency_ms")
    flagged = inference.outlier_stream(events, {"latency_ms": (10.0, 90.0)})
    inference.run_available(flagged, str(tmp_path / "o"), str(tmp_path / "os"))
    assert spark.read.parquet(str(tmp_path / "o")).filter("outlier_any").count() == 19
    reference = spark.range(100).select((F.col("id") * 3.0).alias("latency_ms"))
    step = inference.drift_per_batch(profiling.profile(reference), reference, ["latency_ms"], str(tmp_path / "d"))
    inference.run_batches(events, step, str(tmp_path / "ds"))
    row = spark.read.parquet(str(tmp_path / "d" / "summary" / "*")).first()
    assert row["status"] == "fail" and row["dataset_drift"]


def test_windowed_predictions(spark, log, tmp_path):
    stream = inference.prediction_distribution(inference.event_stream(spark, log), delay="0 seconds", window="1 minute")
    inference.run_available(stream, str(tmp_path / "p"), str(tmp_path / "ps"))
    row = spark.read.parquet(str(tmp_path / "p")).orderBy("window_start").first()
    assert row["total_predictions"] == 58 and row["positive_prediction_rate"] == pytest.approx(29 / 58)


# -- cycles ---------------------------------------------------------------------------------


def season_rows(n=200):
    rng = random.Random(0)
    out = []
    for i in range(n):
        v = lambda lo, hi: round(rng.uniform(lo, hi), 1)
        fga, tpa, fta, oreb, dreb = v(2, 15), v(0.5, 5), v(0.5, 6), v(0, 4), v(0, 8)
        row = season(
            f"P{i}", GP=float(rng.randrange(20, 82)), MIN=v(5, 40), PTS=v(1, 25), FGA=fga, FGM=round(fga * rng.uniform(0.3, 0.6), 1),
            FTA=fta, FTM=round(fta * rng.uniform(0.5, 0.9), 1), OREB=oreb, DREB=dreb, REB=oreb + dreb, AST=v(0, 9), STL=v(0, 3),
            BLK=v(0, 3), TOV=v(0.5, 4),
            **{"3PA": tpa, "3P Made": round(tpa * 0.3, 1), "FG%": v(30, 60), "3P%": v(0, 50), "FT%": v(50, 95)},
        )
        row["TARGET_5Yrs"] = int(row["MIN"] > 20 and row["PTS"] > 8)
        out.append(row)
    return out


def data_config(tmp_path, **changes):
    settings = dict(
        raw_path=str(tmp_path / "raw"), interim_path=str(tmp_path / "interim.parquet"), processed_path=str(tmp_path / "processed.parquet"),
        reports_dir=str(tmp_path / "reports"), roles=presets.ROLES, contract=presets.CONTRACT, sort_by=["Name"],
        stats=StatCheckConfig(constant_unique_ratio=0.001), anomaly=AnomalyConfig(exclude=(presets.TARGET,)),
    )
    return data_cycle.DataCycleConfig(**{**settings, **changes})


def test_data_cycle(spark, dirty, tmp_path):
    dirty.unionByName(seasons(spark, season_rows(30))).coalesce(1).write.csv(str(tmp_path / "raw"), header=True)
    done = data_cycle.run_data_cycle(spark, data_config(tmp_path))
    assert done.table.count() == 32 and done.table.columns == list(presets.COLUMNS) and done.drift_state == "disabled"
    assert {"data_profile", "data_checks", "anomaly_report", "run_manifest"} <= set(done.reports)
    again = data_config(tmp_path, drift_enabled=True, baseline_path=done.reports["data_profile"], reports_dir=str(tmp_path / "r2"))
    assert data_cycle.run_data_cycle(spark, again).drift_state == "pass"
    lost = data_config(tmp_path, drift_enabled=True, baseline_path=str(tmp_path / "none"), reports_dir=str(tmp_path / "r3"))
    assert data_cycle.run_data_cycle(spark, lost).drift_state == "no_baseline"
    strict = data_config(tmp_path, fail_on_anomaly=True, reports_dir=str(tmp_path / "r4"))
    with pytest.raises(GateError, match="Outlier"):
        data_cycle.run_data_cycle(spark, strict)
    shift = data_cycle.compare_raw_and_cleaned(spark, done.reports["data_profile"] and str(tmp_path / "interim.parquet"), str(tmp_path / "processed.parquet"), str(tmp_path / "cmp"))
    assert shift.agg(F.max("shift_score")).first()[0] == 0


def test_data_cycle_writes_before_the_gate_fails(spark, tmp_path):
    rows = season_rows(20)
    for r in rows[:15]:
        r["Name"] = None
    seasons(spark, rows).coalesce(1).write.csv(str(tmp_path / "raw"), header=True)
    with pytest.raises(GateError, match="missingness_fail"):
        data_cycle.run_data_cycle(spark, data_config(tmp_path))
    assert spark.read.parquet(str(tmp_path / "processed.parquet")).count() == 20


def test_feature_and_model_cycle(spark, tmp_path):
    seasons(spark, season_rows()).write.parquet(str(tmp_path / "in.parquet"))
    cfg = feature_cycle.FeatureCycleConfig(
        str(tmp_path / "in.parquet"), str(tmp_path / "features.parquet"), str(tmp_path / "freports"), presets.LEAKAGE, presets.FEATURES,
        {k: v for k, v in presets.FEATURE_RANGES.items() if k != "AST_to_TOV"}, importance_trees=5,
    )
    done = feature_cycle.run_feature_cycle(spark, cfg)
    assert "Name" not in done.table.columns and "Usage_proxy" in done.table.columns
    assert done.statuses["feature_qa"] == "pass" and {"skew_report", "feature_scores", "correlation_matrix"} <= set(done.reports)
    keyed = done.table.withColumn("row_id", F.xxhash64(*[F.col(f"`{c}`") for c in done.table.columns]))
    keyed.write.parquet(str(tmp_path / "keyed.parquet"))
    model = model_cycle.ModelCycleConfig(
        str(tmp_path / "keyed.parquet"), str(tmp_path / "package"), str(tmp_path / "mreports"), presets.TARGET, ["row_id"],
        presets.BASE_FEATURES, [f.name for f in presets.FEATURES.features], skew_report_path=done.reports["skew_report"],
        selection=ForestSelectionConfig(top_k=4, trees=10, max_depth=5, always_keep=("GP", "MIN", "PTS")),
        candidates=[Candidate("rf", tuning.FOREST, {"n_estimators": 8, "max_depth": 5})], n_splits=2,
        gates=GateConfig(0.5, 0.5), primary="balanced_accuracy",
    )
    out = model_cycle.run_model_cycle(spark, model)
    assert {"MIN", "PTS", "GP"} <= set(out.features) and out.passed
    assert by(out.metrics, "variant")["tuned"]["f1"] > 0.7
    loaded = scoring.ModelPackage.load(spark, str(tmp_path / "package"))
    assert loaded.features == tuple(out.features)


def test_feature_cycle_stops_on_a_bad_feature(spark, tmp_path):
    seasons(spark, [season("a", AST=30.0, TOV=0.01), season("b", TARGET_5Yrs=0)]).write.parquet(str(tmp_path / "in.parquet"))
    cfg = feature_cycle.FeatureCycleConfig(
        str(tmp_path / "in.parquet"), str(tmp_path / "f.parquet"), str(tmp_path / "r"),
        presets.LeakageConfig(target=presets.TARGET, id_cols=("Name",), check_proxy=False, check_duplicates=False), presets.FEATURES, presets.FEATURE_RANGES,
    )
    with pytest.raises(GateError, match="AST"):
        feature_cycle.run_feature_cycle(spark, cfg)


def test_decay_check(spark):
    df = spark.createDataFrame([(1, 1), (0, 1)], "y int, p int")
    assert by(monitoring_cycle.check_decay(df, "y", "p", {"accuracy": 0.9}), "metric")["accuracy"]["alert"]
    assert drift.shared_bins(0) == 10
