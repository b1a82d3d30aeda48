"""Profiles, gates, drift, outliers, features, leakage, correlation, exploratory tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import by, season, seasons
from pyspark.sql import functions as F

from framegate import presets
from framegate.config import (
    AnomalyConfig,
    CorrelationConfig,
    FeatureConfig,
    FeatureQAConfig,
    LeakageConfig,
    RateFeature,
    SelectionConfig,
    SkewConfig,
    StatCheckConfig,
)
from framegate.functions.status import GateError, overall
from framegate.operators import anomaly, contracts, correlation, drift, eda, features, importance, profiling, quality

NAN, INF = float("nan"), float("inf")


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*columns.values())), names)


# -- profiles and gates ---------------------------------------------------------------------


def test_profile_counts_missing_as_a_value(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, "a"), (None, None), (1.0, "b")], "x double, s string")
    got = by(profiling.profile(df), "feature")
    assert got["x"]["missing_ratio"] == 0.5 and got["x"]["unique_ratio"] == 0.5
    assert got["s"]["missing_ratio"] == 0.25 and got["s"]["unique_ratio"] == 0.75
    assert got["x"]["mean"] == 1.0 and got["x"]["p50"] == 1.0 and got["s"]["mean"] is None


def test_profile_of_text_only_and_empty_tables(spark):
    text = by(profiling.profile(spark.createDataFrame([("a",)], "s string")), "feature")
    assert text["s"]["p50"] is None and text["s"]["unique_ratio"] == 1.0
    empty = by(profiling.profile(spark.createDataFrame([], "x double")), "feature")
    assert empty["x"]["rows"] == 0 and empty["x"]["unique_ratio"] == 0 and empty["x"]["mean"] is None


def test_quantile_names():
    assert [profiling.quantile_name(q) for q in (0.01, 0.5, 0.99)] == ["p01", "p50", "p99"]


def test_approximate_distinct_counts_are_close(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("x"))
    exact = profiling.distinct_counts(df, ["x"]).first()["distinct_values"]
    approx = profiling.distinct_counts(df, ["x"], "approx").first()["distinct_values"]
    assert exact == 700 and abs(approx - 700) < 70
    with pytest.raises(ValueError):
        profiling.distinct_counts(df, ["x"], "guess")


def test_stat_checks(spark):
    rows = [(1.0 if i else 1000.0, None if i < 6 else 1.0, float(i), 1 if i else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "spike double, gap double, fine double, y int")
    cfg = StatCheckConfig(missing_warn=0.1, missing_fail=0.5, outlier_rate_warn=0.02, constant_unique_ratio=0.03)
    got = by(profiling.stat_checks(df, "y", cfg), "check")
    assert got["missingness_warn"]["columns"] == ["gap"] and got["missingness_fail"]["status"] == "pass"
    assert got["outlier_rate"]["columns"] == ["spike", "y"]  # one value in forty is far out in both
    assert got["target_share"]["status"] == "warn" and overall(profiling.stat_checks(df, "y", cfg)).first()["status"] == "warn"
    assert got["near_constant"]["status"] == "pass"
    near = by(profiling.stat_checks(df, None, StatCheckConfig(constant_unique_ratio=0.06)), "check")
    assert near["near_constant"]["columns"] == ["gap", "spike", "y"] and "target_share" not in near
    limited = StatCheckConfig(constant_unique_ratio=0.06, constant_max_distinct=1)
    assert by(profiling.stat_checks(df, None, limited), "check")["near_constant"]["status"] == "pass"


def test_zscores_skip_short_and_constant_columns(spark):
    df = spark.createDataFrame([(float(i), 5.0, float(i) if i < 9 else None) for i in range(30)], "a double, same double, short double")
    assert set(by(profiling.zscore_rates(df), "feature")) == {"a"}


def test_target_distribution_keeps_missing(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    assert by(profiling.target_distribution(df, "y"), "value", "share") == {1: 0.5, 0: 0.25, None: 0.25}
    kept = by(profiling.target_distribution(df, "y", as_percent=True, keep_missing=False), "value", "percent")
    assert kept[1] == pytest.approx(200 / 3) and None not in kept


# -- drift ----------------------------------------------------------------------------------


def two_profiles(spark):
    a = spark.createDataFrame([(float(i), 0.0, 1.0) for i in range(11)], "x double, zero double, only_a double")
    b = spark.createDataFrame([(i * 1.3, 1.0, 1.0) for i in range(11)], "x double, zero double, only_b double")
    return profiling.profile(a), profiling.profile(b)


def test_profile_drift_on_shared_columns(spark):
    base, cur = two_profiles(spark)
    got = by(drift.profile_drift(cur, base), "feature")
    assert set(got) == {"x", "zero"} and got["x"]["relative_change"] == pytest.approx(0.3) and got["x"]["status"] == "warn"
    assert got["zero"]["relative_change"] == pytest.approx(1e8) and got["zero"]["status"] == "fail"


def test_shift_covers_the_union(spark):
    base, cur = two_profiles(spark)
    got = by(drift.distribution_shift(base, cur), "feature")
    assert set(got) == {"x", "zero", "only_a", "only_b"}
    assert got["only_a"]["mean_delta"] is None and got["only_a"]["shift_score"] == 0
    assert got["zero"]["mean_delta"] == 1 and got["zero"]["mean_delta_pct"] is None  # no percent of zero
    assert got["x"]["shift_score"] == pytest.approx(60)
    assert drift.top_shifted(drift.distribution_shift(base, cur), 1).first()["feature"] == "x"


def test_drift_states():
    assert drift.drift_state(False, True, "p", True) == "disabled"
    assert drift.drift_state(True, False, "p", True) == "skipped_no_profile"
    assert drift.drift_state(True, True, None, False) == "skipped_no_path"
    assert drift.drift_state(True, True, "p", False) == "no_baseline"
    assert drift.drift_state(True, True, "p", True) == "compared"


def test_histogram_bins_and_small_sides(spark):
    assert [drift.shared_bins(n) for n in (4, 400, 10**6)] == [10, 20, 40]
    a = spark.createDataFrame([(float(i), 1.0) for i in range(6)], "x double, few double")
    b = spark.createDataFrame([(float(i), None) for i in range(10)], "x double, few double")
    got = drift.overlay_histogram({"a": a, "b": b}, ["x", "few"]).collect()
    assert {r["feature"] for r in got} == {"x"} and sum(r["n"] for r in got) == 16
    assert max(r["bin"] for r in got) == 9 and max(r["high"] for r in got) == 9.0


def test_same_samples_do_not_drift(spark):
    df = spark.range(500).select((F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("s"))
    tests, summary = drift.dataset_drift(df, df)
    assert summary.first().asDict() == {"dataset_drift": False, "drifted_features": 0, "total_features": 2}
    moved = df.withColumn("x", F.col("x") + 20).withColumn("extra", F.lit(1))
    got = by(drift.dataset_drift(df, moved)[0], "feature")
    assert got["x"]["drifted"] and got["x"]["statistic"] == pytest.approx(0.4) and not got["s"]["drifted"]
    assert drift.dataset_drift(df, moved)[1].first()["dataset_drift"]
    with pytest.raises(ValueError):
        drift.dataset_drift(df, df.select(F.lit(1).alias("other")))


# -- outliers -------------------------------------------------------------------------------


def test_outliers(spark):
    rows = [(float(i), float(-i), None if i > 4 else 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, short double")
    cfg = AnomalyConfig(exclude=("none",))
    bounds = anomaly.quantile_bounds(df, cfg)
    assert list(bounds) == ["a", "b"] and bounds["a"] == pytest.approx((0.99, 98.01))
    flagged = by(anomaly.flag_outliers(df, bounds), "a")
    assert flagged[0.0]["outlier_cols"] == "a,b" and flagged[0.0]["outlier_count"] == 2 and flagged[50.0]["outlier_cols"] == ""
    report = anomaly.outlier_report(df, bounds, cfg).first()
    assert report["outlier_rate"] == 0.02 and report["status"] == "warn" and len(report["details"]) == 1
    both = anomaly.outlier_report(df, bounds, AnomalyConfig(rate_warn=0.01, rate_fail=0.02)).first()
    assert both["status"] == "fail" and len(both["details"]) == 2


def test_outliers_without_columns(spark):
    df = spark.createDataFrame([("x",)], "s string")
    assert anomaly.quantile_bounds(df) == {}
    row = anomaly.flag_outliers(df, {}).first()
    assert (row["outlier_count"], row["outlier_any"], row["outlier_cols"]) == (0, False, "")
    assert anomaly.outlier_report(df, {}).first()["status"] == "pass"
    assert anomaly.outlier_report(df, {}, AnomalyConfig(enabled=False)).first()["details"] == ["Outlier detection disabled."]


def test_missing_value_is_no_outlier(spark):
    df = spark.createDataFrame([(None,), (5.0,), (NAN,)], "a double")
    assert [r["outlier_any"] for r in anomaly.flag_outliers(df, {"a": (0.0, 1.0)}).collect()] == [False, True, False]


# -- features -------------------------------------------------------------------------------


def test_preset_features(spark):
    df = features.add_features(seasons(spark, [season("a"), season("z", REB=0.0, FGA=0.0)]), presets.FEATURES)
    got = by(df, "Name")
    assert got["a"]["PTS_per_MIN"] == pytest.approx(0.5) and got["a"]["Usage_proxy"] == pytest.approx(9 + 0.44 * 3 + 1)
    assert got["a"]["OREB_share"] == pytest.approx(0.25) and got["z"]["OREB_share"] == 1.0
    assert got["z"]["FGM_per_FGA"] == pytest.approx(4e9)
    assert len(df.columns) == len(presets.COLUMNS) + 10
    contracts.validate_features(df.filter("Name = 'a'"), presets.FEATURE_RANGES)
    with pytest.raises(GateError, match="FGM_per_FGA: outside"):
        contracts.validate_features(df, presets.FEATURE_RANGES)


def test_feature_switches(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    cfg = lambda on: FeatureConfig((RateFeature("r", "a", "b"), RateFeature("q", "a", "c")), enabled=on)
    assert features.add_features(df, cfg(("r",))).columns == ["a", "b", "r"]
    with pytest.raises(ValueError, match="c"):
        features.add_features(df, cfg(None))
    with pytest.raises(ValueError, match="x"):
        features.add_features(df, cfg(("x",)))


def test_feature_qa(spark):
    rows = [(float(i), None if i < 8 else float(i), 1.0, INF if i == 3 else float(i), str(i), 1) for i in range(100)]
    df = spark.createDataFrame(rows, "ok double, gap double, same double, inf double, text string, y int")
    row = quality.feature_qa(df, ("y",), FeatureQAConfig()).first()
    assert row["status"] == "fail" and row["inf_features"] == ["inf"] and row["nan_features"] == ["gap"]
    assert row["near_constant_features"] == ["same"] and row["constant_features"] == []
    assert row["max_missing_ratio"] == 0.08 and len(row["details"]) == 3
    fine = quality.feature_qa(df, ("y", "same", "inf", "gap"), FeatureQAConfig()).first()
    assert fine["status"] == "pass" and fine["details"] == []
    constant = quality.feature_qa(df, ("y", "inf"), FeatureQAConfig(unique_ratio_fail=0.01)).first()
    assert constant["status"] == "fail" and constant["near_constant_features"] == []
    assert quality.feature_qa(df, (), FeatureQAConfig(enabled=False)).first()["status"] == "pass"


def leak_frame(spark):
    rows = [("a", 1.0, 1.0, 0), ("b", 2.0, 2.0, 1), ("c", 5.0, 5.0, 0), ("d", 3.0, 3.0, 1)]
    return spark.createDataFrame(rows, "id string, x double, x_copy double, y int")


def test_leakage_warns_on_copies_and_drops_ids(spark):
    df = leak_frame(spark)
    cfg = LeakageConfig(target="y", id_cols=("id",), forbidden=("y", "x_copy"))
    report = quality.leakage_report(df, cfg).first()
    assert report["status"] == "warn" and "x_copy" in report["details"][0]
    assert quality.guard_leakage(df, cfg).columns == ["x", "y"]
    assert quality.guard_leakage(df, LeakageConfig(target="y", id_cols=("id",), drop_id_cols=False)).columns == df.columns
    assert quality.guard_leakage(df, LeakageConfig(target="nope", enabled=False)).columns == df.columns


def test_leakage_fails(spark):
    df = leak_frame(spark).withColumn("proxy", F.col("y") * 2.0)
    cases = [
        (LeakageConfig(target="y"), "proxies"),
        (LeakageConfig(target="y", required=("gone",)), "gone"),
        (LeakageConfig(target="gone"), "not found"),
        (LeakageConfig(target="x"), "not 0/1"),
    ]
    for cfg, text in cases:
        with pytest.raises(GateError, match=text):
            quality.guard_leakage(df, cfg)


def test_permuted_columns_are_no_copies(spark):
    df = spark.createDataFrame([(1, 2, 1.0), (2, 1, 2.0), (3, 3, 3.0)], "a int, b int, c double")
    assert quality.duplicate_columns(df).collect() == []


def test_constant_columns_have_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 0.1, 0), (2.0, 0.1, 1), (4.0, 0.1, 1)], "x double, same double, y int")
    assert set(by(quality.label_correlations(df, "y"), "feature")) == {"x"}


# -- correlation ----------------------------------------------------------------------------


def test_wide_tables_give_the_pairs_of_narrow_ones(spark):
    df = spark.range(400).select(
        *[(F.when(F.col("id") % (i + 5) != 0, F.hash("id", F.lit(i)) % 100 + 1000 + F.col("id") * (i % 3))).cast("double").alias(f"c{i}") for i in range(8)],
        F.lit(3.0).alias("same"), F.lit(None).cast("double").alias("none"),
    )
    key = lambda t: {(r["feature_a"], r["feature_b"]): r["corr"] for r in t.collect()}
    narrow, wide = key(correlation.pearson_pairs(df, df.columns)), key(correlation.pearson_pairs(df, df.columns, wide_columns=2))
    assert narrow.keys() == wide.keys()
    for pair, r in narrow.items():
        assert (r is None) == (wide[pair] is None) and (r is None or wide[pair] == pytest.approx(r, abs=1e-9))


def test_collinear_pair_and_gate(spark):
    df = spark.createDataFrame([(float(a), 5.0 - 3 * a, a % 2) for a in (3, 8, 1, 9, 4, 6)], "A double, B double, TARGET int")
    cfg = CorrelationConfig(exclude=("TARGET",))
    pairs = correlation.correlation_pairs(df, cfg)
    assert by(pairs, "feature_a")["A"]["corr"] == pytest.approx(-1.0)
    gate = correlation.correlation_gate(df, cfg).first()
    assert gate["status"] == "warn" and gate["n_high_corr_pairs"] == 1 and gate["n_features_used"] == 2
    one = correlation.correlation_gate(df.drop("B"), cfg).first()
    assert one["status"] == "warn" and one["n_high_corr_pairs"] == 0
    assert correlation.high_correlations(pairs, 1.5).collect() == []
    assert correlation.correlation_matrix(correlation.pearson_pairs(df, ["A"]), ["A"]).collect() == []
    with pytest.raises(ValueError):
        correlation.correlation_pairs(df, CorrelationConfig(method="kendall"))


@pytest.mark.parametrize("columns", [3, 45])
@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_rank_correlation_by_any_path(spark, monkeypatch, columns, limit):
    """Ties, a hot value, a constant column and both signs of zero; few or many columns, ranks sent or joined."""
    monkeypatch.setattr(correlation, "BROADCAST_RANKS", limit)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(200, columns)) * 3) + 0.0
    x[:, 1] = np.where(rng.random(200) < 0.6, -0.0, x[:, 0])
    x[:, 2] = 4.0
    names = [f"c {i}" for i in range(columns)]
    df = spark.createDataFrame([tuple(r) for r in x.tolist()], ", ".join(f"`{c}` double" for c in names)).repartition(3)
    smaller = (x[None] < x[:, None]).sum(axis=1)
    ranks = smaller + ((x[None] == x[:, None]).sum(axis=1) + 1) / 2
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation.spearman_pairs(df, names).collect()}
    assert len(got) == columns * (columns - 1) // 2
    for (a, b), r in got.items():
        i, j = names.index(a), names.index(b)
        assert i < j and r == (None if 2 in (i, j) else pytest.approx(np.corrcoef(ranks[:, i], ranks[:, j])[0, 1]))
    none = correlation.spearman_pairs(df.limit(0), names).collect()
    assert all(r["corr"] is None for r in none)


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 7.0), (NAN, 4.0), (5.0, 1.0), (9.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    x = np.array([(a, b) for a, b in rows if b is not None and a == a]).T
    assert correlation.pearson_pairs(df, ["a", "b"]).first()["corr"] == pytest.approx(np.corrcoef(x)[0, 1])
    ranks = np.argsort(np.argsort(x, axis=1), axis=1)
    assert correlation.spearman_pairs(df, ["a", "b"]).first()["corr"] == pytest.approx(np.corrcoef(ranks)[0, 1])


def test_pruning_follows_candidate_order():
    pairs = {("a", "b"): 0.95, ("a", "c"): -0.99, ("b", "c"): 0.1}
    prune = lambda scores: correlation.prune_correlated(pairs, ["a", "b", "c"], scores, 0.9)
    assert prune({"a": 1, "b": 1, "c": 5}) == ["c"]  # a drops b on a tie, then loses to c
    assert prune({"a": 9}) == ["a"]
    assert prune({"b": 9}) == ["b", "c"]
    assert correlation.prune_correlated({("a", "b"): None}, ["b", "a"], {}, 0.9) == ["a", "b"]


# -- exploratory tables ---------------------------------------------------------------------


@pytest.mark.parametrize(
    ("skew", "zeros", "want"),
    [
        (1.5, 0.1, ("high_pos_zero_skew", "log1p")),
        (1.5, 0.0, ("moderate_skew", "yeo_johnson")),  # strong right skew without zeros
        (-1.5, 0.1, ("high_neg_skew", "yeo_johnson")),
        (-1.5, 0.4, ("zero_inflated_high_skew", "log1p")),
        (0.7, 0.9, ("moderate_skew", "yeo_johnson")),
        (0.1, 0.0, ("low_skew", "none")),
        (None, None, ("constant_or_empty", "drop_or_ignore")),
    ],
)
def test_skew_classes(spark, skew, zeros, want):
    df = spark.createDataFrame([(skew, zeros)], "s double, z double")
    assert tuple(df.select(*eda.skew_class(F.col("s"), F.col("z"), SkewConfig())).first()) == want


def test_anova_with_p_values(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [3.0, 4.0, 5.0, 7.0, 8.0]
    df = spark.createDataFrame([(v, 5.0, float(i), 0) for i, v in enumerate(a)] + [(v, 5.0, float(i), 1) for i, v in enumerate(b)], "x double, same double, i double, y int")
    got = by(eda.anova_scores(df, "y"), "feature")
    na, nb, ma, mb = len(a), len(b), np.mean(a), np.mean(b)
    t = (ma - mb) / math.sqrt((np.var(a) * na + np.var(b) * nb) / (na + nb - 2) * (1 / na + 1 / nb))
    assert got["x"]["f_score"] == pytest.approx(t * t) and 0.02 < got["x"]["p_value"] < 0.05
    assert got["same"]["f_score"] is None and got["same"]["p_value"] is None
    split = df.withColumn("x", F.col("y").cast("double"))
    assert by(eda.anova_scores(split, "y", ["x"]), "feature")["x"]["f_score"] == INF


def test_mutual_information_extremes(spark):
    df = spark.range(400).select(
        (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2).cast("double").alias("same"),
        F.floor(F.col("id") / 2 % 10).cast("double").alias("free"),
    )
    got = by(eda.binned_mutual_information(df, "y"), "feature", "score")
    assert got["same"] == pytest.approx(math.log(2)) and got["free"] == pytest.approx(0.0, abs=1e-9)


def test_class_histograms_add_up(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("y"), F.sqrt("id").alias("x"))
    got = eda.class_histograms(df, "y", ["x"]).groupBy("label").agg(F.sum("density").alias("d")).collect()
    assert [r["d"] for r in got] == pytest.approx([1.0, 1.0])


def test_missing_sample_is_repeatable(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("a"), F.lit(1).alias("b"))
    one, two = (eda.missing_matrix(d, ["a", "b"], ["id"]) for d in (df, df.repartition(7)))
    assert one.columns == ["id", "a_missing"] and one.count() == 300 and sorted(one.collect()) == sorted(two.collect())


def test_importance_and_components(spark):
    df = spark.range(300).select(
        (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 * 3 + F.rand(1)).alias("signal"), F.rand(2).alias("noise"),
        F.lit(None).cast("double").alias("empty"),
    )
    found = importance.forest_importance(df, "y", ["signal", "noise"], trees=10)
    assert sum(found.values()) == pytest.approx(1.0) and found["signal"] > found["noise"]
    parts = importance.explained_variance(df, ["signal", "noise", "empty"]).collect()
    assert parts[-1]["cumulative"] == pytest.approx(1.0) and parts[0]["explained_variance_ratio"] > 0.9
    assert importance.explained_variance(df, ["signal"]).collect() == []
    reduced, report = importance.select_features(
        df, "y", ["signal", "noise", "empty", "gone"], SelectionConfig(mi_top_k=1, always_keep=("noise",))
    )
    assert reduced.columns == ["noise", "signal", "y"] and "empty" not in report["mutual_information"]
