"""Splits, transforms, rebalancing, evaluation, selection, scoring."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import by
from pyspark.sql import functions as F

from framegate.config import Candidate, ForestSelectionConfig, GateConfig, SmoteConfig
from framegate.operators import evaluation, importance, preparation, resampling, scoring, tuning


@pytest.fixture(scope="module")
def rows(spark):
    """200 rows; the label follows from x1 + x2, one row in ten has no label."""
    rng = random.Random(0)
    data = [(i, rng.gauss(0, 1), rng.gauss(0, 1), math.exp(rng.gauss(0, 1))) for i in range(200)]
    out = [(i, a, b, c, None if i % 10 == 9 else int(a + b > 0.6)) for i, a, b, c in data]
    return spark.createDataFrame(out, "id bigint, x1 double, x2 double, x3 double, y int").repartition(4).cache()


# -- splits ---------------------------------------------------------------------------------


def test_split_is_stratified_and_repeatable(rows):
    n = by(rows.groupBy("y").count(), "y", "count")
    one = preparation.stratified_split(rows, "y", ["id"], 0.2)
    got = {(r["y"], r["is_test"]): r["count"] for r in one.groupBy("y", "is_test").count().collect()}
    for y in (0, 1):
        assert got[(y, True)] == math.floor(n[y] * 0.2 + 0.5) and got[(y, False)] == n[y] - got[(y, True)]
    assert got[(None, None)] == n[None]
    two = preparation.stratified_split(rows.repartition(9), "y", ["id"], 0.2)
    assert sorted(map(str, one.select("id", "is_test").collect())) == sorted(map(str, two.select("id", "is_test").collect()))
    other = preparation.stratified_split(rows, "y", ["id"], 0.2, seed=1)
    assert {r[0] for r in one.filter("is_test").select("id").collect()} != {r[0] for r in other.filter("is_test").select("id").collect()}


def test_fold_sizes_differ_by_one(rows):
    folded = preparation.stratified_folds(rows.dropna(), "y", ["id"], 7)
    for y in (0, 1):
        sizes = [r["count"] for r in folded.filter(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1


def test_tiny_classes_still_get_folds(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, y int")
    folds = [r["fold"] for r in preparation.stratified_folds(df, "y", ["id"], 5).collect()]
    assert all(0 <= f < 5 for f in folds)
    assert preparation.stratified_split(df, "y", ["id"], 0.0).filter("is_test").count() == 0
    assert preparation.stratified_split(df, "y", ["id"], 1.0).filter("is_test").count() == 3


def test_plain_folds(rows):
    assert {r["fold"] for r in preparation.plain_folds(rows, ["id"], 3).collect()} == {0, 1, 2}


# -- transforms -----------------------------------------------------------------------------


def log_likelihood(x, lam):
    pos, neg = x[x >= 0], x[x < 0]
    up = np.log1p(pos) if abs(lam) < 1e-9 else ((pos + 1) ** lam - 1) / lam
    down = -np.log1p(-neg) if abs(lam - 2) < 1e-9 else -((1 - neg) ** (2 - lam) - 1) / (2 - lam)
    v = np.concatenate([up, down]).var()
    return -len(x) / 2 * math.log(v) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))


def test_power_fit_finds_the_maximum(rows):
    fitted = preparation.fit_yeo_johnson(rows, ["x1", "x3"])
    for c, lam in fitted.items():
        x = np.array([r[0] for r in rows.select(c).collect()])
        best = max(np.arange(-5, 5, 0.001), key=lambda l: log_likelihood(x, l))
        assert lam == pytest.approx(best, abs=2e-3)


def test_power_transform_branches(spark):
    df = spark.createDataFrame([(3.0,), (0.0,), (-3.0,), (None,)], "x double")
    get = lambda lam: [r[0] for r in df.select(preparation.yeo_johnson(F.col("x"), lam)).collect()]
    assert get(0.0) == pytest.approx([math.log(4), 0.0, -(4**2 - 1) / 2, None])
    assert get(2.0) == pytest.approx([7.5, 0.0, -math.log(4), None])
    assert get(1.0) == pytest.approx([3.0, 0.0, -3.0, None])
    sql = [r[0] for r in df.select(F.expr(preparation.yeo_johnson_sql("x", 0.5))).collect()]
    assert sql == pytest.approx(get(0.5))


def test_fitted_transforms(rows):
    plan = {"x1": "yeo_johnson", "x2": "none", "x3": "log1p"}
    fitted = preparation.fit_transforms(rows, list(plan), plan)
    assert fitted.order == ("x3", "x1", "x2") and fitted.columns() == ["t_x3", "t_x1", "t_x2"]
    stats = fitted.apply(rows).agg(*[f(c) for c in fitted.columns() for f in (F.avg, F.stddev_pop)]).first()
    assert list(stats) == pytest.approx([0, 1] * 3, abs=1e-9)
    ranged = preparation.fit_transforms(rows, ["x2"], scaler="minmax").apply(rows).agg(F.min("t_x2"), F.max("t_x2")).first()
    assert list(ranged) == pytest.approx([0, 1])
    raw = preparation.fit_transforms(rows, ["x2"], scaler="none").apply(rows).filter("t_x2 <> x2").count()
    assert raw == 0
    with pytest.raises(ValueError, match="robust"):
        preparation.fit_transforms(rows, ["x2"], scaler="robust")


def test_transform_plan(spark):
    skew = spark.createDataFrame([("a", "log1p"), ("b", "yeo_johnson"), ("c", "drop_or_ignore")], "feature string, suggestion string")
    plan = preparation.transform_plan(skew, ["b", "a", "c", "d"])
    assert plan == {"b": "yeo_johnson", "a": "log1p", "c": "none", "d": "none"}
    assert preparation.output_order(plan) == ["a", "b", "c", "d"]


def test_many_classes(spark):
    df = spark.range(1500).select("id", (F.col("id") % 25).cast("int").alias("y"))
    got = preparation.stratified_folds(df, "y", ["id"], 5)
    assert {r["count"] for r in got.groupBy("y", "fold").count().collect()} == {12} and got.columns == ["id", "y", "fold"]


def in_class(rows, cutoff):
    """Per id, how many cut-off ranks of its class its hash reaches; rows: (id, label, hash)."""
    hashes = {}
    for _, y, h in rows:
        hashes.setdefault(y, []).append(h)
    ends = {y: [sorted(v)[r] for r in cutoff(len(v)) if r < len(v)] for y, v in hashes.items()}
    return {i: None if y is None else sum(h >= c for c in ends[y]) for i, y, h in rows}


@pytest.mark.parametrize("limit", [0, 500_000])
def test_classes_of_any_number_and_size(spark, monkeypatch, limit):
    """5,000 labels, one of them with a third of the rows, others with one row, some rows with the same key, some without label."""
    monkeypatch.setattr(preparation, "BROADCAST_CLASSES", limit)
    label = F.expr("case when id % 3 = 0 then 'hot' when id % 97 = 0 then null else concat('y', id % 5003) end")
    df = spark.range(12000).select("id", F.when(F.col("id") % 50 < 5, F.lit(7)).otherwise(F.col("id")).alias("key"), label.alias("y")).cache()
    rows = [tuple(r) for r in df.select("id", "y", preparation.row_hash(["key"], 42)).collect()]
    folds = in_class(rows, lambda n: [i * n // 4 for i in range(1, 4)])
    assert {r["id"]: r["fold"] for r in preparation.stratified_folds(df, "y", ["key"], 4).collect()} == folds
    test = in_class(rows, lambda n: [math.floor(n * 0.3 + 0.5)])
    split = preparation.stratified_split(df, "y", ["key"], 0.3)
    assert {r["id"]: r["is_test"] for r in split.collect()} == {i: None if p is None else p == 0 for i, p in test.items()}
    empty = preparation.stratified_folds(df.limit(0), "y", ["key"], 4)
    assert empty.columns == ["id", "key", "y", "fold"] and empty.count() == 0


# -- rebalancing ----------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_points", [50_000, 10])
def test_smote_balances_inside_the_minority(rows, broadcast_points):
    train = rows.dropna()
    out = resampling.smote(train, "y", ["x1", "x2"], ["id"], broadcast_points=broadcast_points).cache()
    n = by(out.groupBy("y").count(), "y", "count")
    assert n[0] == n[1] and out.filter("not synthetic").count() == train.count()
    made = np.array([[r["x1"], r["x2"]] for r in out.filter("synthetic").collect()])
    real = np.array([[r["x1"], r["x2"]] for r in train.filter("y = 1").collect()])
    assert (made.min(0) >= real.min(0)).all() and (made.max(0) <= real.max(0)).all()
    for p in made:  # every new point lies on a segment between two minority points
        a, d = real[:, None, :], real[None, :, :] - real[:, None, :]
        length = (d**2).sum(-1)
        u = np.clip(((p - a) * d).sum(-1) / np.where(length == 0, 1, length), 0, 1)
        assert np.sqrt(((a + u[..., None] * d - p) ** 2).sum(-1)).min() < 1e-9
    again = resampling.smote(train.repartition(3), "y", ["x1", "x2"], ["id"], broadcast_points=broadcast_points)
    assert sorted(again.collect()) == sorted(out.collect())


def test_smote_limits(rows, spark):
    few = spark.createDataFrame([(i, float(i), int(i == 0)) for i in range(9)], "id int, x double, y int")
    with pytest.raises(ValueError, match="neighbours"):
        resampling.smote(few, "y", ["x"], ["id"])
    assert resampling.smote(few, "y", ["x"], ["id"], SmoteConfig(enabled=False)).count() == 9
    even = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 1)], "id int, x double, y int")
    assert resampling.smote(even, "y", ["x"], ["id"]).count() == 2


def test_smote_is_the_same_on_both_paths_for_repeated_keys(spark):
    """One key for all rows, many rows equal, and ties in distance: the way of searching does not show."""
    df = spark.range(160).select(
        F.lit(7).alias("id"), (F.col("id") % 9).cast("double").alias("a"), (F.col("id") % 4).cast("double").alias("b"), (F.col("id") % 5 == 0).cast("int").alias("y")
    )
    sums = []
    for points in (50_000, 3):
        out = resampling.smote(df, "y", ["a", "b"], ["id"], broadcast_points=points)
        assert by(out.groupBy("y").count(), "y", "count") == {0: 128, 1: 128}
        sums.append(sorted((r["a"], r["b"]) for r in out.filter("synthetic").collect()))
    assert sums[0] == sums[1]


def test_smote_of_equal_rows(spark):
    df = spark.range(40).select(F.col("id"), F.lit(2.0).alias("x"), (F.col("id") < 8).cast("int").alias("y"))
    out = resampling.smote(df, "y", ["x"], ["x"])
    assert out.filter("synthetic").count() == 24 and out.filter("x <> 2").count() == 0


def test_smote_more_than_doubles(spark):
    df = spark.range(130).select("id", F.col("id").cast("double").alias("x"), (F.col("id") < 20).cast("int").alias("y"))
    out = resampling.smote(df, "y", ["x"], ["id"], SmoteConfig(k_neighbors=3))
    assert by(out.groupBy("y").count(), "y", "count") == {0: 110, 1: 110}


# -- evaluation -----------------------------------------------------------------------------


@pytest.fixture()
def five(spark):
    rows = list(zip([1, 0, 0, 1, 1, 0], [1, 1, 0, 1, 0, 0], [0.95, 0.6, 0.3, 0.7, 0.65, 0.05]))
    return spark.createDataFrame(rows, "y int, p int, s double")


def test_known_metrics(five):
    m = by(evaluation.label_metrics(five, "y", "p"), "metric", "value")
    # two hits, one false alarm, one miss, two rejections
    assert all(m[k] == pytest.approx(2 / 3) for k in ("precision", "recall", "f1", "accuracy", "balanced_accuracy"))
    assert evaluation.ranking_measures(five, "y", "s").first().asDict() == {"roc_auc": 1.0, "average_precision": 1.0}
    report = by(evaluation.classification_report(five, "y", "p"), "label")
    assert report["0"]["precision"] == pytest.approx(2 / 3) and report["1"]["support"] == 3
    assert report["accuracy"]["f1"] == pytest.approx(2 / 3) and report["macro avg"]["recall"] == pytest.approx(2 / 3)


def test_classes_of_different_types(spark):
    df = spark.createDataFrame([(1, 1.0, True), (0, 1.0, False), (1, 0.0, True), (0, 0.0, True)], "y int, d double, b boolean")
    for kind in ("int", "double", "string", "decimal(4,1)", "boolean"):
        typed = df.withColumn("y", F.col("y").cast(kind)) if kind != "string" else df.withColumn("y", F.col("y").cast("string"))
        got = by(evaluation.classification_report(typed, "y", "d"), "label")
        assert set(got) == {"0", "1", "accuracy", "macro avg", "weighted avg"} and got["1"]["recall"] == 0.5
    assert by(evaluation.classification_report(df, "y", "b"), "label")["1"]["precision"] == pytest.approx(2 / 3)
    halves = df.withColumn("d", F.col("d") / 2)
    assert {"0", "0.5", "1"} <= set(by(evaluation.classification_report(halves, "y", "d"), "label"))


def brute_auc(y, s):
    pairs = [(a > b) + (a == b) / 2 for a, ya in zip(s, y) if ya for b, yb in zip(s, y) if not yb]
    return sum(pairs) / len(pairs)


def test_ranking_with_ties(spark):
    rng = random.Random(5)
    y, s = [rng.randrange(2) for _ in range(150)], [rng.randrange(12) / 10 for _ in range(150)]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    got = evaluation.ranking_measures(df, "y", "s").first()
    assert got["roc_auc"] == pytest.approx(brute_auc(y, s))
    ap, before = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = [a for a, b in zip(y, s) if b >= t]
        ap += (sum(hit) / sum(y) - before) * sum(hit) / len(hit)
        before = sum(hit) / sum(y)
    assert got["average_precision"] == pytest.approx(ap)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.7)], "y int, s double")
    got = evaluation.ranking_measures(df, "y", "s").first()
    assert got["roc_auc"] is None and got["average_precision"] == 0.0
    sweep = evaluation.threshold_sweep(df, "y", "s").orderBy("threshold").first()
    assert sweep["f1"] == 0 and sweep["balanced_accuracy"] == 0.0


def test_sweep_equals_brute_force(spark):
    rng = random.Random(2)
    s = [i * 0.01 for i in range(101)] + [rng.random() for _ in range(200)] + [-0.2, 1.3]
    data = [(rng.randrange(2), v) for v in s] + [(1, None)]
    df = spark.createDataFrame(data, "y int, s double")
    got = evaluation.threshold_sweep(df, "y", "s").orderBy("threshold").collect()
    assert len(got) == 101
    for r, t in zip(got, np.arange(101) * 0.01):
        scored = [(y, v >= t) for y, v in data if v is not None]
        assert r["threshold"] == t
        assert (r["tp"], r["fp"]) == (sum(y and h for y, h in scored), sum((not y) and h for y, h in scored))
        assert (r["fn"], r["tn"]) == (sum(y and not h for y, h in scored), sum(not (y or h) for y, h in scored))


def test_first_maximum_wins(spark, five):
    sweep = evaluation.threshold_sweep(five, "y", "s")
    best = evaluation.best_threshold(sweep, "f1").first()
    assert best["score"] == 1.0 and best["threshold"] == pytest.approx(0.61)
    with pytest.raises(ValueError, match="roc_auc"):
        evaluation.best_threshold(sweep, "roc_auc")
    scores = spark.createDataFrame([(0, "a", None), (1, "b", 0.7), (2, "c", 0.7)], "position int, name string, score double")
    assert evaluation.best_candidate(scores).first()["name"] == "b"


def test_holdout_at_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.4), (1, 0.9)], "y int, s double")
    got = by(evaluation.evaluate_at_thresholds(df, "y", "s", 0.5), "variant")
    assert got["default"]["recall"] == 0.5 and got["tuned"]["recall"] == 1.0


def test_gates(spark):
    m = spark.createDataFrame([(0.71, 0.6, 0.80)], "f1 double, recall double, previous_f1 double")
    got = by(evaluation.promotion_gates(m, GateConfig(max_drop_vs_previous=0.05)), "check")
    assert got["min_f1"]["ok"] and not got["min_recall"]["ok"] and not got["max_drop_vs_previous"]["ok"]
    assert got["max_drop_vs_previous"]["value"] == pytest.approx(0.09)
    first = m.withColumn("previous_f1", F.lit(None).cast("double"))
    assert set(by(evaluation.promotion_gates(first, GateConfig(max_drop_vs_previous=0.05)), "check")) == {"min_f1", "min_recall"}
    assert evaluation.gates_passed(evaluation.promotion_gates(m, GateConfig(min_recall=None))).first()["passed"]
    with pytest.raises(ValueError):
        evaluation.promotion_gates(m, GateConfig(None, None))


def test_decay_by_hand(spark):
    # three hits, one miss, one false alarm, three rejections: every measure is 0.75
    df = spark.createDataFrame(list(zip([1, 1, 0, 0, 1, 0, 1, 0], [1, 0, 0, 1, 1, 0, 1, 0])), "y int, p int")
    reference = {"f1": 0.78, "precision": 0.77, "recall": 0.9, "accuracy": 0.75}
    got = by(evaluation.metric_decay(evaluation.label_metrics(df, "y", "p"), reference), "metric")
    assert got["recall"]["drop"] == pytest.approx(0.15) and got["recall"]["alert"] and not got["f1"]["alert"]
    assert got["accuracy"]["drop"] == pytest.approx(0.0)


# -- selection and training -----------------------------------------------------------------

FEATURES = ("x1", "x2", "x3")
FOREST = Candidate("rf", tuning.FOREST, {"n_estimators": 8, "max_depth": 4})


def test_unknown_parameters_raise():
    for kind, name in ((tuning.FOREST, "reg_lambda"), (tuning.BOOSTING, "min_samples_leaf"), (tuning.SECOND_ORDER, "max_features")):
        with pytest.raises(ValueError, match=name):
            tuning.make_estimator(Candidate("m", kind, {name: 3}))
    with pytest.raises(ValueError, match="31"):
        tuning.make_estimator(Candidate("m", tuning.FOREST, {"max_depth": 31}))


def test_a_search_leaves_no_files(spark, rows, tmp_path, monkeypatch):
    import os

    from framegate import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    folded = preparation.stratified_folds(rows.dropna(), "y", ["id"], 2)
    setup = tuning.TrainingSetup("y", FEATURES, ("id",))
    chosen = tuning.select_model(folded, setup, [FOREST], ["f1"], "f1", trials=1, space={tuning.FOREST: {"n_estimators": (3,), "max_depth": (2,)}})
    assert chosen.best.means["f1"] is not None
    assert [f for _, _, files in os.walk(tmp_path / "framegate") for f in files] == []


def test_unknown_kinds_and_metrics(rows):
    with pytest.raises(ValueError, match="svm"):
        tuning.make_estimator(Candidate("x", "svm"))
    with pytest.raises(ValueError):
        tuning.fold_scores(rows, ["mse"])


def test_params_reach_the_estimators():
    deep = tuning.make_estimator(Candidate("rf", tuning.FOREST, {"n_estimators": 7, "max_depth": None, "min_samples_leaf": 3, "max_features": None}))
    assert (deep.getNumTrees(), deep.getMaxDepth(), deep.getMinInstancesPerNode(), deep.getFeatureSubsetStrategy()) == (7, 30, 3, "all")
    boost = tuning.make_estimator(Candidate("gb", tuning.BOOSTING, {"n_estimators": 4, "learning_rate": 0.3, "subsample": 0.9}))
    assert (boost.getMaxIter(), boost.getStepSize(), boost.getSubsamplingRate()) == (4, 0.3, 0.9)
    own = tuning.make_estimator(Candidate("b", tuning.BALANCED_FOREST, {"n_estimators": 3, "min_samples_split": 4, "max_features": None}))
    assert [own.getOrDefault(p) for p in (own.numTrees, own.minSplit, own.featureSubset, own.balanced, own.maxDepth)] == [3, 4, "all", True, 30]
    plain = tuning.make_estimator(Candidate("f", tuning.FOREST, {"min_samples_split": 4}))
    assert plain.getOrDefault(plain.balanced) is False
    second = tuning.make_estimator(Candidate("x", tuning.SECOND_ORDER, {"reg_lambda": 2, "colsample_bytree": 0.5, "random_state": 7}))
    assert [second.getOrDefault(p) for p in (second.regLambda, second.featureShare, second.stepSize, second.seed, second.maxDepth)] == [2.0, 0.5, 0.3, 7, 6]


def test_search_draws_are_seeded():
    a, b = (tuning.draw_params(tuning.BOOSTING, random.Random(4)) for _ in range(2))
    assert a == b and 0.01 <= a["learning_rate"] <= 1.0 and 3 <= a["max_depth"] <= 10


def test_ties_keep_the_earlier_candidate():
    results = [tuning.CvResult(Candidate(n, tuning.FOREST), "baseline", {}, {"f1": v}) for n, v in [("a", None), ("b", 0.5), ("c", 0.5)]]
    assert tuning.first_best(results, "f1").candidate.name == "b"


def test_importance_choice():
    found = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}
    choose = lambda **k: importance.choose_by_importance(found, ["d", "c", "b", "a"], ForestSelectionConfig(**k))
    assert choose(top_k=2) == ["b", "a"] and choose(top_k=1, min_importance=0.1) == ["c", "b", "a"]
    assert choose(top_k=1, always_keep=("d", "zz")) == ["d", "a"] and choose(top_k=0) == ["d", "c", "b", "a"]


def test_select_train_score_and_reload(rows, spark, tmp_path):
    folded = preparation.stratified_folds(rows.dropna(), "y", ["id"], 3)
    setup = tuning.TrainingSetup("y", FEATURES, ("id",), {"x1": "yeo_johnson", "x2": "none", "x3": "log1p"})
    predicted = tuning.fold_predictions(tuning.prepare_folds(folded, setup), setup, FOREST)
    assert predicted.count() == folded.count()  # synthetic rows never reach validation
    found = tuning.select_model(folded, setup, [FOREST, Candidate("brf", tuning.BALANCED_FOREST, {"n_estimators": 5})], ["roc_auc"], "f1")
    assert found.best.means["f1"] > 0.6 and 0 <= found.threshold <= 1 and len(found.results) == 2
    model = tuning.train_final(folded, setup, found.best.candidate)
    package = scoring.ModelPackage(model, FEATURES, found.threshold, "y", "p1")
    package.save(spark, str(tmp_path / "package"))
    loaded = scoring.ModelPackage.load(spark, str(tmp_path / "package"))
    assert loaded.features == FEATURES and loaded.threshold == found.threshold
    first, second = (sorted(scoring.score_batch(rows, p).select("id", "prediction_proba", "prediction").collect()) for p in (package, loaded))
    assert first == second and len(first) == 200
    rows.write.parquet(str(tmp_path / "in.parquet"))
    scoring.run_batch_scoring(spark, loaded, str(tmp_path / "in.parquet"), str(tmp_path / "out.parquet"))
    assert spark.read.parquet(str(tmp_path / "out.parquet")).columns == [*rows.columns, "prediction_proba", "prediction", "threshold_used"]
    with pytest.raises(ValueError, match="x3"):
        scoring.score_batch(rows.drop("x3"), loaded)


def test_search_then_refit(rows):
    folded = preparation.stratified_folds(rows.dropna(), "y", ["id"], 2)
    setup = tuning.TrainingSetup("y", ("x1", "x2"), ("id",))
    space = {"n_estimators": (3, 4), "max_depth": (2,)}
    best, model = tuning.search_then_refit(folded, setup, FOREST, ["f1"], "f1", 2, space)
    assert best.candidate.params["n_estimators"] in (3, 4) and best.variant == "search"
    assert model.transform(rows).filter("prediction is null").count() == 0


# -- scoring contracts ----------------------------------------------------------------------


def test_rounding_happens_after_the_decision(spark):
    df = spark.createDataFrame([(0.4999999,), (0.5,)], "p double")
    got = scoring.serve_rows(df, "p", 0.5).collect()
    assert [(r["prediction"], r["probability"]) for r in got] == [(0, 0.5), (1, 0.5)]


def test_payloads(spark):
    nan = float("nan")
    rows = [({"a": 1.0, "b": 2.0},), ({"a": nan, "c": 1.0},), ({"a": None, "b": float("inf")},), (None,)]
    df = spark.createDataFrame(rows, "features map<string,double>")
    got = scoring.validate_payloads(df, ["b", "a"]).collect()
    counts = [(r["missing_count"], r["unexpected_count"], r["invalid_value_count"], r["payload_valid"]) for r in got]
    assert counts == [(0, 0, 0, True), (1, 1, 1, False), (0, 0, 2, False), (2, 0, 0, False)]
    assert got[0]["payload_error"] is None
    assert got[1]["payload_error"] == "Missing features: [b] | Unexpected features: [c] | Invalid numeric values for: [a]"


def test_predictions(spark):
    rows = [(1, 0.5), (2, 0.5), (0, 1.2), (0, float("nan")), (0, None), (None, 0.3), (-1, -1.0)]
    df = spark.createDataFrame(rows, "prediction int, probability double")
    got = scoring.validate_predictions(df).collect()
    assert [r["prediction_valid"] for r in got] == [True] + [False] * 6
    assert got[1]["prediction_error"] == "Invalid prediction value: 2" and "range" in got[2]["prediction_error"]
    assert "finite" in got[3]["prediction_error"] and "numeric" in got[4]["prediction_error"]
