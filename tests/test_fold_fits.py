"""Models of a search that tasks fit on whole folds, against the models that Spark's jobs fit; and how much is searched."""

from __future__ import annotations

import inspect

import numpy as np
import pytest

from framegate.bindings import models
from framegate.config import Candidate, SmoteConfig
from framegate.operators import fold_fits, trees, tuning
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

_SETUP = tuning.TrainingSetup("y", ("a", "b", "c"), ("id",), smote=SmoteConfig(enabled=False))


@pytest.fixture(scope="module")
def prepared(spark):
    """Two folds: two features of many values, one of few, with repeated rows."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 3))
    x[:, 2] = x[:, 2].round()
    y = (x[:, 0] + x[:, 1] * x[:, 2] + draw.normal(size=300) * 0.7 > 0.4).astype(int)
    rows = [(i, *map(float, x[i % 290]), int(y[i % 290]), i % 2) for i in range(300)]
    return tuning.prepare_folds(spark.createDataFrame(rows, "id int, a double, b double, c double, y int, fold int"), _SETUP)


@pytest.mark.parametrize(
    "candidate",
    [
        Candidate("g", tuning.BOOSTING, {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3}),
        Candidate("b", tuning.BALANCED_FOREST, {"n_estimators": 3, "max_depth": 3, "max_features": None, "min_samples_split": 9}),
        Candidate("b", tuning.BALANCED_FOREST, {"n_estimators": 2, "max_depth": 1, "min_samples_leaf": 3, "random_state": 7}),
    ],
    ids=["boosting", "all_features", "drawn_features"],
)
def test_tasks_fit_what_jobs_fit(prepared, candidate, monkeypatch):
    monkeypatch.setattr(fold_fits, "CHUNK_ROWS", 300)  # trees of a forest in several chunks
    folds = tuning.pack_folds(prepared, _SETUP, [candidate])
    one, other = tuning.trial_results(prepared, _SETUP, [candidate, candidate], ["f1", "roc_auc"], folds=folds)
    assert one.folds == other.folds
    by_jobs = tuning.cross_validate(prepared, _SETUP, candidate, ["f1", "roc_auc"])
    scores = [[tuple(r) for r in d.predictions.orderBy("fold", "score").select("fold", F.round("score", 9)).collect()] for d in (one, by_jobs)]
    assert len(scores[0]) == 300 and scores[0] == scores[1]
    assert one.folds["f1"] == pytest.approx(by_jobs.folds["f1"])


def test_a_tree_of_a_forest_is_sparks_tree(prepared):
    """Without draws both grow the same tree, and sister leaves of the same class are one."""
    fold = prepared[0]
    model = RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=4, minInstancesPerNode=2, featureSubsetStrategy="all", bootstrap=False).fit(fold.train)
    scored = model.transform(fold.held).select("features", vector_to_array("probability")[1]).collect()
    want = [r[1] for r in scored]
    held = np.array([r[0].toArray() for r in scored])
    train = np.array([[*r[0].toArray(), r[1]] for r in fold.train.select("features", "y").collect()])
    cuts = [fold_fits.boosting_cuts(v) for v in train[:, :3].T]
    bins, held_bins = (np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)]) for x in (train[:, :3], held))
    score, _ = fold_fits.forest(bins, train[:, 3].astype(np.uint8), held_bins, [len(c) for c in cuts], 1, 4, 2, "all", 1, bootstrap=False)
    assert score == pytest.approx(want)


def test_a_forest_of_draws_ranks_as_well_as_sparks(prepared):
    forest = Candidate("f", tuning.FOREST, {"n_estimators": 60, "max_depth": 4})
    folds = tuning.pack_folds(prepared, _SETUP, [forest])
    by_tasks = tuning.trial_results(prepared, _SETUP, [forest], ["roc_auc"], folds=folds)[0]
    assert by_tasks.means["roc_auc"] == pytest.approx(tuning.cross_validate(prepared, _SETUP, forest, ["roc_auc"]).means["roc_auc"], abs=0.03)


def test_draws_are_those_of_the_bags(spark):
    ids = np.array([0, 1, 77, 1 << 40])
    from framegate.functions.hashing import row_hash

    want = [r[0] % 1000 for r in spark.createDataFrame([(int(i),) for i in ids], "id bigint").select(row_hash(["id"], 9)).collect()]
    assert fold_fits.drawn(ids, 9, 1000).tolist() == want


def test_quantile_cuts(spark):
    values = [0.1, 0.1, 0.7, 3.0, 3.0, 3.0, 4.5, 8.25, 9.0, 11.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert fold_fits.quantile_cuts(np.array(values)).tolist() == trees.cut_points(df, ["v"])[0]


def test_a_fold_that_is_too_large_is_left_to_jobs(prepared, monkeypatch):
    boost = Candidate("g", tuning.BOOSTING, {"n_estimators": 2, "max_depth": 2})
    assert tuning.task_trial(Candidate("g", tuning.BOOSTING, {"subsample": 0.5}), _SETUP) is None
    assert tuning.task_trial(Candidate("f", tuning.FOREST, {"min_samples_split": 4}), _SETUP) is None
    assert tuning.task_trial(Candidate("s", tuning.SECOND_ORDER), _SETUP) is None
    monkeypatch.setattr(fold_fits, "FOLD_NUMBERS", 10)
    assert tuning.pack_folds(prepared, _SETUP, [boost]) is None
    found = tuning.random_search(prepared, _SETUP, boost, ["f1"], "f1", 2, {"max_depth": (1, 2)})
    assert found.predictions.count() == 300


def _asked(monkeypatch, query, name):
    """The arguments with which a query calls a function of `tuning`; nothing is searched."""
    seen, signature = [], inspect.signature(getattr(tuning, name))

    class Asked(Exception):
        pass

    def stop(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        seen.append(bound.arguments)
        raise Asked

    monkeypatch.setattr(models, "_folded", lambda *a: None)
    monkeypatch.setattr(tuning, "prepare_folds", lambda *a, **k: [])
    monkeypatch.setattr(tuning, name, stop)
    with pytest.raises(Asked):
        query(None, "")
    return seen[0]


def test_boosting_search_is_whole(monkeypatch):
    asked = _asked(monkeypatch, models.boosting_search, "random_search")
    assert asked["trials"] >= 25 and asked["space"] in (None, tuning.BOOSTING_SPACE)
    assert asked["candidate"].params == {}


def test_model_selection_is_whole(monkeypatch):
    asked = _asked(monkeypatch, models.model_selection, "select_model")
    assert asked["trials"] >= 25 and asked["space"] is None
    sizes = {c.name: (c.params["n_estimators"], c.params["max_depth"]) for c in asked["candidates"]}
    assert sizes == {"forest": (500, 8), "balanced": (500, 8), "boosting": (400, 5)}
