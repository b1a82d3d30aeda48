"""Work that must not be done again and again, or by one task alone, however the inputs grow."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from framegate.config import Candidate, SmoteConfig
from framegate.functions import neighbours
from framegate.operators import correlation, eda, importance, trees, tuning


def _counted(spark, n=60):
    """Rows in three folds whose feature counts how often it is worked out."""
    times = spark.sparkContext.accumulator(0)

    def value(x):
        times.add(1)
        return float(x * 7 % 11)

    made = F.udf(value, "double")
    rows = spark.range(n).select("id", made("id").alias("a"), (F.col("id") % 4 == 0).cast("int").alias("y"), (F.col("id") % 3).cast("int").alias("fold"))
    return rows, times


_SETUP = tuning.TrainingSetup("y", ("a",), ("id",), smote=SmoteConfig(k_neighbors=2))
_FOREST = Candidate("f", tuning.FOREST, {"n_estimators": 2, "max_depth": 2})


def test_features_are_worked_out_once_for_all_folds_and_candidates(spark):
    rows, times = _counted(spark)
    folds = tuning.prepare_folds(rows, _SETUP)
    tuning.cross_validate(folds, _SETUP, _FOREST, ["f1", "roc_auc"])
    assert times.value <= 2 * 60  # a checkpoint counts its rows, then writes them


def test_search_and_refit_work_features_out_once(spark):
    rows, times = _counted(spark)
    tuning.search_then_refit(rows, _SETUP, _FOREST, ["f1"], "f1", trials=1, space={"max_depth": (2,)})
    assert times.value <= 2 * 60


def test_grid_search_works_features_out_once(spark):
    rows, times = _counted(spark)
    predicted = tuning.nested_grid_search(rows, ["a"], "y", _FOREST, {"max_depth": [1, 2]}, inner_folds=2)
    assert predicted.count() == 60
    assert times.value <= 2 * 60


def test_equal_rows_of_a_bag_grow_as_one(spark, monkeypatch):
    rows = spark.range(400).select("id", F.array((F.col("id") % 4).cast("double")).alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    seen = []
    monkeypatch.setattr(trees, "grow", lambda drawn, *rest: seen.append(drawn.collect()))
    trees.fit_forest(rows, "y", F.col("x"), ["id"], 3, [[1.0, 2.0, 3.0]], trees.gini(2))
    assert len(seen[0]) <= 3 * 4
    assert sum(r["n"] for r in seen[0]) == 3 * 400


def test_a_small_table_of_points_is_searched_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TASK_PAIRS", 1_000)
    points = spark.range(100).select(F.col("id").alias("key"), F.array(F.col("id").cast("double")).alias("vec"))
    near = neighbours.nearest_neighbours(points, 2)
    assert near.rdd.getNumPartitions() == 11
    assert {r["key"]: r["near"] for r in near.collect()}[50] == [[49.0], [51.0]]


def test_ranks_of_wide_tables_with_few_values_are_looked_up_where_rows_lie(spark, monkeypatch):
    names = [f"c{i:02d}" for i in range(correlation.WIDE_COLUMNS)]
    rows = spark.range(300).select(*[((F.col("id") * (2 * i + 1)) % (5 + i) - 3).cast("double").alias(c) for i, c in enumerate(names)])
    looked_up = correlation.spearman_pairs(rows, names)
    assert "hashpartitioning(row#" not in looked_up._jdf.queryExecution().toString()
    monkeypatch.setattr(correlation, "BROADCAST_RANKS", 0)
    travelled = correlation.spearman_pairs(rows, names)
    assert "hashpartitioning(row#" in travelled._jdf.queryExecution().toString()
    got, want = ({(r["feature_a"], r["feature_b"]): r["corr"] for r in t.collect()} for t in (looked_up, travelled))
    assert len(got) == 780 and got.keys() == want.keys()
    assert all(got[p] is None if r is None else abs(got[p] - r) < 1e-9 for p, r in want.items())  # one column is constant


def test_rows_of_a_forest_are_dealt_out_by_what_a_task_holds(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: seen.append(df.rdd.getNumPartitions()) or fit(self, df, *a))
    monkeypatch.setattr(importance, "TASK_NUMBERS", 200, raising=False)
    rows = spark.range(0, 400, 1, 2).select(F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("b"), (F.col("id") % 2).cast("int").alias("y"))
    found = importance.forest_importance(rows, "y", ["a", "b"], trees=3)
    assert seen == [10]  # 400 rows of 5 numbers
    assert found["b"] > found["a"]


def test_binned_information_counts_rows_as_they_are(spark, monkeypatch):
    """No row is taken apart into one for each feature, and features of several scans score as those of one."""
    rows = [(None, 1.0, "a"), (2.0, None, "b"), (float("nan"), 3.0, "a"), (4.0, 3.0, None), (5.0, 9.0, "b"), (5.0, 1.0, "b"), (7.0, -1.0, "a"), (float("inf"), 2.0, "c")]
    df = spark.createDataFrame(rows * 2, "x double, `a.b` double, y string").withColumns({"empty": F.lit(None).cast("double"), "q'": F.lit(3)})
    found = eda.binned_mutual_information(df, "y", ["x", "a.b", "empty", "q'"], cuts={"x": [5.0, 2.0, 5.0, 7.0], "a.b": [1.0, 2.0], "empty": [], "q'": [3.0]})
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    scores = {r["feature"]: r["score"] for r in found.collect()}

    def brute(at, cuts):
        seen = [(sum(r[at] >= c for c in cuts), r[2]) for r in rows if r[at] is not None and r[at] == r[at] and r[2] is not None]
        share = lambda test: sum(map(test, seen)) / len(seen)
        return sum(share(lambda s: s == c) * math.log(share(lambda s: s == c) / share(lambda s: s[0] == c[0]) / share(lambda s: s[1] == c[1])) for c in set(seen))

    assert scores == {"x": pytest.approx(brute(0, [2, 5, 7])), "a.b": pytest.approx(brute(1, [1, 2])), "q'": pytest.approx(0)}
    monkeypatch.setattr(eda, "MAX_AGGREGATES", 5, raising=False)
    apart = eda.binned_mutual_information(df, "y", ["x", "a.b", "q'"], cuts={"x": [5.0, 2.0, 7.0], "a.b": [1.0, 2.0], "q'": [3.0]})
    assert {r["feature"]: r["score"] for r in apart.collect()} == pytest.approx(scores)
