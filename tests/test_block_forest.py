"""Importances of a forest whose rows are counted in blocks, against Spark's forest."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from framegate.operators import block_forest, importance


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    a, b, c = (i % 7).cast("double"), ((i * 13) % 11).cast("double"), ((i * 29) % 5).cast("double")
    y = F.when(a + b > 9, 1).when(c > 3, 2).otherwise(0)
    flip = F.when(i % 17 == 0, (y + 1) % 3).otherwise(y)
    return spark.range(0, 2000, 1, 4).select(a.alias("a"), F.when(b > 0, b).alias("b"), c.alias("c"), F.when(i % 101 != 0, flip).alias("y"))


def test_a_large_table_is_not_kept_for_every_tree(rows, monkeypatch):
    spark_like = importance.forest_importance(rows, "y", ["a", "b", "c"], trees=60)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("keeps a number for every row and tree"))
    monkeypatch.setattr(importance, "KEPT_NUMBERS", 0, raising=False)
    found = importance.forest_importance(rows, "y", ["a", "b", "c"], trees=60)
    assert sum(found.values()) == pytest.approx(1)
    assert found == {c: pytest.approx(v, abs=0.04) for c, v in spark_like.items()}
    assert found == importance.forest_importance(rows, "y", ["a", "b", "c"], trees=60)


def test_without_draws_a_tree_is_sparks(rows, monkeypatch):
    monkeypatch.setattr(block_forest, "draws", lambda n, *_: n)
    monkeypatch.setattr(block_forest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(block_forest, "COUNT_BYTES", 1)
    monkeypatch.setattr(importance, "KEPT_NUMBERS", 0)
    found = importance.forest_importance(rows, "y", ["a", "b", "c"], trees=1, max_depth=4, min_leaf=3)
    train = importance.feature_vectors(rows.dropna(subset="y"), ["a", "b", "c"], ["y"])
    tree = RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=4, minInstancesPerNode=3, bootstrap=False).fit(train)
    assert list(found.values()) == pytest.approx(tree.featureImportances.toArray().tolist())


def test_draws_are_poisson():
    n = np.repeat([1, 5], 50_000)
    drawn = block_forest.draws(n, 1, 2, 3)
    for k in (1, 5):
        own = drawn[n == k]
        assert own.mean() == pytest.approx(k, rel=0.03) and own.var() == pytest.approx(k, rel=0.04)
    assert (drawn == block_forest.draws(n, 1, 2, 3)).all() and (drawn != block_forest.draws(n, 1, 3, 3)).any()


def test_labels_that_sparks_forest_refuses_are_still_refused(rows, monkeypatch):
    monkeypatch.setattr(importance, "KEPT_NUMBERS", 0)
    with pytest.raises(Exception, match="(?i)label|class"):
        importance.forest_importance(rows.withColumn("y", F.col("y") - 0.5), "y", ["a", "b", "c"], trees=2)
