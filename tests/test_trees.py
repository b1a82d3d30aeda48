"""Trees against plain recursive ones, bags, missing values, saved models."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from framegate.config import Candidate
from framegate.functions.cumulative import row_numbers
from framegate.operators import trees, tuning

CUTS = [[1.0, 2.0, 3.0], [0.5], [10.0, 20.0]]


def data(n=200, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [rng.choice([0.0, 1.0, 1.5, 2.0, 3.0, 9.0, None]), rng.random(), rng.choice([5.0, 15.0, 25.0, None])]
        out.append((i, x, int((x[0] or 4) + 3 * x[1] + rng.random() > 4.2)))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(data(), "id long, x array<double>, y int").cache()


def plain_tree(rows, depth, score, value, least_rows=0.0, least_split=0.0, least_second=0.0):
    """Leaves as {path: (rows, value)} over (x, a, b, n); the first best of all splits in the order of feature, cut, missing right."""

    def sums(some):
        return [sum(r[k] for r in some) for k in (1, 2, 3)]

    def build(some, path):
        a, b, n = sums(some)
        best = None
        if len(path) < depth and n >= least_split:
            for f, own in enumerate(CUTS):
                known = [r[0][f] for r in some if r[0][f] is not None]
                for c in [-1e9, *own]:
                    for missing_left in (False, True):
                        if (missing_left and len(known) == len(some)) or (c > -1e9 and not min(known, default=c) < c <= max(known, default=c - 1)) or (c == -1e9 and not missing_left):
                            continue
                        left = [r for r in some if (missing_left if r[0][f] is None else r[0][f] < c)]
                        right = [r for r in some if not (missing_left if r[0][f] is None else r[0][f] < c)]
                        (la, lb, ln), (ra, rb, rn) = sums(left), sums(right)
                        if not left or not right or min(ln, rn) < least_rows or min(lb, rb) < least_second:
                            continue
                        gain = score(la, lb) + score(ra, rb) - score(a, b)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = gain, left, right
        if best is None:
            return {path: (len(some), round(value(a, b), 9))}
        return build(best[1], path + "L") | build(best[2], path + "R")

    return build(rows, "")


def leaves(tree, df, depth):
    paths = tree.paths()
    at = trees.routed(F.get(trees.as_column([tree]), F.lit(0)), F.col("x"), "cut", depth)
    return {paths[r["at"]]: (r["count"], round(tree.value[r["at"]], 9)) for r in df.select(at.alias("at")).groupBy("at").count().collect()}


def grown(df, growth, a, b):
    rows = df.select(F.lit(0).alias("tree"), trees.binned(F.col("x"), CUTS).alias("bins"), a.alias("a"), b.alias("b"), F.lit(1.0).alias("n"))
    return trees.grow(rows, 1, CUTS, growth)[0]


@pytest.mark.parametrize("limits", [{}, {"least_rows": 12.0}, {"least_split": 60.0}])
def test_gini_tree(rows, limits):
    y = F.col("y").cast("double")
    tree = grown(rows, trees.gini(4, **limits), y, 1 - y)
    square = lambda a, b: (a * a + b * b) / (a + b) if a + b else 0.0
    want = plain_tree([(x, float(y), 1.0 - y, 1.0) for _, x, y in data()], 4, square, lambda a, b: a / (a + b), **{"least_split": 2.0, **limits})
    assert leaves(tree, rows, 4) == want and len(want) > 4


def test_second_order_tree(rows):
    cfg = trees.BoostingConfig(trees=1, depth=3, reg_lambda=0.7, min_child_weight=4.0, learning_rate=0.5)
    tree = trees.fit_boosting(rows, "y", F.col("x"), CUTS, cfg)[0]
    score = lambda g, h: g * g / (h + 0.7)
    want = plain_tree([(x, 0.5 - y, 0.25, 1.0) for _, x, y in data()], 3, score, lambda g, h: -0.5 * g / (h + 0.7), least_second=4.0)
    assert leaves(tree, rows, 3) == want and len(want) > 2


def test_margins_lower_the_loss(spark, rows, monkeypatch):
    monkeypatch.setattr(trees, "WRITE_EVERY", 2)
    cfg = trees.BoostingConfig(trees=6, depth=2, subsample=0.8, colsample_bytree=0.67)
    made = trees.fit_boosting(rows, "y", F.col("x"), CUTS, cfg)
    each = rows.select("y", trees.tree_values(trees.as_column(made), F.col("x"), 2).alias("v")).collect()

    def loss(k):
        return sum(math.log(1 + math.exp(-(2 * r.y - 1) * sum(r.v[:k]))) for r in each)

    assert loss(6) < loss(3) < loss(0) and made == trees.fit_boosting(rows, "y", F.col("x"), CUTS, cfg)
    assert all(len(set(t.feature[n] for n in range(len(t.left)) if t.left[n] >= 0)) <= 2 for t in made)


def test_bags(spark, rows):
    bags = trees.balanced_bags(rows, "y", ["id"], 5).collect()
    less = min(sum(1 for *_, y in data() if y == k) for k in (0, 1))
    for tree in range(5):
        assert [sum(r.n for r in bags if r.tree == tree and r.y == k) for k in (0, 1)] == [less, less]
    again = trees.balanced_bags(rows.repartition(7), "y", ["id"], 5).collect()
    assert sorted(bags) == sorted(again) and len({frozenset((r.id, r.n) for r in bags if r.tree == t) for t in range(5)}) == 5
    assert sum(r.n for r in trees.balanced_bags(rows, "y", ["id"], 2, balanced=False).collect()) == 2 * len(data())
    assert trees.balanced_bags(rows.limit(0), "y", ["id"], 2).collect() == []


def test_row_numbers_by_ranges(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.choice(["a", "b", None]), rng.randrange(50), i) for i in range(500)], "g string, o int, id int").repartition(6)
    for limits in ({}, {"window_rows": 10, "range_rows": 40}):
        got = row_numbers(df, ["g"], ["o"], **limits).collect()
        for g in ("a", "b", None):
            own = sorted((r.place, r.o) for r in got if r.g == g)
            assert [p for p, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)


def test_stages_fit_score_and_reload(spark, rows, tmp_path):
    table = rows.select("y", *(F.coalesce(F.get("x", F.lit(k)), F.lit(float("nan"))).alias(f"f{k}") for k in range(3)))
    assembler = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features", handleInvalid="keep")
    for kind, params in (
        (tuning.BALANCED_FOREST, {"n_estimators": 6, "max_depth": 4, "max_features": None}),
        (tuning.FOREST, {"n_estimators": 6, "min_samples_split": 20}),
        (tuning.SECOND_ORDER, {"n_estimators": 5, "max_depth": 3}),
    ):
        model = Pipeline(stages=[assembler, tuning.make_estimator(Candidate("m", kind, params), label="y")]).fit(table)
        scored = model.transform(table)
        right = scored.filter("prediction = y").count()
        assert right > 0.8 * 200, kind
        model.write().overwrite().save(str(tmp_path / kind))
        loaded = PipelineModel.load(str(tmp_path / kind)).transform(table)
        digest = F.sum(F.xxhash64("prediction", F.col("probability").cast("string")).cast("decimal(38,0)"))
        assert loaded.agg(digest).first() == scored.agg(digest).first()


def test_features_of_a_node_are_drawn(rows):
    y = F.col("y").cast("double")
    made = grown(rows, trees.gini(5, features=1), y, 1 - y)
    free = grown(rows, trees.gini(5), y, 1 - y)
    assert len(set(made.feature)) > 1 and made != free


def test_no_rows_and_depth(rows):
    y = F.col("y").cast("double")
    assert grown(rows.limit(0), trees.gini(3), y, 1 - y).left == [-1]
    with pytest.raises(ValueError, match="depth"):
        grown(rows, trees.gini(31), y, 1 - y)
