"""Trees that grow level by level from grouped histograms: forests on balanced bags, and second-order boosting.

Features are cut into bins once. A level of all trees is one aggregation over the rows, to two sums and a weight for each
(tree, node, feature, bin); running totals of these cells give every split, and one row for each open node reaches the
driver. A model is a few arrays for each tree, which scoring reads as a constant: rows never leave the JVM.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegate.functions.cumulative import row_numbers
from framegate.functions.hashing import row_hash
from framegate.functions.quantiles import exact_quantiles
from framegate.session import checkpoint

TREES = "array<struct<feature:array<int>,bin:array<int>,cut:array<double>,missing_left:array<boolean>,left:array<int>,open:array<boolean>,value:array<double>>>"

#: Trees of a boosted model after which the rows are written with their margins.
WRITE_EVERY = 10
MOST_DEPTH = 30


# Model ----------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as columns, the root first. A split sends values of `cut` and more to the node after `left`; a leaf has left -1."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [0])
    cut: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    open: list[bool] = field(default_factory=lambda: [True])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, bin_: int, cut: float, missing_left: bool, values: Sequence[float], opens: Sequence[bool]) -> None:
        self.feature[node], self.bin[node], self.cut[node], self.missing_left[node] = feature, bin_, cut, missing_left
        self.left[node], self.open[node] = len(self.left), False
        for value, open_ in zip(values, opens):
            for column, x in ((self.feature, 0), (self.bin, 0), (self.cut, 0.0), (self.missing_left, False), (self.left, -1), (self.open, open_), (self.value, value)):
                column.append(x)

    def paths(self) -> dict[int, str]:
        """For each leaf the turns from the root, L and R."""
        found, todo = {}, [(0, "")]
        while todo:
            node, path = todo.pop()
            if self.left[node] < 0:
                found[node] = path
            else:
                todo += [(self.left[node], path + "L"), (self.left[node] + 1, path + "R")]
        return found

    def columns(self) -> dict[str, list]:
        return {name: getattr(self, name) for name in ("feature", "bin", "cut", "missing_left", "left", "open", "value")}


def as_json(trees: Sequence[Tree]) -> str:
    return json.dumps([t.columns() for t in trees])


def as_column(trees: Sequence[Tree] | str) -> Column:
    """The trees as one constant, an array of a struct for each."""
    return F.from_json(F.lit(trees if isinstance(trees, str) else as_json(trees)), TREES)


def routed(tree: Column, values: Column, threshold: str, depth: int) -> Column:
    """The leaf that an array of values (bins or numbers, null where missing) falls into."""

    def step(node: Column, _: Column) -> Column:
        at = lambda name: F.get(tree[name], node)
        v = F.get(values, at("feature"))
        right = F.when(v.isNull(), ~at("missing_left")).otherwise(v >= at(threshold))
        return F.when(at("left") < 0, node).otherwise(at("left") + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), step)


def tree_values(trees: Column, values: Column, depth: int) -> Column:
    """The value of each tree for an array of numbers."""
    return F.transform(trees, lambda t: F.get(t["value"], routed(t, values, "cut", depth)))


def numbers(features: Column) -> Column:
    """A vector's numbers, null for NaN."""
    return F.transform(vector_to_array(features), lambda v: F.when(~F.isnan(v), v))


# Bins and bags --------------------------------------------------------------------------------


def cut_points(df: DataFrame, columns: Sequence[str], bins: int = 32) -> list[list[float]]:
    """For each column the distinct exact quantiles that cut its values into at most `bins` bins."""
    found = exact_quantiles(df, list(columns), [k / bins for k in range(1, bins)])
    return [sorted({q for q in found[c] if q is not None}) for c in columns]


def binned(values: Column, cuts: Sequence[Sequence[float]]) -> Column:
    """For each number of an array how many of its feature's cut points it reaches; null for a missing one."""

    def one(k: int) -> Column:
        v = F.get(values, F.lit(k))
        return F.when(v.isNotNull(), sum(((v >= F.lit(float(c))).cast("int") for c in cuts[k]), F.lit(0)))

    return F.array(*(one(k) for k in range(len(cuts))))


def balanced_bags(
    df: DataFrame, label: str, order: Sequence[str], bags: int, seed: int = 42, balanced: bool = True, portable: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """(tree, label, order…, carry…, n): how often each row is drawn into each bag, for rows drawn at least once.

    A bag is drawn with replacement: as many rows of every class as the smallest class has, or, not balanced, as many rows
    as there are. Draws are hashes of (seed, draw) and rows are numbered by `order` within their class, so bags do not
    depend on partitions. Every draw is a row that is counted before it meets the one row of its number. Rows without a
    label are in no bag. `portable` hashes with MD5, which other engines can reproduce.
    """
    rows = df.filter(F.col(f"`{label}`").isNotNull()).select(*dict.fromkeys([label, *order, *carry]))
    if not balanced:
        rows = rows.withColumn("stratum_", F.lit(0))
    else:
        rows = rows.withColumn("stratum_", F.col(f"`{label}`").cast("int"))
    sizes = {r["stratum_"]: r["count"] for r in rows.groupBy("stratum_").count().collect()}
    if not sizes:
        return df.sparkSession.createDataFrame([], rows.drop("stratum_").schema).withColumn("tree", F.lit(0)).withColumn("n", F.lit(0).cast("long"))
    many, strata = min(sizes.values()), sorted(sizes)
    placed = row_numbers(rows, ["stratum_"], list(order), "place_")
    draw = df.sparkSession.range(bags * len(strata) * many).select((F.col("id") / (len(strata) * many)).cast("long").cast("int").alias("tree"), "id")
    k = (F.col("id") / many).cast("long") % len(strata)
    own = F.get(F.array(*(F.lit(s) for s in strata)), k.cast("int"))
    size = F.get(F.array(*(F.lit(sizes[s]).cast("long") for s in strata)), k.cast("int"))
    # `portable` draws are hashed once more by their number alone
    h = row_hash(["id"], seed, portable)
    drawn = draw.select("tree", own.alias("stratum_"), F.pmod(h, size).alias("place_")).groupBy("tree", "stratum_", "place_").agg(F.count(F.lit(1)).alias("n"))
    return drawn.join(placed, ["stratum_", "place_"]).drop("stratum_", "place_")


# Growth ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Growth:
    """When a node is split, and by what.

    `score` of the two sums of a set of rows is what a split adds up: gain = score(left) + score(right) - score(both).
    """

    score: Callable[[Column, Column], Column]
    value: Callable[[float, float], float]
    depth: int = 6
    #: Least weight of a leaf and of a node that is split, least second sum of a leaf, and gain that a split has to exceed.
    least_rows: float = 1.0
    least_split: float = 2.0
    least_second: float = 0.0
    least_gain: float = 0.0
    #: Features that a node may be split by, drawn by a hash; all if None.
    features: int | None = None
    seed: int = 42


def best_splits(cells: DataFrame, growth: Growth) -> DataFrame:
    """One row for each (tree, node) of cells (tree, node, feature, bin, a, b, n): its sums, and its best split if it has one.

    Equal gains go to the first feature, then the lowest cut, then to missing values on the right.
    """
    of = Window.partitionBy("tree", "node", "feature")
    upto = of.orderBy(F.col("bin").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums, missing = ("a", "b", "n"), F.col("bin").isNull()
    totals = [F.sum(c).over(of).alias(f"all_{c}") for c in sums]
    none = [F.coalesce(F.sum(F.when(missing, F.col(c))).over(of), F.lit(0.0)).alias(f"none_{c}") for c in sums]
    left = [F.when(missing, F.lit(0.0)).otherwise(F.sum(c).over(upto)).alias(f"left_{c}") for c in sums]
    rank = F.dense_rank().over(Window.partitionBy("tree", "node").orderBy(F.xxhash64(F.lit(growth.seed), "tree", "node", "feature"), "feature"))
    # a known bin goes left with all below it; the cell of missing values stands for missing on the left, all others on the right
    lined = cells.select(
        "tree", "node", "feature", F.coalesce("bin", F.lit(-1)).alias("bin"), *totals, *none, *left, rank.alias("draw"), F.max("bin").over(of).alias("last")
    )
    start = F.col("bin") < 0
    both = F.when(start, F.array(F.lit(True))).when(F.col("none_n") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    tried = lined.withColumn("missing_left", F.explode(both))
    for c in sums:
        tried = tried.withColumn(f"left_{c}", F.col(f"left_{c}") + F.when(F.col("missing_left"), F.col(f"none_{c}")).otherwise(0.0))
        tried = tried.withColumn(f"right_{c}", F.col(f"all_{c}") - F.col(f"left_{c}"))
    sides = ("left", "right")
    gain = growth.score(F.col("left_a"), F.col("left_b")) + growth.score(F.col("right_a"), F.col("right_b")) - growth.score(F.col("all_a"), F.col("all_b"))
    fit = (F.col("bin") < F.col("last")) & (F.col("all_n") >= growth.least_split)
    for s in sides:
        fit &= (F.col(f"{s}_n") >= growth.least_rows) & (F.col(f"{s}_n") > 0) & (F.col(f"{s}_b") >= growth.least_second)
    if growth.features is not None:
        fit &= F.col("draw") <= growth.features
    split = F.struct(
        gain.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), (~F.col("missing_left")).alias("right"),
        *(F.col(f"{s}_{c}") for s in sides for c in sums),
    )
    return tried.groupBy("tree", "node").agg(
        *(F.max_by(f"all_{c}", F.struct(-F.col("feature"), F.col("bin"))).alias(c) for c in sums), F.max(F.when(fit & (gain > growth.least_gain), split)).alias("split")
    )


def grow(rows: DataFrame, trees: int, cuts: Sequence[Sequence[float]], growth: Growth) -> list[Tree]:
    """`trees` trees over rows (tree, bins, a, b, n), all of a level at once."""
    if not 1 <= growth.depth <= MOST_DEPTH:
        raise ValueError(f"depth must be from 1 to {MOST_DEPTH}")
    made = [Tree() for _ in range(trees)]
    for level in range(growth.depth):
        if not any(any(t.open) for t in made):
            break
        at = rows.withColumn("t", F.get(as_column(made), F.col("tree"))).withColumn("node", routed(F.col("t"), F.col("bins"), "bin", level))
        cells = (
            at.filter(F.get(F.col("t.open"), F.col("node")))
            .select("tree", "node", "a", "b", "n", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("tree", "node", "feature", "bin")
            .agg(*(F.sum(c).alias(c) for c in ("a", "b", "n")))
        )
        for r in best_splits(cells, growth).collect():
            tree, split = made[r["tree"]], r["split"]
            tree.open[r["node"]] = False
            if not level:
                tree.value[0] = growth.value(r["a"], r["b"])
            if split is None:
                continue
            feature, bin_ = -split["feature"], -split["bin"]
            values = [growth.value(split[f"{s}_a"], split[f"{s}_b"]) for s in ("left", "right")]
            opens = [split[f"{s}_n"] >= growth.least_split and level + 1 < growth.depth for s in ("left", "right")]
            # values of the next bin and above go right; all values do where missing ones are alone on the left
            cut = cuts[feature][bin_] if bin_ >= 0 else -sys.float_info.max
            tree.split(r["node"], feature, bin_ + 1, cut, not split["right"], values, opens)
            tree.depth = level + 1
    return made


# Balanced forest ------------------------------------------------------------------------------


def gini(depth: int, **limits) -> Growth:
    """Class shares: a and b are the weights of class 1 and class 0."""
    square = lambda a, b: F.coalesce((a * a + b * b) / F.nullif(a + b, F.lit(0.0)), F.lit(0.0))
    return Growth(square, lambda a, b: a / (a + b) if a + b else 0.0, depth, least_gain=1e-9, **limits)


def fit_forest(
    df: DataFrame, label: str, values: Column, order: Sequence[str], trees: int, cuts: Sequence[Sequence[float]], growth: Growth, seed: int = 42,
    balanced: bool = True, portable: bool = False,
) -> list[Tree]:
    """A tree for each bag of `balanced_bags`; `order` tells rows apart, rows that it doesn't are interchangeable."""
    rows = df.withColumn("bins", binned(values, cuts))
    bags = balanced_bags(rows, label, order, trees, seed, balanced, portable, ["bins"])
    # rows of a bag that share bins and label share every split and leaf: one row with the number of draws stands for them
    drawn = checkpoint(bags.groupBy("tree", "bins", f"`{label}`").agg(F.sum("n").alias("n")))
    n, y = F.col("n").cast("double"), F.col(f"`{label}`").cast("double")
    return grow(drawn.select("tree", "bins", (n * y).alias("a"), (n * (1 - y)).alias("b"), n.alias("n")), trees, cuts, growth)


# Second-order boosting ------------------------------------------------------------------------


@dataclass(frozen=True)
class BoostingConfig:
    trees: int = 100
    depth: int = 6
    learning_rate: float = 0.3
    #: Added to the second sum of a leaf; what a split has to gain; least second sum of a leaf.
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    #: Share of the rows and of the features that a tree sees.
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    seed: int = 42


def second_order(cfg: BoostingConfig, **limits) -> Growth:
    """Sums of gradients and hessians: a leaf's value is -G / (H + lambda), a split gains half of what its scores add up to."""
    score = lambda g, h: F.coalesce(g * g / F.nullif(h + cfg.reg_lambda, F.lit(0.0)), F.lit(0.0))
    value = lambda g, h: -cfg.learning_rate * g / (h + cfg.reg_lambda) if h + cfg.reg_lambda else 0.0
    return Growth(score, value, cfg.depth, least_rows=0.0, least_split=0.0, least_second=cfg.min_child_weight, least_gain=2 * cfg.gamma + 1e-9, seed=cfg.seed, **limits)


def fit_boosting(df: DataFrame, label: str, values: Column, cuts: Sequence[Sequence[float]], cfg: BoostingConfig, weight: str | None = None) -> list[Tree]:
    """Trees on the logistic loss of a 0/1 label, each from the gradients that the ones before it leave. The first margin is 0.

    Rows are written with their margins every few trees, so that a lost executor costs a few trees' work at most. A split
    that gains too little isn't made (there is no pruning afterwards). Rows without a label do not count.
    """
    y = F.col(f"`{label}`").cast("double")
    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    rows = df.filter(y.isNotNull()).select(binned(values, cuts).alias("bins"), y.alias("y"), w.alias("w"), F.lit(0.0).alias("margin"))
    rows = checkpoint(rows.withColumn("row", F.monotonically_increasing_id()))
    made: list[Tree] = []
    many = max(1, round(cfg.colsample_bytree * len(cuts)))
    for k in range(cfg.trees):
        p = 1 / (1 + F.exp(-F.col("margin")))
        seen = rows if cfg.subsample >= 1 else rows.filter(F.pmod(F.xxhash64(F.lit(cfg.seed), F.lit(k), "row"), F.lit(1 << 30)) < int(cfg.subsample * (1 << 30)))
        ranked = sorted(range(len(cuts)), key=lambda f: _draw(cfg.seed, k, f))
        used = sorted(ranked[:many])
        # a feature that the tree doesn't see has a single bin
        bins = F.array(*(F.get("bins", F.lit(f)) if f in used else F.lit(0) for f in range(len(cuts))))
        sums = seen.select(F.lit(0).alias("tree"), bins.alias("bins"), ((p - F.col("y")) * F.col("w")).alias("a"), (p * (1 - p) * F.col("w")).alias("b"), F.col("w").alias("n"))
        tree = grow(sums, 1, cuts, second_order(cfg))[0]
        made.append(tree)
        at = routed(F.get(as_column([tree]), F.lit(0)), F.col("bins"), "bin", cfg.depth)
        rows = rows.withColumn("margin", F.col("margin") + F.get(F.get(as_column([tree]), F.lit(0))["value"], at))
        if (k + 1) % WRITE_EVERY == 0 and k + 1 < cfg.trees:
            rows = checkpoint(rows)
    return made


def _draw(seed: int, tree: int, feature: int) -> float:
    import random

    return random.Random(f"{seed}-{tree}-{feature}").random()


# Spark ML stages ------------------------------------------------------------------------------


class TreesModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds probability (vector of two) and prediction (1 above a half, else 0). NaN counts as missing."""

    trees = Param(Params._dummy(), "trees", "trees as JSON", typeConverter=TypeConverters.toString)
    depth = Param(Params._dummy(), "depth", "depth of the deepest tree", typeConverter=TypeConverters.toInt)
    boosted = Param(Params._dummy(), "boosted", "sum of margins, or mean of shares", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, featuresCol="features", trees="[]", depth=1, boosted=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def score(self, features: Column) -> Column:
        """The probability of class 1."""
        each = tree_values(as_column(self.getOrDefault(self.trees)), numbers(features), self.getOrDefault(self.depth))
        total = F.aggregate(each, F.lit(0.0), lambda acc, v: acc + v)
        return 1 / (1 + F.exp(-total)) if self.getOrDefault(self.boosted) else total / F.size(each)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = dataset.withColumn("score_", self.score(F.col(self.getFeaturesCol())))
        scored = scored.withColumn("probability", array_to_vector(F.array(1 - F.col("score_"), F.col("score_"))))
        return scored.withColumn("prediction", (F.col("score_") > 0.5).cast("double")).drop("score_")


class _TreesEstimator(Estimator, HasFeaturesCol, HasLabelCol, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", typeConverter=TypeConverters.toInt)

    def _prepared(self, dataset: DataFrame) -> tuple[DataFrame, list[list[float]]]:
        """Rows (x, label, …) and the cut points of each feature."""
        rows = checkpoint(dataset.withColumn("x", numbers(F.col(self.getFeaturesCol()))).drop(self.getFeaturesCol()))
        first = rows.select(F.size("x")).first()
        if first is None:
            raise ValueError("No rows to fit on")
        names = [f"f{k}" for k in range(first[0])]
        return rows, cut_points(rows.select(*(F.get("x", F.lit(k)).alias(c) for k, c in enumerate(names))), names, self.getOrDefault(self.maxBins))

    def _model(self, made: list[Tree], boosted: bool) -> TreesModel:
        return TreesModel(featuresCol=self.getFeaturesCol(), trees=as_json(made), depth=max([1, *(t.depth for t in made)]), boosted=boosted)


class BaggedForest(_TreesEstimator):
    """A forest on bags with as many rows of each class, or plain bags; a prediction is the mean of the trees' shares."""

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", typeConverter=TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a leaf", typeConverter=TypeConverters.toInt)
    minSplit = Param(Params._dummy(), "minSplit", "least rows of a node that is split", typeConverter=TypeConverters.toInt)
    featureSubset = Param(Params._dummy(), "featureSubset", "sqrt, log2 or all", typeConverter=TypeConverters.toString)
    balanced = Param(Params._dummy(), "balanced", "as many rows of each class", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", seed=42, maxDepth=MOST_DEPTH, maxBins=32, numTrees=100, minInstancesPerNode=1, minSplit=2,
        featureSubset="sqrt", balanced=True,
    ):
        super().__init__()
        own = dict(seed=42, maxDepth=MOST_DEPTH, maxBins=32, numTrees=100, minInstancesPerNode=1, minSplit=2, featureSubset="sqrt", balanced=True)
        self._set(**{**own, **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> TreesModel:
        get = lambda name: self.getOrDefault(getattr(self, name))
        rows, cuts = self._prepared(dataset)
        many = {"sqrt": int(math.sqrt(len(cuts))), "log2": int(math.log2(len(cuts))) if cuts else 0, "all": len(cuts)}[get("featureSubset")]
        growth = gini(get("maxDepth"), least_rows=float(get("minInstancesPerNode")), least_split=float(get("minSplit")), features=max(1, many), seed=self.getSeed())
        label = self.getLabelCol()
        return self._model(fit_forest(rows.select(label, "x"), label, F.col("x"), ["x", label], get("numTrees"), cuts, growth, self.getSeed(), get("balanced")), False)


class SecondOrderBoosting(_TreesEstimator):
    """Boosted trees by gradients and hessians of the logistic loss; a prediction is the sum of the trees' margins."""

    maxIter = Param(Params._dummy(), "maxIter", "number of trees", typeConverter=TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", typeConverter=TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "added to the hessian of a leaf", typeConverter=TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "what a split has to gain", typeConverter=TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian of a leaf", typeConverter=TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows of a tree", typeConverter=TypeConverters.toFloat)
    featureShare = Param(Params._dummy(), "featureShare", "share of features of a tree", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", seed=42, maxDepth=6, maxBins=32, maxIter=100, stepSize=0.3, regLambda=1.0, gamma=0.0,
        minChildWeight=1.0, subsamplingRate=1.0, featureShare=1.0,
    ):
        super().__init__()
        own = dict(seed=42, maxDepth=6, maxBins=32, maxIter=100, stepSize=0.3, regLambda=1.0, gamma=0.0, minChildWeight=1.0, subsamplingRate=1.0, featureShare=1.0)
        self._set(**{**own, **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> TreesModel:
        get = lambda name: self.getOrDefault(getattr(self, name))
        rows, cuts = self._prepared(dataset)
        cfg = BoostingConfig(
            get("maxIter"), get("maxDepth"), get("stepSize"), get("regLambda"), get("gamma"), get("minChildWeight"), get("subsamplingRate"), get("featureShare"), self.getSeed()
        )
        return self._model(fit_boosting(rows, self.getLabelCol(), F.col("x"), cuts, cfg), True)
