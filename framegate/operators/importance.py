"""Forest importance, principal components and the feature selection chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.config import ForestSelectionConfig, SelectionConfig
from framegate.functions.longform import summarise
from framegate.functions.nulls import col, double_value, numeric_columns, require_columns
from framegate.functions.quantiles import literal_table
from framegate.operators import block_forest
from framegate.operators.correlation import prune_correlated_features
from framegate.operators.eda import binned_mutual_information

# Deepest tree Spark grows; stands for "no limit".
MAX_DEPTH = 30
# Numbers that a task of a forest holds for its rows: a feature's bin, or a tree's draws of the row.
TASK_NUMBERS = 50_000_000
# Numbers that Spark's forest may keep for all rows together (4 GB); beyond, rows are counted in blocks.
KEPT_NUMBERS = 1_000_000_000


def feature_vectors(df: DataFrame, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(features vector, extra…) with missing values read as 0."""
    filled = df.select(
        *[F.coalesce(double_value(df, c), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(columns)],
        *[col(e) for e in extra],
    )
    assembled = VectorAssembler(inputCols=[f"x{i}" for i in range(len(columns))], outputCol="features").transform(filled)
    return assembled.select("features", *[col(e) for e in extra])


def tree_depth(wanted: int | None) -> int:
    """The depth as Spark takes it; only "no limit" becomes Spark's deepest tree."""
    if wanted is None:
        return MAX_DEPTH
    if int(wanted) > MAX_DEPTH:
        raise ValueError(f"Trees of depth {wanted} are not supported, at most {MAX_DEPTH}")
    return int(wanted)


def forest_importance(
    df: DataFrame,
    target: str,
    columns: Sequence[str] | None = None,
    *,
    trees: int = 50,
    max_depth: int | None = 5,
    min_leaf: int = 1,
    seed: int = 42,
) -> dict[str, float]:
    """Impurity importance of a random forest; the values add up to 1."""
    columns = list(columns or numeric_columns(df, [target]))
    labelled = df.filter(col(target).isNotNull())
    shares = _shares_by_blocks(labelled, target, columns, trees, tree_depth(max_depth), min_leaf, seed)
    if shares is not None:
        return dict(zip(columns, shares))
    train = feature_vectors(labelled, columns, [target])
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=target,
        numTrees=trees,
        maxDepth=tree_depth(max_depth),
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    found = forest.fit(_dealt(train.withColumn(target, col(target).cast("double")), trees + len(columns))).featureImportances
    return {c: float(found[i]) for i, c in enumerate(columns)}


def _shares_by_blocks(labelled: DataFrame, target: str, columns: Sequence[str], trees: int, depth: int, min_leaf: int, seed: int) -> list[float] | None:
    """The importances by `block_forest`, where Spark's forest would keep too much; None where it is to fit the rows itself.

    That is also so for trees deeper than blocks are counted for, and for labels that it refuses.
    """
    y = col(target).cast("double")
    found = labelled.agg(F.count(F.lit(1)).alias("n"), F.max(y).alias("top"), F.bool_and((y >= 0) & (y < 100) & (y == F.floor(y))).alias("whole")).first()
    if found["n"] * (trees + len(columns)) <= KEPT_NUMBERS or depth > block_forest.MOST_DEPTH or not found["whole"]:
        return None
    names = [f"x{i}" for i in range(len(columns))]
    filled = [F.coalesce(double_value(labelled, c), F.lit(0.0)).alias(x) for x, c in zip(names, columns)]
    return block_forest.forest_shares(labelled.select(*filled, y.alias("y")), names, "y", max(2, int(found["top"]) + 1), trees, depth, min_leaf, seed)


def _dealt(train: DataFrame, numbers: int) -> DataFrame:
    """Rows dealt out evenly, as soon as they are more than one task should hold.

    A forest keeps `numbers` numbers for every row and reads them once a level. Rows of a file are few bytes, so a task that
    reads a file's part would hold far more than that.
    """
    parts = -(-train.count() * numbers // TASK_NUMBERS)
    if parts <= 1:
        return train
    parts = max(parts, train.sparkSession.sparkContext.defaultParallelism)
    return train.withColumn("row_", F.monotonically_increasing_id()).repartition(parts, "row_").drop("row_")


def importance_table(df: DataFrame, importances: Mapping[str, float]) -> DataFrame:
    table = literal_table(df, "feature", {c: {"importance": v} for c, v in importances.items()}, ["importance"])
    return table.orderBy(F.desc("importance"), "feature")


def explained_variance(df: DataFrame, columns: Sequence[str] | None = None, components: int = 10) -> DataFrame:
    """(component, explained_variance_ratio, cumulative) of unscaled inputs; empty below two columns."""
    columns = list(columns or numeric_columns(df))
    k = min(components, len(columns))
    schema = "component int, explained_variance_ratio double, cumulative double"
    if k < 2:
        return df.sparkSession.createDataFrame([], schema)
    ratios = PCA(k=k, inputCol="features", outputCol="pc").fit(feature_vectors(df, columns)).explainedVariance
    rows, total = [], 0.0
    for i, r in enumerate(ratios.toArray().tolist(), 1):
        total += r
        rows.append((i, r, total))
    return df.sparkSession.createDataFrame(rows, schema)


def _usable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Numeric columns with at least one value."""
    present = [c for c in numeric_columns(df) if c in set(columns)]
    if not present:
        raise ValueError("No numeric feature columns to select from")
    counts = {r["feature"]: r["n"] for r in summarise(df, present, {"n": lambda c: F.count(double_value(df, c))}).collect()}
    kept = [c for c in columns if counts.get(c)]
    if not kept:
        raise ValueError("No numeric feature columns to select from")
    return kept


def select_features(
    df: DataFrame, target: str, candidates: Sequence[str], cfg: SelectionConfig = SelectionConfig(), seed: int = 42
) -> tuple[DataFrame, dict[str, object]]:
    """Score filter, forest filter, correlation pruning, always-keep: the reduced table and the decisions."""
    chosen = [c for c in candidates if c in df.columns]
    report: dict[str, object] = {"candidates": list(candidates)}
    information: dict[str, float] = {}
    importance: dict[str, float] = {}
    best_first = lambda scores: sorted(scores, key=lambda c: -scores[c])
    if cfg.use_mutual_information:
        usable = _usable(df, chosen)
        table = binned_mutual_information(df, target, usable)
        found = {r["feature"]: r["score"] for r in table.collect()}
        information = {c: found.get(c, 0.0) for c in usable}
        chosen = [c for c in best_first(information) if information[c] >= cfg.mi_min_score][: cfg.mi_top_k]
        report["mutual_information"] = information
    if cfg.use_forest:
        importance = forest_importance(df, target, _usable(df, chosen), trees=200, max_depth=6, min_leaf=2, seed=seed)
        chosen = best_first(importance)[: cfg.forest_top_k]
        report["forest"] = importance
    if cfg.prune_correlated:
        scores = {c: information.get(c, 0.0) + importance.get(c, 0.0) for c in chosen}
        chosen = prune_correlated_features(df, chosen, scores, cfg.corr_threshold)
    final = sorted(set(chosen) | set(cfg.always_keep))
    require_columns(df, [*final, target])
    report["selected"] = final
    return df.select(*[col(c) for c in [*final, target]]), report


def forest_selection(
    train: DataFrame, target: str, features: Sequence[str], cfg: ForestSelectionConfig = ForestSelectionConfig(), seed: int = 42
) -> tuple[list[str], dict[str, float]]:
    """Features to train on, in their original order, and their importance on the training rows."""
    if not cfg.enabled:
        return list(features), {}
    importance = forest_importance(
        train, target, features, trees=cfg.trees, max_depth=cfg.max_depth, min_leaf=cfg.min_leaf, seed=seed
    )
    return choose_by_importance(importance, features, cfg), importance


def choose_by_importance(importance: Mapping[str, float], features: Sequence[str], cfg: ForestSelectionConfig) -> list[str]:
    """Union of the top k, those at the minimum importance and the always-kept; all of them if none is left."""
    ranked = sorted(features, key=lambda f: -importance[f])
    kept = set(ranked[: max(cfg.top_k or 0, 0)])
    if cfg.min_importance > 0:
        kept |= {f for f in features if importance[f] >= cfg.min_importance}
    kept |= set(cfg.always_keep) & set(features)
    return [f for f in features if f in kept] or list(features)
