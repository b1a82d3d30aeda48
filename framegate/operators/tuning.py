"""Candidate models, leak-free cross-validation, search and the choice of model and threshold."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegate.config import Candidate, SmoteConfig
from framegate.functions.nulls import col
from framegate.functions.scores import LABEL_METRICS, SCORE_METRICS, check_metric
from framegate.operators import fold_fits
from framegate.operators.evaluation import best_candidate, best_threshold, binary_measures, confusion_counts, ranking_measures, threshold_sweep
from framegate.operators.importance import tree_depth
from framegate.operators.preparation import FittedTransforms, fit_transforms
from framegate.operators.resampling import balancing_weights, synthetic_rows
from framegate.operators.trees import BaggedForest, SecondOrderBoosting
from framegate.session import checkpoint, saved, workspace

FOREST, BALANCED_FOREST, BOOSTING, SECOND_ORDER = "random_forest", "balanced_random_forest", "gradient_boosting", "second_order_boosting"

# Search space per kind of model.
FOREST_SPACE = {
    "n_estimators": tuple(range(100, 1001, 100)),
    "max_depth": (5, 10, 15, None),
    "min_samples_leaf": tuple(range(1, 11)),
    "max_features": ("sqrt", "log2", None),
}
BOOSTING_SPACE = {
    "n_estimators": tuple(range(100, 501, 100)),
    "max_depth": tuple(range(3, 11)),
    "learning_rate": (0.01, 1.0),
}
SEARCH_SPACE = {FOREST: FOREST_SPACE, BALANCED_FOREST: FOREST_SPACE, BOOSTING: BOOSTING_SPACE, SECOND_ORDER: BOOSTING_SPACE}
LOG_UNIFORM = ("learning_rate",)

# What an estimator takes; `n_jobs` and the like say nothing about the model.
_ANY = {"n_estimators", "max_depth", "random_state", "n_jobs", "verbosity"}
_TREES = _ANY | {"min_samples_leaf", "min_samples_split", "max_features"}
_BOOSTING = _ANY | {"learning_rate", "subsample", "colsample_bytree"}
PARAMETERS = {
    FOREST: _TREES,
    BALANCED_FOREST: _TREES,
    BOOSTING: _BOOSTING,
    SECOND_ORDER: _BOOSTING | {"reg_lambda", "gamma", "min_child_weight"},
}


def make_estimator(candidate: Candidate, seed: int = 42, label: str = "label", features: str = "features"):
    """The Spark ML stage of a candidate; unlimited depth becomes Spark's deepest tree.

    The balanced forest, second-order boosting and a forest with `min_samples_split` are this library's own (`trees`),
    the others Spark's.
    """
    p = dict(candidate.params)
    unknown = set(p) - PARAMETERS.get(candidate.kind, set(p))
    if unknown:
        raise ValueError(f"Parameters that {candidate.kind} doesn't have: {sorted(unknown)}")
    depth = tree_depth(p.get("max_depth") or {BOOSTING: 5, SECOND_ORDER: 6}.get(candidate.kind))
    common = {"featuresCol": features, "labelCol": label, "seed": int(p.get("random_state", seed)), "maxDepth": depth}
    if candidate.kind == BALANCED_FOREST or (candidate.kind == FOREST and "min_samples_split" in p):
        return BaggedForest(
            numTrees=int(p.get("n_estimators", 100)),
            minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
            minSplit=int(p.get("min_samples_split", 2)),
            featureSubset=str(p.get("max_features", "sqrt") or "all"),
            balanced=candidate.kind == BALANCED_FOREST,
            **common,
        )
    if candidate.kind == FOREST:
        return RandomForestClassifier(
            numTrees=int(p.get("n_estimators", 100)),
            minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
            featureSubsetStrategy=str(p.get("max_features", "sqrt") or "all"),
            **common,
        )
    if candidate.kind == SECOND_ORDER:
        return SecondOrderBoosting(
            maxIter=int(p.get("n_estimators", 100)),
            stepSize=float(p.get("learning_rate", 0.3)),
            regLambda=float(p.get("reg_lambda", 1.0)),
            gamma=float(p.get("gamma", 0.0)),
            minChildWeight=float(p.get("min_child_weight", 1.0)),
            subsamplingRate=float(p.get("subsample", 1.0)),
            featureShare=float(p.get("colsample_bytree", 1.0)),
            **common,
        )
    if candidate.kind == BOOSTING:
        return GBTClassifier(
            maxIter=int(p.get("n_estimators", 100)),
            stepSize=float(p.get("learning_rate", 0.1)),
            subsamplingRate=float(p.get("subsample", 1.0)),
            featureSubsetStrategy=str(p.get("colsample_bytree", "all")),
            **common,
        )
    raise ValueError(f"Unknown model kind: {candidate.kind}")


@dataclass(frozen=True)
class TrainingSetup:
    """What stays the same over all candidates of one selection."""

    label: str
    features: tuple[str, ...]
    keys: tuple[str, ...]
    plan: Mapping[str, str] = field(default_factory=dict)
    scaler: str = "standard"
    smote: SmoteConfig = SmoteConfig()
    seed: int = 42
    # Folds fitted side by side.
    parallelism: int = 4


def _kept(df: DataFrame, folder: str | None) -> DataFrame:
    """Rows that are dear to recompute: written to the folder of the run, or checkpointed where there is none."""
    return saved(df, folder) if folder else checkpoint(df)


def _fit_rows(train: DataFrame, setup: TrainingSetup, fitted: FittedTransforms, folder: str | None = None) -> DataFrame:
    """Transformed, rebalanced and assembled training rows with a class-balancing weight.

    Transforms are projections of the table; only the synthetic rows are written.
    """
    shaped, columns = fitted.apply(train), fitted.columns()
    made = synthetic_rows(shaped, setup.label, columns, setup.keys, setup.smote, setup.seed)
    rows = shaped.select(*[col(c).cast("double").alias(c) for c in columns], col(setup.label).cast("int").alias(setup.label))
    if made is not None:
        rows = rows.unionByName(_kept(made.drop("synthetic"), folder))
    rows = balancing_weights(rows.withColumn(setup.label, col(setup.label).cast("double")), setup.label)
    assembled = VectorAssembler(inputCols=fitted.columns(), outputCol="features").transform(rows)
    return assembled.select("features", col(setup.label), "weight")


@dataclass(frozen=True)
class PreparedFold:
    """Training rows (rebalanced) and held-out rows of one fold, ready for any candidate."""

    fold: int
    train: DataFrame
    held: DataFrame


def _folded_rows(folded: DataFrame, setup: TrainingSetup, fold: str = "fold", folder: str | None = None) -> DataFrame:
    """What folds and models read of the table, written once (see `_kept`): every fit scans its rows many times over, and
    where features come of texts and joins each scan would work them out again."""
    named = dict.fromkeys([*setup.keys, *setup.features, *setup.plan, setup.label, fold])
    return _kept(folded.select(*[col(c) for c in named]), folder)


def prepare_folds(folded: DataFrame, setup: TrainingSetup, fold: str = "fold", folder: str | None = None) -> list[PreparedFold]:
    """Fit transforms and rebalance per fold, on the training rows of the fold only.

    This does not depend on the candidate, so it is done once for a whole search. Keys, features, label and
    fold are written once; training and held-out rows are projections of them. The synthetic rows are written
    too (see `_kept`), and a lost executor does not bring the neighbour search back.
    """
    return _prepared(_folded_rows(folded, setup, fold, folder), setup, fold, folder)


def _prepared(folded: DataFrame, setup: TrainingSetup, fold: str = "fold", folder: str | None = None) -> list[PreparedFold]:
    folds = sorted(r[0] for r in folded.select(fold).distinct().collect() if r[0] is not None)

    def prepare(i: int) -> PreparedFold:
        train, held = folded.filter(col(fold) != i), folded.filter(col(fold) == i)
        fitted = fit_transforms(train, setup.features, setup.plan or None, setup.scaler)
        assembled = VectorAssembler(inputCols=fitted.columns(), outputCol="features").transform(fitted.apply(held))
        rows = assembled.select("features", col(setup.label).cast("double").alias(setup.label))
        return PreparedFold(i, _fit_rows(train, setup, fitted, folder), rows)

    return _in_threads(prepare, folds, setup.parallelism)


def _in_threads(step, items, parallelism: int) -> list:
    """Independent Spark jobs side by side, which fills a cluster when single jobs are small."""
    if parallelism <= 1 or len(items) <= 1:
        return [step(i) for i in items]
    step = inheritable_thread_target(SparkSession.getActiveSession())(step)
    with ThreadPoolExecutor(min(parallelism, len(items))) as pool:
        return list(pool.map(step, items))


def fold_predictions(prepared: Sequence[PreparedFold], setup: TrainingSetup, candidate: Candidate) -> DataFrame:
    """(fold, label, score, prediction) of every row, predicted by a model that never saw its fold."""

    def predict(p: PreparedFold) -> DataFrame:
        scored = make_estimator(candidate, setup.seed, setup.label).fit(p.train).transform(p.held)
        return scored.select(
            F.lit(p.fold).alias("fold"),
            col(setup.label).cast("int").alias("label"),
            vector_to_array("probability")[1].alias("score"),
            F.col("prediction").cast("int").alias("prediction"),
        )

    return reduce(DataFrame.unionByName, _in_threads(predict, prepared, setup.parallelism))


def task_trial(candidate: Candidate, setup: TrainingSetup) -> dict[str, object] | None:
    """What `fold_fits` needs to fit the candidate in one task; None for models that only Spark's jobs fit."""
    model = make_estimator(candidate, setup.seed, setup.label)
    get = lambda name: model.getOrDefault(model.getParam(name))
    if isinstance(model, RandomForestClassifier):
        return {
            "kind": fold_fits.FOREST, "trees": get("numTrees"), "depth": get("maxDepth"), "min_leaf": get("minInstancesPerNode"),
            "features": get("featureSubsetStrategy"), "seed": get("seed"),
        }
    if candidate.kind == BALANCED_FOREST:
        return {
            "kind": fold_fits.BALANCED, "trees": get("numTrees"), "depth": get("maxDepth"), "min_leaf": get("minInstancesPerNode"),
            "min_split": get("minSplit"), "features": get("featureSubset"), "seed": get("seed"),
        }
    if candidate.kind != BOOSTING:
        return None
    sampled = get("subsamplingRate") < 1 or get("featureSubsetStrategy") != "all"
    return None if sampled else {"kind": fold_fits.BOOSTING, "trees": get("maxIter"), "depth": get("maxDepth"), "rate": get("stepSize")}


def pack_folds(prepared: Sequence[PreparedFold], setup: TrainingSetup, candidates: Sequence[Candidate], folder: str | None = None) -> DataFrame | None:
    """The folds as bytes, written once, where a candidate can be fitted by one task and every fold is small enough for it."""
    if all(task_trial(c, setup) is None for c in candidates):
        return None
    rows = fold_fits.packed([(p.fold, p.train, p.held) for p in prepared], setup.label)
    return None if rows is None else _kept(rows, folder)


def trial_results(
    prepared: Sequence[PreparedFold],
    setup: TrainingSetup,
    candidates: Sequence[Candidate],
    metrics: Sequence[str],
    variant: str = "baseline",
    folder: str | None = None,
    folds: DataFrame | None = None,
) -> list[CvResult]:
    """Cross-validation of many candidates of one kind, side by side: all in one job where `folds` (see `pack_folds`) is given
    and a task can fit them, else each by Spark's jobs with its folds one after the other."""
    asked = [task_trial(c, setup) for c in candidates]
    if folds is None or None in asked:
        alone = replace(setup, parallelism=1) if len(candidates) > 1 else setup
        return _in_threads(lambda c: cross_validate(prepared, alone, c, metrics, variant, folder), candidates, setup.parallelism)
    predicted = _kept(fold_fits.predictions(folds, asked), folder)

    def scored(k: int) -> CvResult:
        own = predicted.filter(F.col("trial") == k).drop("trial")
        scores = fold_scores(own, metrics)
        return CvResult(candidates[k], variant, scores, mean_scores(scores), own)

    return _in_threads(scored, range(len(candidates)), setup.parallelism)


def fold_scores(predictions: DataFrame, metrics: Sequence[str]) -> dict[str, list[float | None]]:
    """Metric to its value per fold; ranking metrics use scores, the others hard predictions."""
    for m in metrics:
        check_metric(m, LABEL_METRICS + SCORE_METRICS)
    table = binary_measures(confusion_counts(predictions, "label", "prediction", by=["fold"]), ["fold"]).collect()
    by_fold = {r["fold"]: r.asDict() for r in table}
    if set(metrics) & set(SCORE_METRICS):
        for i in by_fold:
            ranked = ranking_measures(predictions.filter(F.col("fold") == i), "label", "score").first()
            by_fold[i].update(ranked.asDict())
    return {m: [by_fold[i][m] for i in sorted(by_fold)] for m in metrics}


def mean_scores(scores: Mapping[str, Sequence[float | None]]) -> dict[str, float | None]:
    present = {m: [v for v in vs if v is not None] for m, vs in scores.items()}
    return {m: sum(vs) / len(vs) if vs else None for m, vs in present.items()}


@dataclass(frozen=True)
class CvResult:
    candidate: Candidate
    variant: str
    folds: Mapping[str, Sequence[float | None]]
    means: Mapping[str, float | None]
    predictions: DataFrame | None = None


def cross_validate(
    prepared: Sequence[PreparedFold],
    setup: TrainingSetup,
    candidate: Candidate,
    metrics: Sequence[str],
    variant: str = "baseline",
    folder: str | None = None,
) -> CvResult:
    predicted = _kept(fold_predictions(prepared, setup, candidate), folder)
    scores = fold_scores(predicted, metrics)
    return CvResult(candidate, variant, scores, mean_scores(scores), predicted)


def draw_params(kind: str, rng: random.Random, space: Mapping[str, Sequence] | None = None) -> dict[str, object]:
    out: dict[str, object] = {}
    for name, values in (space or SEARCH_SPACE[kind]).items():
        if name in LOG_UNIFORM:
            low, high = values
            out[name] = low * (high / low) ** rng.random()
        else:
            out[name] = rng.choice(list(values))
    return out


def random_search(
    prepared: Sequence[PreparedFold],
    setup: TrainingSetup,
    candidate: Candidate,
    metrics: Sequence[str],
    primary: str,
    trials: int = 25,
    space: Mapping[str, Sequence] | None = None,
    folder: str | None = None,
    folds: DataFrame | None = None,
) -> CvResult:
    """Seeded random search that maximises the mean primary metric; the first best trial wins.

    `folds` are those of `prepared` as bytes, where the caller has packed them already.
    """
    if candidate.kind not in SEARCH_SPACE:
        raise ValueError(f"Unknown model kind: {candidate.kind}")
    rng = random.Random(setup.seed)
    drawn = [{**candidate.params, **(draw_params(candidate.kind, rng, space) if trials else {})} for _ in range(max(1, trials))]
    tried = [replace(candidate, params=p) for p in drawn]
    if folds is None:
        folds = pack_folds(prepared, setup, tried, folder)
    best: CvResult | None = None
    for result in trial_results(prepared, setup, tried, metrics, "search", folder, folds):
        if best is None or (result.means[primary] or 0.0) > (best.means[primary] or 0.0):
            best = result
    return best


@dataclass(frozen=True)
class Selection:
    best: CvResult
    threshold: float
    threshold_score: float
    results: tuple[CvResult, ...]


def select_model(
    folded: DataFrame,
    setup: TrainingSetup,
    candidates: Sequence[Candidate],
    metrics: Sequence[str],
    primary: str,
    threshold_metric: str = "f1",
    trials: int = 0,
    space: Mapping[str, Mapping[str, Sequence]] | None = None,
) -> Selection:
    """Cross-validate every candidate plain and searched, keep the first best, tune its threshold.

    The threshold comes from the pooled out-of-fold scores of the chosen candidate. `trials` of 0 searches nothing.
    """
    metrics = list(dict.fromkeys([primary, *metrics]))
    with workspace(folded.sparkSession, "selection") as folder:
        prepared = prepare_folds(folded, setup, folder=folder)
        folds = pack_folds(prepared, setup, candidates, folder)
        results: list[CvResult] = []
        for c in candidates:
            results += trial_results(prepared, setup, [c], metrics, folder=folder, folds=folds)
            if trials:
                own = (space or {}).get(c.kind)
                results.append(random_search(prepared, setup, c, metrics, primary, trials, own, folder, folds))
        best = first_best(results, primary)
        found = best_threshold(threshold_sweep(best.predictions, "label", "score"), threshold_metric).first()
    # The predictions have gone with the folder.
    done = {id(r): replace(r, predictions=None) for r in results}
    return Selection(done[id(best)], found["threshold"], found["score"], tuple(done.values()))


def first_best(results: Sequence[CvResult], primary: str) -> CvResult:
    """The result with the highest mean, by the rule of `evaluation.best_candidate`."""
    rows = [(i, r.candidate.name, r.variant, r.means[primary]) for i, r in enumerate(results)]
    scores = SparkSession.getActiveSession().createDataFrame(rows, "position int, name string, variant string, score double")
    best = best_candidate(scores).first()
    if best is None:
        raise ValueError(f"No candidate has a value for {primary}")
    return results[best["position"]]


def train_final(
    train: DataFrame, setup: TrainingSetup, candidate: Candidate, rebalance: bool = False
) -> PipelineModel:
    """Refit on all training rows, without synthetic rows unless asked for.

    The result holds the transforms as a SQL stage, so it scores raw columns and can be saved.
    """
    fitted = fit_transforms(train, setup.features, setup.plan or None, setup.scaler)
    plain = replace(setup, smote=replace(setup.smote, enabled=rebalance and setup.smote.enabled))
    model = make_estimator(candidate, setup.seed, setup.label).fit(_fit_rows(train, plain, fitted))
    assembler = VectorAssembler(inputCols=fitted.columns(), outputCol="features", handleInvalid="keep")
    return PipelineModel(stages=[SQLTransformer(statement=fitted.statement()), assembler, model])


def nested_grid_search(
    folded: DataFrame, features: Sequence[str], label: str, candidate: Candidate, grid: Mapping[str, Sequence],
    inner_folds: int = 3, seed: int = 42,
) -> DataFrame:
    """(fold, label, prediction): for each outer fold a grid search on the other folds, by F1 of class 1."""
    names = {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"}
    if candidate.kind in (BOOSTING, SECOND_ORDER):
        names = {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize"}
    unknown = [g for g in grid if g not in names]
    if unknown:
        raise ValueError(f"Unknown grid parameters for {candidate.kind}: {unknown}")
    # Written once: each point of each grid scans its rows many times over.
    kept = checkpoint(folded.select(*[col(c) for c in dict.fromkeys([*features, label, "fold"])]))
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(
        kept.withColumn(label, col(label).cast("double"))
    )
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    parts = []
    for i in sorted(r[0] for r in kept.select("fold").distinct().collect() if r[0] is not None):
        estimator = make_estimator(candidate, seed, label)
        builder = ParamGridBuilder()
        for g, values in grid.items():
            builder = builder.addGrid(estimator.getParam(names[g]), list(values))
        search = CrossValidator(
            estimator=estimator, estimatorParamMaps=builder.build(), evaluator=f1, numFolds=inner_folds, seed=seed, parallelism=2
        )
        model = search.fit(assembled.filter(F.col("fold") != i))
        scored = model.transform(assembled.filter(F.col("fold") == i))
        parts.append(scored.select(F.lit(i).alias("fold"), col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")))
    return reduce(DataFrame.unionByName, parts)


def search_then_refit(
    folded: DataFrame, setup: TrainingSetup, candidate: Candidate, metrics: Sequence[str], primary: str, trials: int = 10,
    space: Mapping[str, Sequence] | None = None,
) -> tuple[CvResult, PipelineModel]:
    """Search, cross-validate the best parameters, refit on all rows."""
    metrics = list(dict.fromkeys([primary, *metrics]))
    with workspace(folded.sparkSession, "search") as folder:
        rows = _folded_rows(folded, setup, folder=folder)
        best = random_search(_prepared(rows, setup, folder=folder), setup, candidate, metrics, primary, trials, space, folder)
        return replace(best, predictions=None), train_final(rows, setup, best.candidate)
