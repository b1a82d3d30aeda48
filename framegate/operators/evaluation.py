"""Threshold sweeps, ranking measures, reports and promotion gates: all of it is counting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.config import GateConfig
from framegate.functions.cumulative import running_totals
from framegate.functions.longform import rows_from, scalar_struct
from framegate.functions.nulls import col, holds, ratio
from framegate.functions.scores import THRESHOLD_METRICS, check_metric, f1, label_measures, precision, recall

# -- confusion counts -----------------------------------------------------------------------


def confusion_aggregates(y: Column, predicted: Column) -> list[Column]:
    n = lambda p, name: F.count_if(holds(p)).alias(name)
    return [
        n((y == 1) & (predicted == 1), "tp"),
        n((y == 0) & (predicted == 1), "fp"),
        n((y == 1) & (predicted == 0), "fn"),
        n((y == 0) & (predicted == 0), "tn"),
    ]


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[col(b) for b in by]).agg(*confusion_aggregates(col(label), col(prediction)))


COUNTS = ("tp", "fp", "fn", "tn")


def binary_measures(counts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """f1, recall, precision, accuracy and balanced accuracy per row of a confusion table."""
    measures = label_measures(*[F.col(c) for c in COUNTS])
    return counts.select(*keep, *[m.alias(name) for name, m in measures.items() if name != "balanced"])


def label_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(metric, value) of hard predictions."""
    m = binary_measures(confusion_counts(df, label, prediction))
    return rows_from(m, [{"metric": F.lit(c), "value": F.col(c)} for c in m.columns])


# -- threshold sweep ------------------------------------------------------------------------


def threshold_sweep(df: DataFrame, label: str, score: str, n_thresholds: int = 101) -> DataFrame:
    """Confusion counts and measures at every threshold t = i/(n-1) for the rule score >= t.

    Each row falls into the bucket of the highest threshold its score reaches; counting the
    buckets needs one aggregation with n_thresholds groups, and reversed running totals over
    these groups give the counts at all thresholds.
    """
    step = 1.0 / (n_thresholds - 1)
    s = F.col("s")
    guess = F.floor(s * (n_thresholds - 1))
    reached = (
        F.when((guess + 1) * F.lit(step) <= s, guess + 1).when(guess * F.lit(step) > s, guess - 1).otherwise(guess)
    )
    bucket = F.greatest(F.least(reached, F.lit(n_thresholds - 1)), F.lit(-1)).cast("int")
    rows = df.select(col(score).cast("double").alias("s"), col(label).alias("y")).filter("s is not null and y in (0, 1)")
    counts = rows.groupBy(bucket.alias("i")).agg(F.sum(F.col("y")).alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    # n_thresholds + 1 rows from here on; row -1 holds scores below every threshold.
    grid = df.sparkSession.range(-1, n_thresholds).select(F.col("id").cast("int").alias("i"))
    above = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pos, neg = F.coalesce("pos", F.lit(0)), F.coalesce("neg", F.lit(0))
    swept = (
        grid.join(F.broadcast(counts), "i", "left")
        .select(
            "i",
            F.sum(pos).over(above).alias("tp"),
            F.sum(neg).over(above).alias("fp"),
            (F.sum(pos).over(everything) - F.sum(pos).over(above)).alias("fn"),
            (F.sum(neg).over(everything) - F.sum(neg).over(above)).alias("tn"),
        )
        .filter("i >= 0")
        .withColumns({c: F.col(c).cast("bigint") for c in COUNTS})
    )
    measures = label_measures(*[F.col(c) for c in COUNTS])
    return swept.select(
        (F.col("i") * F.lit(step)).alias("threshold"), *COUNTS, *[measures[m].alias(m) for m in THRESHOLD_METRICS]
    )


def best_threshold(sweep: DataFrame, metric: str = "f1") -> DataFrame:
    """One row (threshold, score): the first maximum of the metric."""
    check_metric(metric, THRESHOLD_METRICS)
    return sweep.orderBy(F.desc(metric), "threshold").limit(1).select("threshold", F.col(metric).alias("score"))


# -- ranking measures -----------------------------------------------------------------------


def ranking_measures(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row (roc_auc, average_precision) with tied scores handled as one step.

    Rows are counted per distinct score first; running counts over the sorted scores are built
    range by range. ROC-AUC is NULL when only one class occurs.
    """
    counts = score_counts(df, label, score)
    return ranking_from_counts(counts)


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    return (
        df.select(col(score).cast("double").alias("s"), col(label).alias("y"))
        .filter("s is not null and y in (0, 1)")
        .groupBy("s")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )


def ranking_from_counts(counts: DataFrame) -> DataFrame:
    """From the best score down: `_before` counts the rows with a better score."""
    ran = running_totals(counts.withColumn("from_top", -F.col("s")), "from_top", ["pos", "neg"])
    tp, fp = (F.col("pos_before") + F.col("pos")).cast("double"), (F.col("neg_before") + F.col("neg")).cast("double")
    pos = F.col("pos").cast("double")
    pairs = F.col("p").cast("double") * F.col("n").cast("double")
    return ran.agg(
        F.sum(pos * (F.col("neg_before") + F.col("neg") / 2)).alias("losses"),
        F.sum(pos * F.try_divide(tp, tp + fp)).alias("steps"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    ).select(
        (1 - F.try_divide(F.col("losses"), pairs)).alias("roc_auc"),
        ratio(F.col("steps"), F.col("p")).alias("average_precision"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_measures(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_measures(df, label, score).select("average_precision")


# -- reports --------------------------------------------------------------------------------


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, precision, recall, f1, support) per class plus accuracy, macro and weighted averages."""
    return report_from_counts(
        df.filter(col(label).isNotNull() & col(prediction).isNotNull())
        .groupBy(_class_name(df, label).alias("y"), _class_name(df, prediction).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _class_name(df: DataFrame, name: str) -> Column:
    """A class as text; a whole number reads alike whether it is stored as integer, double, decimal or boolean."""
    kind = df.select(col(name)).schema[0].dataType
    if isinstance(kind, T.BooleanType):
        return col(name).cast("int").cast("string")
    if isinstance(kind, T.FractionalType):
        x = col(name).cast("double")
        return F.when((x == F.floor(x)) & (F.abs(x) < 2**53), x.cast("bigint").cast("string")).otherwise(x.cast("string"))
    return col(name).cast("string")


def report_from_counts(cells: DataFrame) -> DataFrame:
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    )
    classes = cells.select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    fp, fn = F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp")
    scored = classes.select(
        "label",
        precision(F.col("tp"), fp).alias("precision"),
        recall(F.col("tp"), fn).alias("recall"),
        f1(F.col("tp"), fp, fn).alias("f1"),
        "support",
        "tp",
    )
    names = ["precision", "recall", "f1"]
    weighted = lambda m: F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support"))
    totals = scored.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in names],
        *[weighted(m).alias(f"weighted_{m}") for m in names],
        F.try_divide(F.sum("tp").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
        F.sum("support").alias("support"),
    )
    extra = rows_from(
        totals,
        [
            {"label": F.lit("accuracy"), **{m: F.col("accuracy") for m in names}, "support": F.col("support")},
            {"label": F.lit("macro avg"), **{m: F.col(f"macro_{m}") for m in names}, "support": F.col("support")},
            {"label": F.lit("weighted avg"), **{m: F.col(f"weighted_{m}") for m in names}, "support": F.col("support")},
        ],
    )
    return scored.drop("tp").unionByName(extra)


def fold_confusion(df: DataFrame, fold: str, label: str, prediction: str) -> DataFrame:
    """Confusion counts summed over folds, and per-class measures averaged over folds, as one row."""
    per_fold = confusion_counts(df.filter(col(fold).isNotNull()), label, prediction, by=[fold])
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    return per_fold.agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.avg(precision(tp, fp)).alias("precision_1"),
        F.avg(recall(tp, fn)).alias("recall_1"),
        F.avg(f1(tp, fp, fn)).alias("f1_1"),
        F.avg(precision(tn, fn)).alias("precision_0"),
        F.avg(recall(tn, fp)).alias("recall_0"),
        F.avg(f1(tn, fn, fp)).alias("f1_0"),
    )


def evaluate_at_thresholds(df: DataFrame, label: str, score: str, tuned: float, default: float = 0.5) -> DataFrame:
    """(variant, threshold, f1, recall, precision, accuracy, balanced_accuracy, roc_auc, average_precision).

    Hold-out evaluation at the default and the tuned threshold from one pass over the scores.
    """
    counts = score_counts(df, label, score)
    variants = [("default", float(default)), ("tuned", float(tuned))]
    at = F.inline(F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(t).alias("threshold")) for v, t in variants]))
    # The default rule is the more probable class, which a score of exactly one half does not win.
    hit = F.when(F.col("variant") == "default", F.col("s") > F.col("threshold")).otherwise(F.col("s") >= F.col("threshold"))
    confusion = counts.select("s", "pos", "neg", at).groupBy("variant", "threshold").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"),
    )
    ranking = scalar_struct(ranking_from_counts(counts))
    return binary_measures(confusion, ["variant", "threshold"]).select(
        "*", ranking["roc_auc"].alias("roc_auc"), ranking["average_precision"].alias("average_precision")
    )


# -- selection and gates --------------------------------------------------------------------


def best_candidate(scores: DataFrame, metric: str = "score") -> DataFrame:
    """One row: the highest score; the earliest `position` wins ties (rows: position, name, variant, score)."""
    return scores.filter(col(metric).isNotNull()).orderBy(F.desc(metric), "position").limit(1)


def promotion_gates(metrics: DataFrame, cfg: GateConfig = GateConfig()) -> DataFrame:
    """(check, ok, value, threshold) from a one-row table with f1, recall and optionally previous_f1."""
    rows = []
    gate = lambda name, ok, value, limit: {
        "check": F.lit(name), "ok": ok, "value": value, "threshold": F.lit(float(limit))
    }
    if cfg.min_f1 is not None:
        rows.append(gate("min_f1", F.col("f1") >= cfg.min_f1, F.col("f1"), cfg.min_f1))
    if cfg.min_recall is not None:
        rows.append(gate("min_recall", F.col("recall") >= cfg.min_recall, F.col("recall"), cfg.min_recall))
    if cfg.max_drop_vs_previous is not None and "previous_f1" in metrics.columns:
        drop = F.col("previous_f1") - F.col("f1")
        rows.append(gate("max_drop_vs_previous", drop <= cfg.max_drop_vs_previous, drop, cfg.max_drop_vs_previous))
    if not rows:
        raise ValueError("No promotion gate is configured")
    # Without a previous model its check does not apply.
    return rows_from(metrics, rows).filter("value is not null")


def gates_passed(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("passed"))


# -- decay ----------------------------------------------------------------------------------

# The names of metrics, here and in `functions.scores`, and of the promotion gates above.
DECAY_METRICS = ("f1", "precision", "recall", "accuracy")


def metric_decay(current: DataFrame, reference: Mapping[str, float], threshold: float = 0.05) -> DataFrame:
    """(metric, reference, current, drop, alert) from a (metric, value) table; alert on a drop above the limit."""
    spark = current.sparkSession
    base = spark.createDataFrame([(m, float(v)) for m, v in reference.items()], "metric string, reference double")
    drop = F.col("reference") - F.col("value")
    return (
        current.join(F.broadcast(base), "metric")
        .select("metric", "reference", F.col("value").alias("current"), drop.alias("drop"))
        .withColumn("alert", F.col("drop") > threshold)
    )
