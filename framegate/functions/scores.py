"""Classification measures as column arithmetic over true/false positive/negative counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framegate.functions.nulls import ratio

# Weights of the mixed threshold measure.
MIXED_WEIGHTS = {"f1": 0.4, "recall": 0.4, "precision": 0.2}

THRESHOLD_METRICS = ("f1", "recall", "precision", "balanced_accuracy", "balanced")
LABEL_METRICS = ("f1", "recall", "precision", "accuracy", "balanced_accuracy")
SCORE_METRICS = ("roc_auc", "average_precision")


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(tp * 2, tp * 2 + fp + fn)


def accuracy(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    return ratio(tp + tn, tp + fp + fn + tn)


def balanced_accuracy(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Mean recall over the classes that occur."""
    positive = F.try_divide(tp.cast("double"), (tp + fn).cast("double"))
    negative = F.try_divide(tn.cast("double"), (tn + fp).cast("double"))
    return F.when(positive.isNull(), negative).when(negative.isNull(), positive).otherwise((positive + negative) / 2)


def label_measures(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    by_name = {
        "f1": f1(tp, fp, fn),
        "recall": recall(tp, fn),
        "precision": precision(tp, fp),
        "accuracy": accuracy(tp, fp, fn, tn),
        "balanced_accuracy": balanced_accuracy(tp, fp, fn, tn),
    }
    by_name["balanced"] = sum((by_name[m] * F.lit(w) for m, w in MIXED_WEIGHTS.items()), F.lit(0.0))
    return by_name


def check_metric(name: str, allowed: tuple[str, ...]) -> None:
    if name not in allowed:
        raise ValueError(f"Unsupported metric: {name}. Use one of: {', '.join(allowed)}.")
