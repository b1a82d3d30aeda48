"""Exploratory tables: the numbers behind the usual charts, and univariate scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegate.config import SkewConfig
from framegate.functions.hashing import row_hash
from framegate.functions.longform import MAX_AGGREGATES, melt, rows_from, summarise, text
from framegate.functions.nulls import clean_value, col, double_value, numeric_columns, ratio
from framegate.functions.quantiles import column_extent, exact_quantiles
from framegate.functions.special import f_tail
from framegate.operators.drift import bin_of, with_edges

HISTOGRAM_BINS = 20


# -- distributions --------------------------------------------------------------------------


def histograms(df: DataFrame, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(feature, bin, low, high, n) for the given columns, or for all numeric ones."""
    columns = list(columns or numeric_columns(df))
    plan = _bin_plan(df, columns, bins)
    cells = {c: bin_of(double_value(df, c), lo, hi, n) for c, (lo, hi, n) in plan.items()}
    counts = melt(df, cells).filter("value is not null").groupBy("feature", F.col("value").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return with_edges(counts, plan)


def class_histograms(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """(feature, label, bin, low, high, n, density): per-class histograms on shared bins.

    Densities of one class and feature add up to 1.
    """
    columns = list(columns or numeric_columns(df, [target]))
    plan = _bin_plan(df, columns, bins)
    cells = {c: bin_of(double_value(df, c), lo, hi, n) for c, (lo, hi, n) in plan.items()}
    counts = (
        melt(df, cells, ids={"label": col(target)})
        .filter("value is not null and label is not null")
        .groupBy("feature", "label", F.col("value").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most `bins` rows per window.
    total = F.sum("n").over(Window.partitionBy("feature", "label"))
    return with_edges(counts, plan).withColumn("density", F.col("n") / total)


def _bin_plan(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, tuple[float, float, int]]:
    return {c: (e.low, e.high, bins) for c, e in column_extent(df, columns).items() if e.rows}


# -- skewness -------------------------------------------------------------------------------


def skew_class(skew: Column, zero_ratio: Column, cfg: SkewConfig) -> tuple[Column, Column]:
    """Category and suggested transform. Strong right skew without zeros counts as moderate."""
    # The names of categories and suggestions.
    strong_right, strong_left = skew >= cfg.high, skew <= -cfg.high
    inflated = (zero_ratio >= cfg.zero_ratio) & (strong_right | strong_left)
    category = (
        F.when(skew.isNull(), F.lit("constant_or_empty"))
        .when(inflated, F.lit("zero_inflated_high_skew"))
        .when(strong_right & (zero_ratio > 0), F.lit("high_pos_zero_skew"))
        .when(strong_left, F.lit("high_neg_skew"))
        .when(F.abs(skew) >= cfg.moderate, F.lit("moderate_skew"))
        .otherwise(F.lit("low_skew"))
    )
    suggestion = (
        F.when(category == "constant_or_empty", F.lit("drop_or_ignore"))
        .when(category.isin("zero_inflated_high_skew", "high_pos_zero_skew"), F.lit("log1p"))
        .when(category == "low_skew", F.lit("none"))
        .otherwise(F.lit("yeo_johnson"))
    )
    return category, suggestion


def skew_report(df: DataFrame, columns: Sequence[str] | None = None, cfg: SkewConfig = SkewConfig()) -> DataFrame:
    """(feature, skewness, zero_ratio, category, suggestion) from one scan; population skewness."""
    columns = list(columns or numeric_columns(df))
    raw = summarise(
        df,
        columns,
        {
            "low": lambda c: F.min(double_value(df, c)),
            "high": lambda c: F.max(double_value(df, c)),
            "skew": lambda c: F.skewness(double_value(df, c)),
            "zeros": lambda c: F.count_if(double_value(df, c) == 0),
            "rows": lambda c: F.count(F.lit(1)),
        },
    )
    varies = F.col("low") < F.col("high")
    measured = raw.select(
        "feature",
        F.when(varies, F.col("skew")).alias("skewness"),
        F.when(varies, F.col("zeros") / F.col("rows")).alias("zero_ratio"),
    )
    category, suggestion = skew_class(F.col("skewness"), F.col("zero_ratio"), cfg)
    return measured.select(
        "feature", "skewness", "zero_ratio", category.alias("category"), suggestion.alias("suggestion")
    ).orderBy("category", "feature")


# -- univariate scores ----------------------------------------------------------------------


def anova_scores(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, f_score, p_value): one-way ANOVA of every feature over the label classes, best first.

    One aggregation per class gives count, mean and variance, from which the score follows; the
    p-value is worked out on the driver for the few resulting rows. A feature that is constant
    within every class scores infinity, one that is constant overall has no score.
    """
    columns = list(columns or numeric_columns(df, [target]))
    per_class = _class_moments(df, target, columns)
    # One row per class and feature from here on.
    grand = F.sum(F.col("n") * F.col("mean")).over(Window.partitionBy("feature")) / F.sum("n").over(Window.partitionBy("feature"))
    between = per_class.withColumn("grand", grand).groupBy("feature").agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 0).alias("classes"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"),
    )
    d1, d2 = F.col("classes") - 1, F.col("rows") - F.col("classes")
    scored = between.select(
        "feature",
        F.when(F.col("within") > 0, F.try_divide(F.col("between") / d1, F.col("within") / d2))
        .when(F.col("between") > 0, F.lit(float("inf")))
        .alias("f_score"),
        d1.cast("double").alias("d1"),
        d2.cast("double").alias("d2"),
    )
    rows = [
        (r["feature"], r["f_score"], None if r["f_score"] is None else f_tail(r["f_score"], r["d1"], r["d2"]))
        for r in scored.collect()
    ]
    table = df.sparkSession.createDataFrame(rows, "feature string, f_score double, p_value double")
    return table.orderBy(F.desc_nulls_last("f_score"), "feature")


def _class_moments(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """(feature, n, mean, var) per label class and feature."""
    wide = (
        df.filter(col(target).isNotNull())
        .groupBy(col(target).cast("int").alias("label"))
        .agg(
            *[
                x
                for i, c in enumerate(columns)
                for x in (
                    F.count(double_value(df, c)).alias(f"n{i}"),
                    F.avg(double_value(df, c)).alias(f"mean{i}"),
                    F.var_pop(double_value(df, c)).alias(f"var{i}"),
                )
            ]
        )
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"n{i}").alias("n"),
            F.coalesce(F.col(f"mean{i}"), F.lit(0.0)).alias("mean"),
            F.coalesce(F.col(f"var{i}"), F.lit(0.0)).alias("var"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def top_features(scores: DataFrame, k: int = 10, by: str = "f_score") -> DataFrame:
    return scores.orderBy(F.desc_nulls_last(by), "feature").limit(k)


def binned_mutual_information(
    df: DataFrame,
    target: str,
    columns: Sequence[str] | None = None,
    bins: int = 10,
    cuts: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """(feature, score): mutual information of quantile-binned features with the label, in nats, best first.

    A value's bin is the number of distinct cut points at or below it. Cut points default to the
    exact quantiles of the non-missing values; rows where the feature is missing do not count.
    This is a counting estimate of the same quantity that neighbour-based estimators target.
    """
    columns = list(columns or numeric_columns(df, [target]))
    if cuts is None:
        probs = [k / bins for k in range(1, bins)]
        cuts = {c: [q for q in qs if q is not None] for c, qs in exact_quantiles(df, columns, probs).items()}
    cell = _bin_counts(df, target, {c: sorted(set(cuts[c])) for c in columns})
    # Contingency counts: a window holds the classes of a bin, the bins of a class, or both.
    over = lambda *keys: F.sum("n").over(Window.partitionBy("feature", *keys))
    joined = cell.select(
        "feature", "n", over("value").alias("n_bin"), over("y").alias("n_class"), over().alias("n_all")
    )
    term = F.col("n") / F.col("n_all") * F.ln(F.col("n") * F.col("n_all") / (F.col("n_bin") * F.col("n_class")))
    scores = joined.groupBy("feature").agg(F.greatest(F.sum(term), F.lit(0.0)).alias("score"))
    return scores.orderBy(F.desc("score"), "feature")


def _bin_counts(df: DataFrame, target: str, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, value, y, n) of the bins and classes that occur; `value` is the number of cuts reached.

    A row of a class counts how many values reach each cut, for all features in one scan, and a bin is a difference of two
    such counts. Rows are not taken apart into one for each feature.
    """
    labelled = df.filter(col(target).isNotNull())
    parts: list[list[str]] = [[]]
    room = MAX_AGGREGATES
    for c, marks in cuts.items():
        if len(marks) + 1 > room and parts[-1]:
            parts.append([])
            room = MAX_AGGREGATES
        parts[-1].append(c)
        room -= len(marks) + 1
    return reduce(DataFrame.unionByName, [_bin_counts_once(labelled, target, {c: cuts[c] for c in part}) for part in parts])


def _bin_counts_once(labelled: DataFrame, target: str, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    reached, rows = [], []
    for i, (c, marks) in enumerate(cuts.items()):
        v = double_value(labelled, c)
        reached.append(F.count(v).alias(f"r{i}_0"))
        reached += [F.count_if(v >= F.lit(float(m))).alias(f"r{i}_{j}") for j, m in enumerate(marks, 1)]
        for j in range(len(marks) + 1):
            n = f"r{i}_{j} - r{i}_{j + 1}" if j < len(marks) else f"r{i}_{j}"
            rows.append({"feature": text(c), "value": str(j), "y": "y", "n": n})
    return rows_from(labelled.groupBy(col(target).alias("y")).agg(*reached), rows).filter("n > 0")


# -- missingness ----------------------------------------------------------------------------


def missing_matrix(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], rows: int | None = 300, seed: int = 42, portable: bool = False
) -> DataFrame:
    """0/1 missing flags of the columns that miss anything, for a fixed pseudo-random sample of rows or for all (`rows=None`).

    The sample is the rows with the smallest key hash, taken by a distributed top-k, so it is the
    same on every run.
    """
    counts = summarise(df, columns, {"share": lambda c: ratio(F.count_if(clean_value(df, c).isNull()), F.count(F.lit(1)))})
    some = [r["feature"] for r in counts.filter("share > 0").orderBy(F.desc("share"), "feature").collect()]
    flags = [clean_value(df, c).isNull().cast("int").alias(f"{c}_missing") for c in some]
    chosen = df if rows is None else df.orderBy(row_hash(keys, seed, portable), *[col(k) for k in keys]).limit(rows)
    return chosen.select(*[col(k) for k in keys], *flags)

