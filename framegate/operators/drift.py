"""Comparison of two tables or of two fingerprints."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import DriftConfig
from framegate.functions.cumulative import running_totals
from framegate.functions.longform import melt
from framegate.functions.nulls import clean_value, col, double_value, numeric_columns
from framegate.functions.quantiles import column_extent
from framegate.functions.status import level

SHIFT_MEASURES = ("mean", "p50", "p99", "std")


# -- fingerprints ---------------------------------------------------------------------------


def profile_drift(current: DataFrame, baseline: DataFrame, cfg: DriftConfig = DriftConfig()) -> DataFrame:
    """(feature, relative_change, status, message) on the shared numeric columns of two profiles."""
    q = cfg.quantile
    # A profile has one row per column, so the broadcast side is bounded by the table's width.
    base = F.broadcast(baseline.select("feature", F.col(q).alias("base")))
    change = F.abs(F.col(q) - F.col("base")) / (F.abs(F.col("base")) + cfg.eps)
    return (
        current.select("feature", q)
        .join(base, "feature")
        .select("feature", change.alias("relative_change"))
        .filter("relative_change is not null")
        .withColumn("status", level(F.col("relative_change") >= cfg.warn, F.col("relative_change") >= cfg.fail))
        .withColumn("message", F.format_string(f"{q} of %s moved by %.4f", "feature", "relative_change"))
    )


def drift_state(enabled: bool, has_profile: bool, baseline_path: str | None, has_baseline: bool) -> str:
    """Which of the five outcomes a drift step has: only `compared` runs a comparison."""
    if not enabled:
        return "disabled"
    if not has_profile:
        return "skipped_no_profile"
    if not baseline_path:
        return "skipped_no_path"
    return "compared" if has_baseline else "no_baseline"


def distribution_shift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Both sides, delta and delta percent per measure on the union of columns, plus a shift score."""
    numeric = lambda p, side: p.filter("mean is not null").select(
        "feature", *[F.col(m).alias(f"{side}_{m}") for m in SHIFT_MEASURES], F.col("missing_ratio").alias(f"{side}_missing")
    )
    both = numeric(baseline, "baseline").join(numeric(current, "current"), "feature", "full_outer")
    out: list[Column] = [F.col("feature")]
    for m in SHIFT_MEASURES:
        b, c = F.col(f"baseline_{m}"), F.col(f"current_{m}")
        pct = F.when(F.abs(b) >= 1e-12, (c - b) / b * 100)
        out += [b, c, (c - b).alias(f"{m}_delta"), pct.alias(f"{m}_delta_pct")]
    missing = F.col("current_missing") - F.col("baseline_missing")
    out += [F.col("baseline_missing"), F.col("current_missing"), missing.alias("missing_delta")]
    size = lambda c: F.coalesce(F.abs(c), F.lit(0.0))
    score = size(F.col("mean_delta_pct")) + size(F.col("std_delta_pct")) + size(F.col("missing_delta")) * 100
    return both.select(*out).withColumn("shift_score", score).orderBy(F.desc("shift_score"), "feature")


def top_shifted(shift: DataFrame, k: int = 12) -> DataFrame:
    return shift.orderBy(F.desc("shift_score"), "feature").limit(k)


# -- shared-bin histograms ------------------------------------------------------------------


def shared_bins(rows: int) -> int:
    return min(40, max(10, int(math.sqrt(rows))))


def overlay_histogram(sides: Mapping[str, DataFrame], columns: Sequence[str], min_rows: int = 5) -> DataFrame:
    """(feature, side, bin, low, high, n): every side counted on one range and one number of bins.

    Columns with fewer than `min_rows` values on any side are left out.
    """
    extents = {s: column_extent(d, columns) for s, d in sides.items()}
    parts = []
    plan: dict[str, tuple[float, float, int]] = {}
    for c in columns:
        per_side = [extents[s][c] for s in sides]
        if min(e.rows for e in per_side) < min_rows:
            continue
        low, high = min(e.low for e in per_side), max(e.high for e in per_side)
        plan[c] = (low, high, shared_bins(sum(e.rows for e in per_side)))
    for side, d in sides.items():
        cells = [
            F.struct(F.lit(c).alias("feature"), bin_of(double_value(d, c), lo, hi, n).alias("bin"))
            for c, (lo, hi, n) in plan.items()
        ]
        parts.append(d.select(F.lit(side).alias("side"), F.inline(F.array(*cells))).filter("bin is not null"))
    counts = reduce(DataFrame.unionByName, parts).groupBy("feature", "side", "bin").agg(F.count(F.lit(1)).alias("n"))
    return with_edges(counts, plan)


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """0-based bin of equal width; the highest value belongs to the last bin."""
    if high <= low:
        return F.when(value.isNotNull(), F.lit(0))
    cell = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    return F.when(value.isNotNull(), F.least(cell, F.lit(bins - 1)).cast("int"))


def with_edges(counts: DataFrame, plan: Mapping[str, tuple[float, float, int]]) -> DataFrame:
    at = lambda values: F.element_at(F.create_map(*[x for c, v in values.items() for x in (F.lit(c), F.lit(v))]), F.col("feature"))
    low = at({c: lo for c, (lo, _, _) in plan.items()})
    width = at({c: (hi - lo) / n for c, (lo, hi, n) in plan.items()})
    return counts.select(
        *[c for c in counts.columns if c != "n"],
        (low + width * F.col("bin")).alias("low"),
        (low + width * (F.col("bin") + 1)).alias("high"),
        "n",
    )


# -- two-sample tests -----------------------------------------------------------------------

KS_ALPHA = 0.05
PSI_LIMIT = 0.1
DATASET_DRIFT_SHARE = 0.5


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, v, n): how often each value of the numeric columns is there, counted in one scan."""
    return (
        melt(df, {c: double_value(df, c) for c in columns})
        .filter("value is not null")
        .groupBy("feature", F.col("value").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for columns read as text; a missing value is a category of its own."""
    return (
        melt(df, {c: clean_value(df, c).cast("string") for c in columns})
        .groupBy("feature", F.col("value").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _two_sides(reference: DataFrame, current: DataFrame) -> DataFrame:
    """(feature, v, a, b) from two tables of counts."""
    side = lambda d, a, b: d.select("feature", "v", (F.col("n") * a).alias("a"), (F.col("n") * b).alias("b"))
    return (
        side(reference, 1, 0).unionByName(side(current, 0, 1)).groupBy("feature", "v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )


def ks_test(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, statistic, p_value, drifted): two-sample Kolmogorov-Smirnov per numeric column.

    Values of all columns are counted per side in one scan of each table, so copies collapse; the running
    counts over the sorted distinct values are built range by range. The p-value is the asymptotic series.
    """
    return ks_from_counts(value_counts(reference, columns), value_counts(current, columns), columns)


def ks_from_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`ks_test` on two tables of (feature, v, n), such as a reference that was counted once and saved."""
    counts = _two_sides(reference, current)
    ran = running_totals(counts, "v", ["a", "b"], groups=["feature"])
    # One row per column on the smaller side.
    totals = ran.groupBy("feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    upto = lambda v: F.try_divide(F.col(f"{v}_before") + F.col(v), F.col(f"n{v}"))
    worst = (
        ran.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.max(F.abs(upto("a") - upto("b"))).alias("statistic"), F.max("na").alias("na"), F.max("nb").alias("nb"))
    )
    size = F.col("na") * F.col("nb") / (F.col("na") + F.col("nb"))
    tested = worst.select("feature", "statistic", kolmogorov_tail(F.sqrt(size) * F.col("statistic")).alias("p_value"))
    return _every(tested, columns).withColumn("drifted", F.col("p_value") < KS_ALPHA)


def _every(tested: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, also for those without any value."""
    names = tested.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(tested, "feature", "left")


def kolmogorov_tail(x: Column) -> Column:
    """P(K > x) = 2 Σ (-1)^(k-1) exp(-2 k² x²); the series converges fast except near 0, where it is 1. Null stays null."""
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * x * x) for k in range(1, 31)), F.lit(0.0))
    return F.when(x < 0.2, F.lit(1.0)).when(x.isNotNull(), F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def category_psi(reference: DataFrame, current: DataFrame, columns: Sequence[str], floor: float = 1e-4) -> DataFrame:
    """(feature, statistic, p_value, drifted): population stability index of categorical columns.

    Shares of absent categories are read as `floor`. There is no p-value for this measure.
    """
    return psi_from_counts(category_counts(reference, columns), category_counts(current, columns), columns, floor)


def psi_from_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str], floor: float = 1e-4) -> DataFrame:
    """`category_psi` on two tables of (feature, v, n)."""
    counts = _two_sides(reference, current)
    totals = counts.groupBy("feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    part = lambda v: F.greatest(F.try_divide(F.col(v), F.col(f"n{v}")), F.lit(floor))
    p, q = part("a"), part("b")
    found = (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.sum((q - p) * F.ln(q / p)).alias("statistic"))
        .withColumn("p_value", F.lit(None).cast("double"))
    )
    return _every(found, columns).withColumn("drifted", F.col("statistic") >= PSI_LIMIT)


def dataset_drift(
    reference: DataFrame, current: DataFrame, exclude: Sequence[str] = (), share: float = DATASET_DRIFT_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Per-column tests on the shared columns, and one row (dataset_drift, drifted_features, total_features).

    Numeric columns use Kolmogorov-Smirnov, others the stability index; the tests are this
    library's own choice. Columns on one side only are not compared.
    """
    shared = [c for c in reference.columns if c in current.columns and c not in exclude]
    numeric = [c for c in shared if c in set(numeric_columns(reference)) & set(numeric_columns(current))]
    other = [c for c in shared if c not in numeric]
    tests = []
    if numeric:
        tests.append(ks_test(reference, current, numeric))
    if other:
        tests.append(category_psi(reference, current, other))
    if not tests:
        raise ValueError("The tables share no column to compare")
    table = reduce(DataFrame.unionByName, tests)
    return table, drift_summary(table, share)


def drift_summary(tests: DataFrame, share: float = DATASET_DRIFT_SHARE) -> DataFrame:
    drifted = F.count_if(F.coalesce(F.col("drifted"), F.lit(False)))
    return tests.agg(drifted.alias("drifted_features"), F.count(F.lit(1)).alias("total_features")).select(
        (F.col("drifted_features") >= F.col("total_features") * share).alias("dataset_drift"),
        "drifted_features",
        "total_features",
    )
