"""Row-level quantile outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import AnomalyConfig
from framegate.functions.longform import number, rows_from, summarise, text
from framegate.functions.nulls import col, double_value, holds, numeric_columns
from framegate.functions.quantiles import column_extent, exact_quantiles
from framegate.functions.status import level

Bounds = Mapping[str, tuple[float, float]]


def quantile_bounds(df: DataFrame, cfg: AnomalyConfig = AnomalyConfig()) -> dict[str, tuple[float, float]]:
    """Low and high limit per eligible numeric column, in column order."""
    columns = numeric_columns(df, cfg.exclude)
    if not cfg.enabled or not columns:
        return {}
    probs = [cfg.q_low, cfg.q_high]
    if cfg.method == "approx":
        extent = {c: e.rows for c, e in column_extent(df, columns).items()}
        sketch = summarise(df, columns, {"q": lambda c: F.percentile_approx(double_value(df, c), probs, 10_000)})
        found = {r["feature"]: r["q"] for r in sketch.collect()}
        return {c: tuple(found[c]) for c in columns if extent[c] >= max(cfg.min_non_null, 1)}
    extent = column_extent(df, columns)
    eligible = [c for c in columns if extent[c].rows >= max(cfg.min_non_null, 1)]
    found = exact_quantiles(df, eligible, probs, extent=extent)
    return {c: (found[c][0], found[c][1]) for c in eligible}


def outlier_flags(df: DataFrame, bounds: Bounds) -> dict[str, Column]:
    return {c: holds((double_value(df, c) < lo) | (double_value(df, c) > hi)) for c, (lo, hi) in bounds.items()}


def flag_outliers(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Adds `outlier_count`, `outlier_any` and `outlier_cols` (comma list in column order).

    The bounds are a few numbers, so the table itself only sees a projection. Without bounds
    (disabled, or no eligible column) every row is unflagged.
    """
    flags = outlier_flags(df, bounds)
    if not flags:
        return df.withColumns({"outlier_count": F.lit(0), "outlier_any": F.lit(False), "outlier_cols": F.lit("")})
    count = sum((f.cast("int") for f in flags.values()), F.lit(0))
    return df.withColumns(
        {
            "outlier_count": count,
            "outlier_any": count > 0,
            "outlier_cols": F.concat_ws(",", *[F.when(f, F.lit(c)) for c, f in flags.items()]),
        }
    )


def outlier_rates(df: DataFrame, bounds: Bounds) -> DataFrame:
    """(feature, low, high, outlier_rate) over all rows, missing ones included."""
    flags = outlier_flags(df, bounds)
    rates = df.agg(*[F.avg(f.cast("double")).alias(f"r{i}") for i, f in enumerate(flags.values())])
    return rows_from(
        rates,
        [
            {"feature": text(c), "low": number(lo), "high": number(hi), "outlier_rate": f"coalesce(r{i}, 0D)"}
            for i, (c, (lo, hi)) in enumerate(bounds.items())
        ],
    )


def outlier_report(df: DataFrame, bounds: Bounds, cfg: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """One row: status, share of rows with any flag and every message that applies."""
    flags = list(outlier_flags(df, bounds).values())
    if not flags:
        reason = "No eligible numeric columns." if cfg.enabled else "Outlier detection disabled."
        empty = df.sparkSession.range(1)
        return empty.select(
            F.lit(cfg.enabled).alias("enabled"),
            F.lit("pass").alias("status"),
            F.lit(0.0).alias("outlier_rate"),
            F.array(F.lit(reason)).alias("details"),
        )
    anywhere = flags[0]
    for f in flags[1:]:
        anywhere = anywhere | f
    rate = df.agg(F.coalesce(F.avg(anywhere.cast("double")), F.lit(0.0)).alias("outlier_rate"))
    warn, fail = F.col("outlier_rate") >= cfg.rate_warn, F.col("outlier_rate") >= cfg.rate_fail
    said = F.filter(
        F.array(
            F.when(warn, F.lit(f"Outlier rate reaches warn limit {cfg.rate_warn:g}")),
            F.when(fail, F.lit(f"Outlier rate reaches fail limit {cfg.rate_fail:g}")),
            F.when(~warn & ~fail, F.lit("Outlier rate within limits")),
        ),
        lambda m: m.isNotNull(),
    )
    return rate.select(
        F.lit(True).alias("enabled"), level(warn, fail).alias("status"), "outlier_rate", said.alias("details")
    )


def outlier_matrix(
    df: DataFrame, bounds: Bounds, order_by: Sequence[str], columns: int = 12, rows: int | None = 120
) -> DataFrame:
    """0/1 flags of the most flagged columns for the first rows by the given key (a top-k report), or for all (`rows=None`)."""
    top = outlier_rates(df, bounds).orderBy(F.desc("outlier_rate"), "feature").limit(columns).collect()
    flags = outlier_flags(df, bounds)
    keys = [col(k) for k in order_by]
    first = df if rows is None else df.orderBy(*keys).limit(rows)
    return first.select(*keys, *[flags[r["feature"]].cast("int").alias(r["feature"] + "_flag") for r in top])
