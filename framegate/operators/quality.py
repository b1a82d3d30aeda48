"""Feature quality gate and label-leakage guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.config import FeatureQAConfig, LeakageConfig
from framegate.functions.hashing import hashable
from framegate.functions.longform import MAX_AGGREGATES, summarise
from framegate.functions.nulls import clean_value, col, double_value, holds, is_numeric, numeric_columns, ratio
from framegate.functions.status import FAIL, WARN, GateError, level, overall
from framegate.operators.correlation import pair_correlation
from framegate.operators.profiling import distinct_counts


# -- feature quality ------------------------------------------------------------------------


def feature_measures(df: DataFrame, exclude: Sequence[str] = (), distinct: str = "exact") -> DataFrame:
    """(feature, missing_ratio, unique_ratio, infinite, missing) per feature column."""
    columns = [c for c in df.columns if c not in exclude]

    def infinite(c: str) -> Column:
        if not is_numeric(df.schema[c].dataType):
            return F.count(F.lit(None))
        return F.count_if(holds(F.abs(double_value(df, c)) == float("inf")))

    counts = summarise(
        df,
        columns,
        {
            "rows": lambda c: F.count(F.lit(1)),
            "missing": lambda c: F.count_if(clean_value(df, c).isNull()),
            "infinite": infinite,
        },
    )
    # One row per column on both sides.
    joined = counts.join(F.broadcast(distinct_counts(df, columns, distinct)), "feature", "left")
    rows = F.col("rows")
    return joined.select(
        "feature",
        ratio(F.col("missing"), rows).alias("missing_ratio"),
        ratio(F.col("distinct_values"), F.greatest(rows, F.lit(1))).alias("unique_ratio"),
        "infinite",
        "missing",
    )


def feature_qa(
    df: DataFrame, exclude: Sequence[str] = (), cfg: FeatureQAConfig = FeatureQAConfig(), distinct: str = "exact"
) -> DataFrame:
    """One row: status, details, worst missing ratio and the constant / near-constant / infinite / missing columns.

    Near-constant columns are only reported while nothing has failed yet; missing columns are
    listed but do not gate beyond the missing ratio.
    """
    if not cfg.enabled:
        none = F.array().cast("array<string>")
        return df.sparkSession.range(1).select(
            F.lit("pass").alias("status"),
            none.alias("details"),
            F.lit(0.0).alias("max_missing_ratio"),
            *[none.alias(n) for n in ("constant_features", "near_constant_features", "inf_features", "nan_features")],
        )
    numeric = numeric_columns(df)
    is_num = F.col("feature").isin(numeric) if numeric else F.lit(False)
    names = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("feature"))))
    low = F.col("unique_ratio") <= cfg.unique_ratio_fail
    m = feature_measures(df, exclude, distinct).agg(
        F.coalesce(F.max("missing_ratio"), F.lit(0.0)).alias("max_missing_ratio"),
        names(low).alias("constant_features"),
        names(~low & (F.col("unique_ratio") <= cfg.unique_ratio_warn)).alias("near"),
        names(F.col("infinite") > 0).alias("inf_features"),
        names((F.col("missing") > 0) & is_num).alias("nan_features"),
    )
    miss_fail = F.col("max_missing_ratio") >= cfg.missing_fail
    miss_warn = ~miss_fail & (F.col("max_missing_ratio") >= cfg.missing_warn)
    constant = F.size("constant_features") > 0
    failed_before = miss_fail | constant
    near = (F.size("near") > 0) & ~failed_before
    infinite = (F.size("inf_features") > 0) & F.lit(cfg.inf_fail)
    listed = lambda text, c: F.concat(F.lit(text + ": "), F.array_join(c, ", "))
    details = F.array(
        F.when(miss_fail, F.format_string("Missing ratio fails: %.4f", "max_missing_ratio")),
        F.when(miss_warn, F.format_string("Missing ratio warns: %.4f", "max_missing_ratio")),
        F.when(constant, listed("Constant features", F.col("constant_features"))),
        F.when(near, listed("Near-constant features", F.col("near"))),
        F.when(infinite, listed("Infinite values", F.col("inf_features"))),
    )
    return m.select(
        level(miss_warn | near, failed_before | infinite).alias("status"),
        F.filter(details, lambda d: d.isNotNull()).alias("details"),
        "max_missing_ratio",
        "constant_features",
        F.when(near, F.col("near")).otherwise(F.array().cast("array<string>")).alias("near_constant_features"),
        "inf_features",
        "nan_features",
    )


# -- leakage --------------------------------------------------------------------------------


def duplicate_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_a, col_b): columns equal in every row; a repeated copy is paired with its first occurrence.

    Order-free hash sums name the candidates in one scan, the candidates are then compared row
    by row, so columns that merely hold the same values in another order are not reported.
    """
    columns = list(columns or df.columns)
    value = lambda c: hashable(df, c) if isinstance(df.schema[c].dataType, T.MapType) else clean_value(df, c)
    sums = {
        r["feature"]: (r["h"], r["n"])
        for r in summarise(
            df, columns, {"h": lambda c: F.sum(F.xxhash64(value(c)).cast("decimal(38,0)")), "n": lambda c: F.count(value(c))}
        ).collect()
    }
    groups: dict[tuple, list[str]] = {}
    for c in columns:
        groups.setdefault((df.schema[c].dataType.simpleString(), *sums[c]), []).append(c)
    found: list[tuple[str, str]] = []
    # Each round compares the members of every group with its first one; who differs makes the next round.
    open_ = [g for g in groups.values() if len(g) > 1]
    while open_:
        pairs = [(g[0], b) for g in open_ for b in g[1:]]
        same: dict[tuple[str, str], bool] = {}
        for i in range(0, len(pairs), MAX_AGGREGATES):
            chunk = pairs[i : i + MAX_AGGREGATES]
            row = df.agg(*[F.coalesce(F.bool_and(value(a).eqNullSafe(value(b))), F.lit(True)).alias(f"s{k}") for k, (a, b) in enumerate(chunk)]).first()
            same.update(zip(chunk, row))
        found += [p for p in pairs if same[p]]
        open_ = [rest for g in open_ if len(rest := [b for b in g[1:] if not same[g[0], b]]) > 1]
    order = {c: i for i, c in enumerate(columns)}
    return df.sparkSession.createDataFrame(sorted(found, key=lambda p: order[p[1]]), "col_a string, col_b string")


def label_correlations(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """(feature, corr, abs_corr) with the label, strongest first; constant or empty columns are left out."""
    columns = numeric_columns(df, [target, *exclude])
    y = double_value(df, target)
    table = summarise(df, columns, {"corr": lambda c: pair_correlation(double_value(df, c), y)})
    return (
        table.filter("corr is not null")
        .withColumn("abs_corr", F.abs("corr"))
        .orderBy(F.desc("abs_corr"), "feature")
    )


def label_is_binary(df: DataFrame, target: str) -> DataFrame:
    """One row (binary): every present label is 0 or 1."""
    y = clean_value(df, target)
    return df.agg(F.coalesce(F.bool_and(F.when(y.isNotNull(), y.isin(0, 1))), F.lit(True)).alias("binary"))


def leakage_checks(df: DataFrame, cfg: LeakageConfig) -> DataFrame:
    """(check, status, message) in the order required columns, label, duplicates, label domain, proxies.

    A broken column contract or a non-binary label ends the checks there.
    """
    spark = df.sparkSession
    fixed = lambda *rows: spark.createDataFrame(list(rows), "check string, status string, message string")
    if not cfg.enabled:
        return fixed()
    absent = [c for c in cfg.required if c not in df.columns]
    if absent:
        return fixed(("required_columns", FAIL, f"Missing required columns: {absent}"))
    if cfg.target not in df.columns:
        return fixed(("target", FAIL, f"Target column not found: {cfg.target}"))
    found: list[tuple[str, str, str]] = []
    if cfg.check_duplicates:
        pairs = sorted((r["col_a"], r["col_b"]) for r in duplicate_columns(df).collect())
        if pairs:
            found.append(("duplicate_columns", WARN, f"Duplicate columns: {pairs}"))
    if not cfg.check_proxy:
        return fixed(*found)
    if not label_is_binary(df, cfg.target).first()["binary"]:
        return fixed(*found, ("target_domain", FAIL, "Target is not 0/1; label proxies cannot be checked"))
    checks = fixed(*found)
    if numeric_columns(df, [cfg.target]):
        checks = checks.unionByName(proxy_check(df, cfg))
    return checks


def proxy_check(df: DataFrame, cfg: LeakageConfig) -> DataFrame:
    strong = label_correlations(df, cfg.target).filter(F.col("abs_corr") >= cfg.corr_warn)
    listed = F.array_join(F.array_sort(F.collect_list("feature")), ", ")
    return (
        strong.agg(F.max("abs_corr").alias("top"), listed.alias("features"))
        .filter("top is not null")
        .select(
            F.lit("target_proxy").alias("check"),
            level(True, F.col("top") >= cfg.corr_fail).alias("status"),
            F.format_string("Possible label proxies, |corr| up to %.3f: %s", "top", "features").alias("message"),
        )
    )


def leakage_report(df: DataFrame, cfg: LeakageConfig) -> DataFrame:
    return overall(leakage_checks(df, cfg))


def guard_leakage(df: DataFrame, cfg: LeakageConfig) -> DataFrame:
    """Raise when a check fails, else drop id and forbidden columns; the label always stays."""
    if not cfg.enabled:
        return df
    report = leakage_report(df, cfg).first()
    if report["status"] == FAIL:
        raise GateError("Leakage guard failed:\n- " + "\n- ".join(report["details"]))
    return without_leaks(df, cfg)


def without_leaks(df: DataFrame, cfg: LeakageConfig) -> DataFrame:
    """The table without id and forbidden columns; no check is run."""
    if not cfg.enabled:
        return df
    drop = [c for c in (cfg.id_cols if cfg.drop_id_cols else ()) if c != cfg.target]
    drop += [c for c in cfg.forbidden if c != cfg.target]
    return df.select(*[col(c) for c in df.columns if c not in drop])
