"""Table fingerprints and the statistical gates on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.config import StatCheckConfig
from framegate.functions.longform import melt, rows_from, scalar_struct, summarise
from framegate.functions.nulls import clean_value, col, double_value, is_numeric, numeric_columns, share
from framegate.functions.quantiles import Interval, quantile_frame
from framegate.functions.status import level

QUANTILES = (0.01, 0.50, 0.99)


def quantile_name(q: float) -> str:
    return f"p{int(q * 100):02d}"


# -- distinct values ------------------------------------------------------------------------


def distinct_counts(df: DataFrame, columns: Sequence[str], method: str = "exact") -> DataFrame:
    """(feature, distinct_values, has_missing); missing values are not counted as a value.

    Exact counts go through one long (feature, value) table per storage type: values are
    combined on the map side and spread over the cluster by (feature, value), so neither a
    hot value nor a wide table meets in one task. `approx` is one scan with bounded sketches.
    """
    if method == "approx":
        return summarise(
            df,
            columns,
            {
                "distinct_values": lambda c: F.approx_count_distinct(clean_value(df, c)),
                "has_missing": lambda c: F.coalesce(F.max(clean_value(df, c).isNull()), F.lit(False)),
            },
        )
    if method != "exact":
        raise ValueError(f"Unknown distinct count method: {method}")
    by_type: dict[str, dict[str, Column]] = {}
    for c in columns:
        kind = _storage(df.schema[c].dataType)
        by_type.setdefault(kind, {})[c] = clean_value(df, c).cast(kind)
    tables = [
        melt(df, values)
        .groupBy("feature")
        .agg(F.count_distinct("value").alias("distinct_values"), F.max(F.col("value").isNull()).alias("has_missing"))
        for values in by_type.values()
    ]
    return reduce(DataFrame.unionByName, tables)


def _storage(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DecimalType, T.DateType, T.BooleanType)):
        return dtype.simpleString()
    return "string"


# -- profile --------------------------------------------------------------------------------


def measure_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, Row]:
    """rows, missing_ratio, n, mean, std, low and high of each column (the last five of numeric ones), from one scan."""
    numeric = {c for c in columns if is_numeric(df.schema[c].dataType)}
    value = lambda c: double_value(df, c) if c in numeric else F.lit(None).cast("double")
    table = summarise(
        df,
        columns,
        {
            "rows": lambda c: F.count(F.lit(1)),
            "missing_ratio": lambda c: share(clean_value(df, c).isNull()),
            "n": lambda c: F.count(value(c)),
            "mean": lambda c: F.avg(value(c)),
            "std": lambda c: F.stddev_samp(value(c)),
            "low": lambda c: F.min(value(c)),
            "high": lambda c: F.max(value(c)),
        },
    )
    return {r["feature"]: r for r in table.collect()}


def missing_and_unique(df: DataFrame, columns: Sequence[str] | None = None, distinct: str = "exact") -> DataFrame:
    """(feature, rows, missing_ratio, unique_ratio) for all columns; missing counts as one value."""
    columns = list(columns or df.columns)
    return _with_unique(df, columns, measure_columns(df, columns), distinct)


def _with_unique(df: DataFrame, columns: Sequence[str], measured: Mapping[str, Row], distinct: str) -> DataFrame:
    rows = [(c, measured[c]["rows"], measured[c]["missing_ratio"]) for c in columns]
    counted = df.sparkSession.createDataFrame(rows, "feature string, rows bigint, missing_ratio double")
    values = distinct_counts(df, columns, distinct)
    # Both tables have one row per column of the input.
    joined = counted.join(F.broadcast(values), "feature", "left")
    seen = F.coalesce(F.col("distinct_values"), F.lit(0)) + F.coalesce(F.col("has_missing").cast("int"), F.lit(0))
    return joined.select(
        "feature", "rows", "missing_ratio", (seen / F.greatest(F.col("rows"), F.lit(1))).alias("unique_ratio")
    )


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    quantiles: Sequence[float] = QUANTILES,
    method: str = "exact",
    measured: Mapping[str, Row] | None = None,
) -> DataFrame:
    """(feature, mean, std, p01, p50, p99) over the non-missing values of numeric columns."""
    columns = list(columns or numeric_columns(df))
    measured = measured or measure_columns(df, columns)
    rows = [(c, measured[c]["mean"], measured[c]["std"]) for c in columns]
    moments = df.sparkSession.createDataFrame(rows, "feature string, mean double, std double")
    extent = {c: Interval(c, measured[c]["low"], measured[c]["high"], 0, measured[c]["n"]) for c in columns}
    points = quantile_frame(df, columns, quantiles, [quantile_name(q) for q in quantiles], method=method, extent=extent)
    return moments.join(F.broadcast(points), "feature")


def profile(
    df: DataFrame,
    quantiles: Sequence[float] = QUANTILES,
    method: str = "exact",
    distinct: str = "exact",
    exclude: Sequence[str] = (),
) -> DataFrame:
    """The full fingerprint: one row per column, numeric measures NULL for other columns.

    One scan measures everything but distinct values and quantiles; the quantile search starts from
    its extents. Persist the table with `write_report(…, fmt="json")` and read it back as a drift baseline.
    """
    columns = [c for c in df.columns if c not in exclude]
    measured = measure_columns(df, columns)
    general = _with_unique(df, columns, measured, distinct)
    numeric = [c for c in columns if is_numeric(df.schema[c].dataType)]
    if not numeric:
        names = ["mean", "std", *[quantile_name(q) for q in quantiles]]
        return general.select("*", *[F.lit(None).cast("double").alias(n) for n in names])
    return general.join(F.broadcast(numeric_summary(df, numeric, quantiles, method, measured)), "feature", "left")


def target_distribution(df: DataFrame, target: str, as_percent: bool = False, keep_missing: bool = True) -> DataFrame:
    """(value, rows, share) per label value; in percent and without missing labels for balance reports."""
    labels = df.select(clean_value(df, target).alias("value"))
    if not keep_missing:
        labels = labels.filter("value is not null")
    counts = labels.groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("n"))
    part = F.col("rows") / scalar_struct(total)["n"]
    if as_percent:
        return counts.select("value", "rows", (part * 100).alias("percent"))
    return counts.select("value", "rows", part.alias("share"))


def profile_summary(profile_table: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Rounded mean, std and quantiles of the listed columns, in the listed order."""
    wanted = F.array(*[F.lit(c) for c in columns])
    measures = [c for c in profile_table.columns if c in ("mean", "std") or c.startswith("p") and c[1:].isdigit()]
    place = F.array_position(wanted, F.col("feature"))
    return (
        profile_table.filter((place > 0) & F.col("mean").isNotNull())
        .orderBy(place)
        .select("feature", *[F.round(m, digits).alias(m) for m in measures])
    )


# -- gates ----------------------------------------------------------------------------------


def zscore_rates(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: StatCheckConfig = StatCheckConfig(), measured: Mapping[str, Row] | None = None
) -> DataFrame:
    """(feature, outlier_rate): share of |x - mean| / std above the limit, over non-missing values.

    Means and deviations come from `measure_columns` or a profile, three numbers per column; the
    rates are one scan. Columns with too few values or no spread are left out of the table.
    """
    columns = list(columns or numeric_columns(df))
    measured = measured or measure_columns(df, columns)
    usable = {c: measured[c] for c in columns if _values(measured[c]) >= cfg.zscore_min_rows and measured[c]["std"]}
    if not usable:
        return df.sparkSession.createDataFrame([], "feature string, outlier_rate double")

    def rate(c: str) -> Column:
        z = F.abs((double_value(df, c) - F.lit(usable[c]["mean"])) / F.lit(usable[c]["std"]))
        return F.avg((z > cfg.zscore).cast("double"))

    return summarise(df, list(usable), {"outlier_rate": rate})


def _values(measured: Row) -> int:
    """Values that are there, of a row of `measure_columns` or of a profile."""
    return measured["n"] if "n" in measured else round(measured["rows"] * (1 - measured["missing_ratio"]))


def stat_checks(
    df: DataFrame,
    target: str | None = None,
    cfg: StatCheckConfig = StatCheckConfig(),
    profiled: DataFrame | None = None,
) -> DataFrame:
    """(check, status, columns, message): missingness, near-constant columns, outlier rates, label share.

    With a saved profile nothing that it holds is measured again.
    """
    numeric = numeric_columns(df)
    if profiled is not None:
        base = profiled
        known = {r["feature"]: r for r in profiled.collect()} if "mean" in profiled.columns else {}
        measured = known if all(c in known for c in numeric) else None
    else:
        measured = measure_columns(df, df.columns)
        base = _with_unique(df, df.columns, measured, "exact")
    names = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("feature"))))
    constant = F.col("unique_ratio") <= cfg.constant_unique_ratio
    if cfg.constant_max_distinct is not None:
        constant = constant & (F.col("unique_ratio") * F.col("rows") <= cfg.constant_max_distinct)
    first = base.agg(
        names(F.col("missing_ratio") >= cfg.missing_warn).alias("warn_cols"),
        names(F.col("missing_ratio") >= cfg.missing_fail).alias("fail_cols"),
        names(constant).alias("constant_cols"),
    )
    checks = rows_from(
        first,
        [
            _check("missingness_warn", F.col("warn_cols"), level(F.size("warn_cols") > 0)),
            _check("missingness_fail", F.col("fail_cols"), level(False, F.size("fail_cols") > 0)),
            _check("near_constant", F.col("constant_cols"), level(F.size("constant_cols") > 0)),
        ],
    )
    if numeric:
        high = zscore_rates(df, numeric, cfg, measured).agg(names(F.col("outlier_rate") >= cfg.outlier_rate_warn).alias("high"))
        checks = checks.unionByName(rows_from(high, [_check("outlier_rate", F.col("high"), level(F.size("high") > 0))]))
    if target and target in df.columns:
        top = target_distribution(df, target).agg(F.max("share").alias("top"))
        skewed = F.col("top") >= cfg.target_max_share
        flagged = F.when(F.coalesce(skewed, F.lit(False)), F.array(F.lit(target))).otherwise(
            F.array().cast("array<string>")
        )
        checks = checks.unionByName(rows_from(top, [_check("target_share", flagged, level(skewed))]))
    return checks


def _check(name: str, columns: Column, status: Column) -> dict[str, Column]:
    return {
        "check": F.lit(name),
        "status": status,
        "columns": columns,
        "message": F.format_string("%s: %s", F.lit(name), F.array_join(columns, ", ")),
    }


def missing_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, missing_pct), most missing first."""
    columns = list(columns or df.columns)
    table = summarise(df, columns, {"missing_pct": lambda c: share(clean_value(df, c).isNull()) * 100})
    return table.orderBy(F.desc("missing_pct"), "feature")
