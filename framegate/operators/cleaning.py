"""Row repairs: each one is a projection, only duplicate removal shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import CleaningConfig, Roles, ValidationConfig
from framegate.functions.longform import summarise
from framegate.functions.nulls import clean_value, clip, col, smaller_of
from framegate.operators.contracts import rule_predicates


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row of every group of equal rows; missing equals missing.

    Spark combines copies on the map side, so a heavily copied row costs one record per task.
    """
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """(rows, duplicate_rows): rows beyond the first of each group of equal rows."""
    groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(feature, missing) per column in one scan."""
    return summarise(df, df.columns, {"missing": lambda c: F.count_if(clean_value(df, c).isNull())})


def imputed_ratio(made: Column, attempted: Column, percent: Column) -> Column:
    """A missing percent becomes made/attempted*100, or 0 without attempts; present ones stay."""
    derived = F.when(attempted > 0, made / attempted * 100).otherwise(F.lit(0.0))
    return F.when(percent.isNull(), derived).otherwise(percent)


def impute_ratio(df: DataFrame, roles: Roles) -> DataFrame:
    if roles.impute is None:
        return df
    made, attempted, percent = roles.impute
    return df.withColumn(percent, imputed_ratio(col(made), col(attempted), clean_value(df, percent)))


def correct_values(df: DataFrame, roles: Roles) -> DataFrame:
    """Clip percents, cap, floor at 0, then limit made to attempted, then recompute the total.

    The steps build on each other (a floored count may still exceed its attempts), so the
    expressions are nested in this order and applied as one projection.
    """
    present = set(df.columns)
    now: dict[str, Column] = {}
    value = lambda c: now.get(c, clean_value(df, c))
    for c in roles.percent_cols:
        if c in present:
            now[c] = clip(value(c), *roles.percent_bounds)
    for c, cap in roles.caps.items():
        if c in present:
            now[c] = clip(value(c), high=cap)
    for c in roles.non_negative:
        if c in present:
            now[c] = clip(value(c), low=0)
    for made, attempted in roles.pairs:
        if {made, attempted} <= present:
            now[made] = smaller_of(value(made), value(attempted))
    if roles.sum_identity and set(roles.sum_identity) <= present:
        a, b, total = roles.sum_identity
        now[total] = value(a) + value(b)
    return df.withColumns({c: e.cast(df.schema[c].dataType) for c, e in now.items()}) if now else df


def clean(df: DataFrame, roles: Roles, cfg: CleaningConfig = CleaningConfig()) -> DataFrame:
    """Duplicates, then imputation, then corrections, each behind its switch."""
    if cfg.drop_duplicates:
        df = drop_duplicate_rows(df)
    if cfg.impute_ratio:
        df = impute_ratio(df, roles)
    if cfg.correct_values:
        df = correct_values(df, roles)
    return df


def drop_violations(df: DataFrame, roles: Roles, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """The other policy: keep only rows that break no rule. A missing value breaks none."""
    keep = F.lit(True)
    for predicate in rule_predicates(df, roles, cfg).values():
        keep = keep & ~predicate
    return df.filter(keep)
