"""Table fingerprints as states of slices that merge, so that yesterday's rows are not read again.

A state has one row per column: counts, mean, sum of squared deviations, extent, a sketch of the distinct values and one of
the ranks. States of any slices (days, files, halves) merge into that of all their rows. Counts and extents are exact,
moments are exact up to rounding, distinct values within some 1 % (`DISTINCT_BITS`) and ranks within some 0.3 %
(`RANK_SIZE`, exact up to that many values). Slices are written under their names; a name written again is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framegate.functions.longform import summarise
from framegate.functions.nulls import clean_value, double_value, is_numeric
from framegate.operators.profiling import QUANTILES, quantile_name

DISTINCT_BITS = 14
RANK_SIZE = 1024

_STATE = "feature string, rows long, missing long, n long, mean double, squares double, low double, high double, distinct_sketch binary, rank_sketch binary"


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The state of the rows of `df`, one row per column, from one scan (of wide tables, one for some fifty columns).

    Measures of other than numeric columns are null. Missing values are counted and enter nothing else. A table without
    rows has counts of 0.
    """
    columns = list(columns or df.columns)
    numeric = [c for c in columns if is_numeric(df.schema[c].dataType)]
    rest = [c for c in columns if c not in numeric]
    value = lambda c: double_value(df, c)

    def hashed(c: str) -> Column:
        # The sketch would pass over empty texts and count the two zeros twice.
        v = clean_value(df, c)
        return F.when(v.isNotNull(), F.xxhash64(v if c in numeric else v.cast("string")))

    general = {
        "rows": lambda c: F.count(F.lit(1)),
        "missing": lambda c: F.count_if(clean_value(df, c).isNull()),
        "distinct_sketch": lambda c: F.hll_sketch_agg(hashed(c), DISTINCT_BITS),
    }
    measures = {
        "n": lambda c: F.count(value(c)),
        "mean": lambda c: F.avg(value(c)),
        "squares": lambda c: F.var_pop(value(c)) * F.count(value(c)),
        "low": lambda c: F.min(value(c)),
        "high": lambda c: F.max(value(c)),
        "rank_sketch": lambda c: F.kll_sketch_agg_double(value(c), RANK_SIZE),
    }
    names = [part.split(" ")[0] for part in _STATE.split(", ")]
    parts = [summarise(df, numeric, general | measures)] if numeric else []
    if rest:
        known = summarise(df, rest, general)
        kinds = dict(part.split(" ") for part in _STATE.split(", "))
        parts.append(known.select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in measures]))
    return reduce(DataFrame.unionByName, parts).select(*names)


def merge_states(states: DataFrame) -> DataFrame:
    """One row per column from rows of many slices. Deviations are moved to the common mean, never taken from sums of squares."""
    means = states.groupBy("feature").agg(F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("common"))
    moved = F.col("squares") + F.col("n") * (F.col("mean") - F.col("common")) ** 2
    return (
        states.join(means, "feature")
        .groupBy("feature")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("missing").alias("missing"),
            F.sum("n").alias("n"),
            F.any_value("common").alias("mean"),
            F.sum(moved).alias("squares"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
            F.kll_merge_agg_double("rank_sketch", RANK_SIZE).alias("rank_sketch"),
        )
    )


def profile_of(states: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The fingerprint of all slices together, in the columns of `profiling.profile`; drift checks take it as a baseline."""
    distinct = F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)) + (F.col("missing") > 0).cast("int")
    point = lambda q: F.when(F.kll_sketch_get_n_double("rank_sketch") > 0, F.kll_sketch_get_quantile_double("rank_sketch", F.lit(float(q))))
    some = F.greatest(F.col("rows"), F.lit(1))
    return merge_states(states).select(
        "feature",
        "rows",
        (F.col("missing") / some).alias("missing_ratio"),
        F.least(distinct / some, F.lit(1.0)).alias("unique_ratio"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("std"),
        *[point(q).alias(quantile_name(q)) for q in quantiles],
    )


def save_slice(df: DataFrame, path: str, name: str, columns: Sequence[str] | None = None) -> None:
    """Write the state of one slice; the same name again replaces it, so a step that is run twice counts once."""
    if not name or set(name) & set("/\\=%*?{}[]"):
        raise ValueError(f"Not a slice name: {name!r}")
    profile_state(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/slice={name}")


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """The states of all slices with their names; none if nothing was written yet."""
    try:
        return spark.read.schema(f"{_STATE}, slice string").parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{_STATE}, slice string")
