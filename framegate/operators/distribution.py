"""Drift of small batches against a large reference that was counted, ordered and written once.

Numbers are kept as their distinct values with running counts, in ranges of some thousand values and files of many
ranges. A batch looks up the reference at its own values only: its values find their ranges by one running total over
values and range starts, read these ranges, and take the last reference value at or below each of them. Categories are
kept as counts, next to what the measure would be if a batch had none of them, so that a batch only looks up its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framegate.functions.cumulative import row_numbers, running_totals
from framegate.functions.nulls import numeric_columns
from framegate.operators.drift import (
    DATASET_DRIFT_SHARE, KS_ALPHA, PSI_LIMIT, category_counts, drift_summary, kolmogorov_tail, value_counts,
)

# Distinct values of a range, and ranges of a folder of the written reference.
RANGE_VALUES = 8_192
FOLDER_RANGES = 1_024
# Share that an absent category counts with.
FLOOR = 1e-4


@dataclass(frozen=True)
class Distribution:
    """A reference at rest. Only `values` and `categories` grow with it, and they are read by key.

    values: folder_, range_, feature, v, n, n_before; starts: the first value of every range; totals: rows with a value for
    each number; categories: feature, v, n; absent: rows of each category column, and the index of a batch without any.
    """

    numeric: tuple[str, ...]
    other: tuple[str, ...]
    values: DataFrame
    starts: DataFrame
    totals: DataFrame
    categories: DataFrame
    absent: DataFrame


def save_distribution(
    reference: DataFrame, path: str, columns: Sequence[str] | None = None, floor: float = FLOOR,
    range_values: int = RANGE_VALUES, folder_ranges: int = FOLDER_RANGES,
) -> Distribution:
    """Counts, orders and writes the reference; numbers and categories are scanned once each.

    Missing numbers are left out, a missing category is one of its own, as in the tests on two tables. An empty reference
    is written as empty tables. The folder is replaced.
    """
    spark = reference.sparkSession
    columns = list(columns or reference.columns)
    numeric = [c for c in numeric_columns(reference) if c in set(columns)]
    other = [c for c in columns if c not in set(numeric)]
    empty = spark.createDataFrame([], "feature string, v double, n long")
    counts = value_counts(reference, numeric) if numeric else empty
    placed = row_numbers(counts, ["feature"], ["v"], "place").withColumn("range_", F.floor(F.col("place") / range_values))
    # The running counts of a range start from the ranges before it: as many rows as there are ranges.
    sums = placed.groupBy("feature", "range_").agg(F.sum("n").alias("range_n"))
    within = Window.partitionBy("feature", "range_").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    offsets = running_totals(sums, "range_", ["range_n"], groups=["feature"]).select("feature", "range_", "range_n_before")
    ordered = (
        placed.join(offsets, ["feature", "range_"])
        .withColumn("n_before", F.coalesce(F.sum("n").over(within), F.lit(0)) + F.col("range_n_before"))
        .withColumn("folder_", F.floor(F.col("range_") / folder_ranges))
    )
    ordered.select("folder_", "range_", "feature", "v", "n", "n_before").repartition("folder_", "feature", "range_").sortWithinPartitions(
        "folder_", "feature", "v"
    ).write.mode("overwrite").partitionBy("folder_").parquet(f"{path}/values")
    values = spark.read.schema("range_ long, feature string, v double, n long, n_before long, folder_ long").parquet(f"{path}/values")
    values.groupBy("feature", "folder_", "range_").agg(F.min("v").alias("v")).write.mode("overwrite").parquet(f"{path}/starts")
    values.groupBy("feature").agg(F.sum("n").alias("na")).write.mode("overwrite").parquet(f"{path}/totals")

    kinds = category_counts(reference, other) if other else spark.createDataFrame([], "feature string, v string, n long")
    kinds.write.mode("overwrite").parquet(f"{path}/categories")
    kinds = spark.read.schema("feature string, v string, n long").parquet(f"{path}/categories")
    totals = kinds.groupBy("feature").agg(F.sum("n").alias("na"))
    # One row per column.
    gone = _index(_share("n", "na", floor), F.lit(floor))
    kinds.join(F.broadcast(totals), "feature").groupBy("feature").agg(F.max("na").alias("na"), F.sum(gone).alias("gone")).write.mode(
        "overwrite"
    ).parquet(f"{path}/absent")
    kept = spark.createDataFrame([(c, c in set(numeric)) for c in columns], "feature string, numeric boolean")
    kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
    return load_distribution(spark, path)


def load_distribution(spark: SparkSession, path: str) -> Distribution:
    """What `save_distribution` has written, also in another application."""
    names = spark.read.schema("feature string, numeric boolean").parquet(f"{path}/columns").collect()
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    return Distribution(
        tuple(r["feature"] for r in names if r["numeric"]),
        tuple(r["feature"] for r in names if not r["numeric"]),
        read("values", "range_ long, feature string, v double, n long, n_before long, folder_ long"),
        read("starts", "feature string, folder_ long, range_ long, v double"),
        read("totals", "feature string, na long"),
        read("categories", "feature string, v string, n long"),
        read("absent", "feature string, na long, gone double"),
    )


def _share(n: str, total: str, floor: float):
    return F.greatest(F.try_divide(F.col(n), F.col(total)), F.lit(floor))


def _index(p, q):
    return (q - p) * F.ln(q / p)


def reference_counts(reference: Distribution, batch: DataFrame, range_values: int = RANGE_VALUES) -> DataFrame:
    """`batch` (feature, v, n; distinct values) with n_before of its own, and ref_before and ref_upto of the reference.

    ref_before counts the reference values below v, ref_upto those at or below. Points that share a range of the
    reference are dealt out in runs of `range_values`; a run reads its range once, so what is read are as many ranges as
    the batch touches and one more for each run, however the batch is spread.
    """
    zero = F.lit(0).cast("long")
    keyed = batch.select("feature", "v", "n", F.lit(1).cast("long").alias("points"), zero.alias("starts"))
    starts = reference.starts.select("feature", "v", zero.alias("n"), zero.alias("points"), F.lit(1).cast("long").alias("starts"))
    sums = ["n", "points", "starts"]
    line = keyed.unionByName(starts).groupBy("feature", "v").agg(*[F.sum(c).alias(c) for c in sums])
    ran = running_totals(line, "v", sums, groups=["feature"]).filter("points > 0")
    points = ran.select(
        "feature", "v", "n", "n_before",
        (F.col("starts_before") + F.col("starts") - 1).alias("range_"),
        F.floor(F.col("points_before") / range_values).alias("run_"),
    )
    cells = points.select("feature", "range_", "run_").distinct().join(reference.starts.drop("v"), ["feature", "range_"])
    found = reference.values.join(cells, ["folder_", "feature", "range_"])
    null = F.lit(None).cast("long")
    both = points.select("*", F.lit(1).alias("point"), null.alias("ref_n"), null.alias("ref_n_before")).unionByName(
        found.select(
            "feature", "v", null.alias("n"), null.alias("n_before"), "range_", "run_", F.lit(0).alias("point"),
            F.col("n").alias("ref_n"), F.col("n_before").alias("ref_n_before"),
        )
    )
    upto = Window.partitionBy("feature", "range_", "run_").orderBy("v", "point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("point") == 0, F.struct("v", "ref_n", "ref_n_before")), ignorenulls=True).over(upto)
    hit = both.withColumn("hit", last).filter("point = 1")
    through = F.col("hit.ref_n_before") + F.col("hit.ref_n")
    return hit.select(
        "feature", "v", "n", "n_before",
        F.coalesce(F.when(F.col("hit.v") == F.col("v"), F.col("hit.ref_n_before")).otherwise(through), F.lit(0)).alias("ref_before"),
        F.coalesce(through, F.lit(0)).alias("ref_upto"),
    )


def ks_saved(reference: Distribution, current: DataFrame, columns: Sequence[str], range_values: int = RANGE_VALUES) -> DataFrame:
    """`drift.ks_test` of the current rows against a saved reference: (feature, statistic, p_value, drifted).

    Between two values of the batch its own share stays the same, so the distance is largest at a value or just below one.
    A column without values on either side has a null statistic.
    """
    batch = value_counts(current, columns)
    counts = reference_counts(reference, batch, range_values)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("nb"))
    # Both are one row per column.
    sizes = F.broadcast(reference.totals.join(F.broadcast(totals), "feature"))
    at = F.abs(F.col("ref_upto") / F.col("na") - (F.col("n_before") + F.col("n")) / F.col("nb"))
    below = F.abs(F.col("ref_before") / F.col("na") - F.col("n_before") / F.col("nb"))
    worst = counts.join(sizes, "feature").groupBy("feature").agg(
        F.max(F.greatest(at, below)).alias("statistic"), F.max("na").alias("na"), F.max("nb").alias("nb")
    )
    size = F.col("na") * F.col("nb") / (F.col("na") + F.col("nb"))
    tested = worst.select("feature", "statistic", kolmogorov_tail(F.sqrt(size) * F.col("statistic")).alias("p_value"))
    return _named(tested, columns).withColumn("drifted", F.col("p_value") < KS_ALPHA)


def psi_saved(reference: Distribution, current: DataFrame, columns: Sequence[str], floor: float = FLOOR) -> DataFrame:
    """`drift.category_psi` against a saved reference; `floor` must be the one it was saved with.

    Starts from the index of a batch without any category and replaces the terms of those it has.
    """
    batch = category_counts(current, columns).withColumnRenamed("n", "nb_")
    totals = batch.groupBy("feature").agg(F.sum("nb_").alias("nb"))
    known = reference.categories.select(F.col("feature").alias("f_"), F.col("v").alias("v_"), "n")
    met = batch.join(known, (F.col("feature") == F.col("f_")) & F.col("v").eqNullSafe(F.col("v_")), "left")
    sizes = F.broadcast(reference.absent.join(F.broadcast(totals), "feature", "full"))
    p = F.greatest(F.coalesce(F.try_divide(F.col("n"), F.col("na")), F.lit(0.0)), F.lit(floor))
    q = _share("nb_", "nb", floor)
    change = _index(p, q) - F.when(F.col("n").isNotNull(), _index(p, F.lit(floor))).otherwise(F.lit(0.0))
    changes = met.join(sizes, "feature").groupBy("feature").agg(F.sum(change).alias("change"))
    found = reference.absent.join(F.broadcast(changes), "feature", "full").select(
        "feature",
        (F.coalesce("gone", F.lit(0.0)) + F.coalesce("change", F.lit(0.0))).alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
    )
    return _named(found, columns).withColumn("drifted", F.col("statistic") >= PSI_LIMIT)


def _named(tested: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = tested.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(F.broadcast(tested), "feature", "left")


def drift_from_saved(
    reference: Distribution, current: DataFrame, share: float = DATASET_DRIFT_SHARE, range_values: int = RANGE_VALUES
) -> tuple[DataFrame, DataFrame]:
    """`drift.dataset_drift` of the current rows: (tests per column, one row of the whole). The reference is only looked up.

    The current table must have the columns of the reference; more columns are not compared.
    """
    tests = []
    if reference.numeric:
        tests.append(ks_saved(reference, current, reference.numeric, range_values))
    if reference.other:
        tests.append(psi_saved(reference, current, reference.other))
    if not tests:
        raise ValueError("The reference has no column to compare")
    table = reduce(DataFrame.unionByName, tests)
    return table, drift_summary(table, share)
