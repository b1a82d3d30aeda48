"""Running totals over a sorted key without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegate.session import checkpoint

# Keys that one window task sorts where their number is proven or counted.
WINDOW_ROWS = 20_000
# Keys of a range of a larger input, about.
RANGE_ROWS = 500_000


def running_totals(
    keyed: DataFrame,
    order: str,
    values: Sequence[str],
    *,
    groups: Sequence[str] = (),
    at_most: int | None = None,
    window_rows: int = WINDOW_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Adds `<value>_before`: the sum of `value` over smaller `order` keys of the same group.

    `keyed` holds one row per (groups, order), already aggregated, so a hot key is one row.
    Small inputs use one window per group; `at_most` is a bound on the rows that the caller has
    proven, without it they are written once and counted. Larger inputs are dealt out by ranges of
    the key, as many as the rows ask for, and written in that shape: totals of the ranges give
    every range its offset, and each range is summed by its own task.
    """
    if at_most is not None and at_most <= window_rows:
        return _one_window(keyed, order, values, groups)
    keyed = checkpoint(keyed)
    n = keyed.count()
    if n <= window_rows:
        return _one_window(keyed, order, values, groups)
    ranges = 2 + n // range_rows
    ranged = checkpoint(keyed.repartitionByRange(ranges, order).withColumn("range_", F.spark_partition_id()))
    keys = [*groups, "range_"]
    totals = ranged.groupBy(*keys).agg(*[F.sum(v).alias(f"{v}_range") for v in values])
    earlier = Window.partitionBy(*groups).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"o_{k}") for k in keys],
        *[F.coalesce(F.sum(f"{v}_range").over(earlier), F.lit(0)).alias(f"{v}_offset") for v in values],
    )
    within = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.select("*", *[(F.sum(v).over(within) - F.col(v)).alias(f"{v}_within") for v in values])
    same = [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys]
    return summed.join(offsets, same).select(
        *[F.col(c) for c in keyed.columns],
        *[(F.col(f"{v}_within") + F.col(f"{v}_offset")).alias(f"{v}_before") for v in values],
    )


def _one_window(keyed: DataFrame, order: str, values: Sequence[str], groups: Sequence[str]) -> DataFrame:
    upto = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return keyed.select("*", *[(F.sum(v).over(upto) - F.col(v)).alias(f"{v}_before") for v in values])


def row_numbers(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "place", *, window_rows: int = WINDOW_ROWS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """`df` with the place of every row, from 0, in the order of its group; rows of equal `order` get any of their places.

    Small inputs use one window per group. Larger ones are dealt out by ranges of (groups, order) and written in that
    shape; the rows of a group in each range say where its next range begins, so a group of any size has many tasks.
    Groups may be null.
    """
    kept = checkpoint(df)
    n = kept.count()
    keys = [F.col(f"`{c}`") for c in [*groups, *order]]
    if n <= window_rows:
        window = Window.partitionBy(*keys[: len(groups)]).orderBy(*keys[len(groups) :])
        return kept.withColumn(name, (F.row_number().over(window) - 1).cast("long"))
    dealt = kept.repartitionByRange(2 + n // range_rows, *keys).sortWithinPartitions(*keys)
    ranged = checkpoint(dealt.withColumn("range_", F.spark_partition_id()).withColumn("row_", F.monotonically_increasing_id()))
    by = [F.col(f"`{c}`") for c in groups]
    ranges = ranged.groupBy(*by, "range_").agg(F.min("row_").alias("first_"), F.count(F.lit(1)).alias("rows_"))
    earlier = Window.partitionBy(*by).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.select(
        *[c.alias(f"o_{k}") for k, c in enumerate(by)],
        F.col("range_").alias("o_range_"),
        (F.coalesce(F.sum("rows_").over(earlier), F.lit(0)) - F.col("first_")).alias("shift_"),
    )
    same = [c.eqNullSafe(F.col(f"o_{k}")) for k, c in enumerate(by)] + [F.col("range_") == F.col("o_range_")]
    return ranged.join(shifts, same).withColumn(name, F.col("row_") + F.col("shift_")).select(*[F.col(f"`{c}`") for c in df.columns], name)
