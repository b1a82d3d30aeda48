"""Mutual information of numbers with a label by nearest neighbours, in one dimension and without comparing all pairs.

For each value: r is the distance to its k-th neighbour of the same label, m the number of values of any label closer than
r, itself included. With N values, the estimate is psi(N) + mean psi(k) - mean psi(values of the label) - mean psi(m).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegate.functions.cumulative import RANGE_ROWS, WINDOW_ROWS, row_numbers, running_totals
from framegate.functions.hashing import row_hash, unit_draw
from framegate.functions.longform import melt
from framegate.functions.nulls import col, double_value
from framegate.operators.profiling import numeric_columns
from framegate.session import checkpoint

#: Values of a feature and label whose neighbours are found by one task.
BLOCK_ROWS = 200_000
#: Noise against ties, as a share of the mean size of the values, at least of 1.
NOISE = 1e-10


def digamma(x: Column) -> Column:
    """psi(x) for x >= 1: six steps of its recurrence, then the asymptotic series."""
    x = x.cast("double")
    y = x + 6
    steps = sum((1 / (x + j) for j in range(6)), F.lit(0.0))
    u = 1 / (y * y)
    return F.ln(y) - 1 / (2 * y) - u * (1 / 12 - u * (1 / 120 - u * (1 / 252 - u * (1 / 240 - u * (1 / 132))))) - steps


def neighbour_intervals(values: DataFrame, k: int, block_rows: int = BLOCK_ROWS, **limits) -> DataFrame:
    """(feature, y, place, v, count, r, low, high) of values (feature, y, v): the k-th neighbour of the same label is r away.

    `low` and `high` are v - r and v + r, the neighbour's own value on its side. Values are numbered in their order; a block
    of neighbouring numbers is one task's, with the k values beyond each of its borders copied into it. Values of a label
    with one row have no neighbours and are left out; where a label has k rows or fewer, its farthest one counts.
    """
    counted = values.groupBy("feature", "y").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")
    placed = row_numbers(values, ["feature", "y"], ["v"], **limits).join(counted, ["feature", "y"])
    block, place = F.floor(F.col("place") / block_rows), F.col("place") % block_rows
    copies = F.array_compact(F.array(block, F.when(place < k, block - 1), F.when(place >= block_rows - k, block + 1)))
    dealt = placed.withColumn("own", block).withColumn("block", F.explode(copies))
    order = Window.partitionBy("feature", "y", "block").orderBy("place")
    beside = [f("v", j).over(order).alias(f"{f.__name__}{j}") for f in (F.lag, F.lead) for j in range(1, k + 1)]
    near = dealt.select("feature", "y", "place", "v", "count", "own", "block", *beside).filter("own = block")
    others = [F.struct(F.abs(F.col(n) - F.col("v")).alias("r"), F.col(n).alias("u")) for f in ("lag", "lead") for j in range(1, k + 1) for n in [f"{f}{j}"]]
    nearest = F.array_sort(F.filter(F.array(*others), lambda o: o["u"].isNotNull()))
    near = near.withColumn("o", F.get(nearest, (F.least(F.lit(k), F.col("count") - 1) - 1).cast("int")))
    u, v, r = F.col("o.u"), F.col("v"), F.col("o.r")
    return near.select("feature", "y", "place", "v", "count", r.alias("r"), F.when(u < v, u).otherwise(v - r).alias("low"), F.when(u > v, u).otherwise(v + r).alias("high"))


def values_inside(found: DataFrame, **limits) -> DataFrame:
    """`m` for each row of `neighbour_intervals`: how many values of its feature are closer than r, or equal if r is 0.

    Ends of intervals are sorted among the values, and running totals of the values tell how many lie before each end. An
    end comes after the values that it equals if they count as before it.
    """
    event = lambda v, kind, side, n: found.select(
        "feature", F.struct(v.alias("v"), kind.alias("kind"), F.col("y"), F.col("place"), F.lit(side).alias("side")).alias("o"), F.lit(n).cast("long").alias("n")
    )
    same = F.col("r") == 0
    before, after = F.lit(0), F.lit(2)
    values = event(F.col("v"), F.lit(1), 0, 1)
    lows = event(F.col("low"), F.when(same, before).otherwise(after), 1, 0)
    highs = event(F.col("high"), F.when(same, after).otherwise(before), 2, 0)
    totals = running_totals(values.unionAll(lows).unionAll(highs), "o", ["n"], groups=["feature"], **limits).filter("o.side > 0")
    signed = F.when(F.col("o.side") == 2, F.col("n_before")).otherwise(-F.col("n_before"))
    return totals.groupBy("feature", F.col("o.y").alias("y"), F.col("o.place").alias("place")).agg(F.sum(signed).alias("m"))


def neighbour_mutual_information(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, keys: Sequence[str] = (), k: int = 3, seed: int = 42, portable: bool = False,
    block_rows: int = BLOCK_ROWS, window_rows: int = WINDOW_ROWS, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """(feature, score): mutual information of each number with the label in nats, best first, 0 at least.

    Values are divided by their deviation, and noise of a share of 1e-10 keeps equal ones apart; it is drawn by a hash of
    `keys` (all columns where none are given) and the feature, evenly instead of normally. Rows without the feature or the
    label do not count, nor do labels with a single row; a feature without any value has no score. `portable` draws with
    MD5, which other engines can reproduce.
    """
    columns = list(columns or numeric_columns(df, [target]))
    keys = list(keys) or df.columns
    ids = {"y": col(target), **{f"key{j}": col(c).cast("string") for j, c in enumerate(keys)}}
    long = melt(df, {c: double_value(df, c) for c in columns}, ids=ids).filter("value is not null and y is not null")
    scales = long.groupBy("feature").agg(F.stddev_pop("value").alias("s"), F.avg(F.abs("value")).alias("size"))
    scale = F.when(F.col("s") > 0, F.col("s")).otherwise(1.0)
    # one row a column
    scaled = long.join(F.broadcast(scales), "feature").withColumn("u", unit_draw(row_hash([*(f"key{j}" for j in range(len(keys))), "feature"], seed, portable)))
    noise = NOISE * F.greatest(F.lit(1.0), F.col("size") / scale) * (2 * F.col("u") - 1)
    limits = {"window_rows": window_rows, "range_rows": range_rows}
    found = checkpoint(neighbour_intervals(scaled.select("feature", "y", (F.col("value") / scale + noise).alias("v")), k, block_rows, **limits))
    near = values_inside(found, **limits).groupBy("feature").agg(F.avg(digamma(F.col("m"))).alias("near"))
    rest = F.avg(digamma(F.least(F.lit(k), F.col("count") - 1)) - digamma(F.col("count")))
    own = found.groupBy("feature").agg((digamma(F.count(F.lit(1))) + rest).alias("own"))
    return own.join(near, "feature").select("feature", F.greatest(F.col("own") - F.col("near"), F.lit(0.0)).alias("score")).orderBy(F.desc("score"), "feature")
