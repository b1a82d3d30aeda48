"""Exact order statistics that never gather a column in one place.

Spark's exact `percentile` keeps every distinct value of a column in one aggregation state.
Here a quantile is found by counting: a histogram between the smallest and largest value names
the bin that holds the wanted rank, the next pass looks only inside this bin, and once the bin
holds few rows its values are ranked directly. Each pass is one scan with a map-side combined
count of at most BINS groups per interval, so the cost is a handful of scans and almost no
shuffle at any table size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.functions.longform import summarise
from framegate.functions.nulls import col, double_value

BINS = 2048
# Rows that may be ranked directly, per wanted rank; a proven bound, checked by counting.
DIRECT_ROWS = 20_000
# An interval that still holds more than 1/8 of its rows after a pass is split by rank instead of by value.
SLOW_SHRINK = 8


@dataclass(frozen=True)
class Interval:
    """Rows of `column` in [low, high]; `before` rows are smaller, `rows` lie inside."""

    column: str
    low: float
    high: float
    before: int
    rows: int


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    *,
    direct_rows: int = DIRECT_ROWS,
    bins: int = BINS,
    extent: Mapping[str, Interval] | None = None,
) -> dict[str, list[float | int | None]]:
    """Linearly interpolated quantiles of the non-missing values, per column in the order of `probs`.

    `extent` is what `column_extent` finds, for callers that have it already. Whole numbers that a
    double can't hold are searched by their distance to the smallest one, and given back as integers.
    """
    ranks = lambda n: {c for p in probs for c in _neighbours(n, p)}
    stats = extent if extent is not None else column_extent(df, columns)
    large = [c for c in columns if _beyond_double(df, c, stats[c])]
    if large:
        rest = [c for c in columns if c not in large]
        out = exact_quantiles(df, rest, probs, direct_rows=direct_rows, bins=bins, extent=stats)
        return out | _large_quantiles(df, large, probs, direct_rows, bins)
    wanted = {c: ranks(stats[c].rows) for c in columns if stats[c].rows}
    found = order_statistics(df, {c: (stats[c], r) for c, r in wanted.items()}, direct_rows=direct_rows, bins=bins)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        n = stats[c].rows
        out[c] = [_interpolate(found[c], n, p) if n else None for p in probs]
    return out


def _beyond_double(df: DataFrame, c: str, extent: Interval) -> bool:
    whole = isinstance(df.schema[c].dataType, (T.LongType, T.DecimalType))
    return whole and bool(extent.rows) and max(abs(extent.low), abs(extent.high)) >= 2**53


def _large_quantiles(df, columns, probs, direct_rows, bins):
    ends = df.agg(*[x for i, c in enumerate(columns) for x in (F.min(col(c)).alias(f"a{i}"), F.max(col(c)).alias(f"b{i}"))]).first()
    least = {c: ends[f"a{i}"] for i, c in enumerate(columns)}
    wide = [c for i, c in enumerate(columns) if ends[f"b{i}"] - ends[f"a{i}"] >= 2**53]
    if wide:
        raise ValueError(f"Exact quantiles need a range of values below 2^53: {wide}")
    moved = df.select(*[(col(c) - F.lit(least[c])).cast("double").alias(c) for c in columns])
    found = exact_quantiles(moved, columns, probs, direct_rows=direct_rows, bins=bins)
    whole = lambda x: int(x) if float(x).is_integer() else x
    return {c: [whole(v) + least[c] for v in vs] for c, vs in found.items()}


def column_extent(df: DataFrame, columns: Sequence[str]) -> dict[str, Interval]:
    """Row count, smallest and largest value per column: one scan."""
    if not columns:
        return {}
    table = summarise(
        df,
        columns,
        {
            "n": lambda c: F.count(double_value(df, c)),
            "low": lambda c: F.min(double_value(df, c)),
            "high": lambda c: F.max(double_value(df, c)),
        },
    )
    return {r["feature"]: Interval(r["feature"], r["low"], r["high"], 0, r["n"]) for r in table.collect()}


def order_statistics(
    df: DataFrame,
    targets: Mapping[str, tuple[Interval, set[int]]],
    *,
    direct_rows: int = DIRECT_ROWS,
    bins: int = BINS,
) -> dict[str, dict[int, float]]:
    """Values at the wanted 0-based ranks. Ranks that fall into one interval share its passes."""
    found: dict[str, dict[int, float]] = {c: {} for c in targets}
    open_: dict[Interval, set[int]] = {}
    for c, (interval, ranks) in targets.items():
        _file(open_, found, interval, ranks)
    by_rank: set[Interval] = set()
    while open_:
        answers = _locate(df, open_, by_rank, direct_rows, bins)
        next_open: dict[Interval, set[int]] = {}
        by_rank = set()
        for parent, rank, child in answers:
            _file(next_open, found, child, {rank})
            if child in next_open and child.rows * SLOW_SHRINK > parent.rows:
                by_rank.add(child)
        open_ = next_open
    return found


def _file(open_, found, interval, ranks):
    if interval.low == interval.high:
        found[interval.column].update({r: interval.low for r in ranks})
    else:
        open_.setdefault(interval, set()).update(ranks)


def _locate(df, open_, by_rank, direct_rows, bins):
    """One scan: for every (interval, rank) the sub-interval that holds the rank."""
    intervals = list(open_)
    uneven = [i for i in intervals if i.rows > direct_rows and (i in by_rank or not _even_width(i))]
    splits = _rank_splits(df, uneven)
    # Bounds travel as arrays looked up by interval number, so every pass compiles to the same code.
    at = lambda values: F.array(*[F.lit(x) for x in values])[F.col("i")]
    v = F.col("v")
    # Every column is worked out once; of its values only those inside an open interval become rows.
    names = {c: f"v{k}" for k, c in enumerate(dict.fromkeys(t.column for t in intervals))}
    values = df.select(*[double_value(df, c).alias(n) for c, n in names.items()])
    own = [F.col(names[t.column]) for t in intervals]
    inside = [F.when(x.between(F.lit(t.low), F.lit(t.high)), F.struct(F.lit(i).alias("i"), x.alias("v"))) for i, (x, t) in enumerate(zip(own, intervals))]
    long = values.select(F.inline(F.array_compact(F.array(*inside))))
    scale = [(bins - 1) / (t.high - t.low) if _even_width(t) else 1.0 for t in intervals]
    by_width = F.floor((v - at([t.low for t in intervals])) * at(scale)).cast("double")
    cell = F.when(at([t.rows <= direct_rows for t in intervals]), v).otherwise(by_width)
    if splits:
        cuts = F.array(*[F.array(*[F.lit(float(x)) for x in splits.get(t, [0.0])]) for t in intervals])[F.col("i")]
        cuts_below = F.size(F.filter(cuts, lambda x: x < v)).cast("double")
        cell = F.when(at([t in splits for t in intervals]), cuts_below).otherwise(cell)
    cells = (
        long.groupBy("i", cell.alias("cell"))
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    # At most bins (or direct_rows) cells per interval reach this window.
    upto = Window.partitionBy("i").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cells.withColumn("upto", F.sum("n").over(upto))
    asked = F.array(*[F.array(*[F.lit(r - t.before) for r in sorted(open_[t])]) for t in intervals])[F.col("i")]
    hits = (
        ranked.withColumn("k", F.explode(asked))
        .filter((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("n")))
        .collect()
    )
    out = []
    for h in hits:
        parent = intervals[h["i"]]
        child = Interval(parent.column, h["low"], h["high"], parent.before + h["upto"] - h["n"], h["n"])
        out.append((parent, parent.before + h["k"], child))
    return out


def _even_width(interval: Interval) -> bool:
    width = interval.high - interval.low
    return math.isfinite(width) and width > 0


def _rank_splits(df, intervals, pieces: int = 32):
    """Split points by approximate rank, for values too unevenly spread to split by width."""
    if not intervals:
        return {}
    probs = [k / pieces for k in range(1, pieces)]
    aggs = []
    for i, it in enumerate(intervals):
        v = double_value(df, it.column)
        # Open interval: ties at an end would otherwise draw every split point to themselves.
        inner = F.when((v > F.lit(it.low)) & (v < F.lit(it.high)), v)
        aggs.append(F.percentile_approx(inner, probs, 1000).alias(f"s{i}"))
    row = df.agg(*aggs).first()
    return {
        it: sorted({it.low, *(row[f"s{i}"] or []), math.nextafter(it.high, -math.inf)}) for i, it in enumerate(intervals)
    }


def _neighbours(n: int, p: float) -> tuple[int, int]:
    pos = (n - 1) * p
    return math.floor(pos), math.ceil(pos)


def _interpolate(values: Mapping[int, float], n: int, p: float) -> float:
    pos = (n - 1) * p
    lo, hi = _neighbours(n, p)
    a, b = values[lo], values[hi]
    return a if a == b else a + (b - a) * (pos - lo)


def quantile_frame(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str],
    *,
    method: str = "exact",
    accuracy: int = 10_000,
    key: str = "feature",
    extent: Mapping[str, Interval] | None = None,
) -> DataFrame:
    """(key, one column per prob). `approx` is one lazy scan with a bounded sketch per column."""
    if method == "approx":
        table = summarise(
            df, columns, {"q": lambda c: F.percentile_approx(double_value(df, c), list(probs), accuracy)}, key
        )
        return table.select(key, *[F.col("q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    if method != "exact":
        raise ValueError(f"Unknown quantile method: {method}")
    found = exact_quantiles(df, columns, probs, extent=extent)
    return literal_table(df, key, {c: dict(zip(names, found[c])) for c in columns}, names)


def literal_table(df: DataFrame, key: str, rows: Mapping[str, Mapping[str, float | None]], names: Sequence[str]) -> DataFrame:
    """A small driver-side result (one row per column) as a DataFrame."""
    schema = f"`{key}` string, " + ", ".join(f"`{n}` double" for n in names)
    number = lambda x: None if x is None else float(x)
    return df.sparkSession.createDataFrame([(k, *[number(v[n]) for n in names]) for k, v in rows.items()], schema)

