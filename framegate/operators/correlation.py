"""Correlation between columns: pairwise complete, one aggregation for all pairs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import CorrelationConfig
from framegate.functions.cumulative import running_totals
from framegate.functions.longform import melt, rows_from, text
from framegate.functions.nulls import col, double_value, numeric_columns
from framegate.functions.status import level
from framegate.session import checkpoint

# Pair aggregates per scan (each keeps six running numbers).
PAIRS_PER_SCAN = 500
PAIR_SCHEMA = "feature_a string, feature_b string, corr double"


def pair_correlation(a: Column, b: Column) -> Column:
    """Pearson over rows where both are present; NULL instead of an error for a constant column."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), r)


# Columns from which on all pairs are summed up together instead of one by one.
WIDE_COLUMNS = 40
# Share of its size below which the spread of a wide table's column over a pair's rows is rounding.
NO_SPREAD = 1e-11


def pearson_pairs(df: DataFrame, columns: Sequence[str], wide_columns: int = WIDE_COLUMNS) -> DataFrame:
    """(feature_a, feature_b, corr) for every pair a before b in column order."""
    values = {c: double_value(df, c) for c in columns}
    if len(columns) >= wide_columns:
        return _wide_pairs(df, values)
    return _pairs(df, list(combinations(columns, 2)), values)


def _wide_pairs(df: DataFrame, values: Mapping[str, Column], mean: Sequence[float] | None = None) -> DataFrame:
    """All pairs in two scans: column means (unless `mean` has them), then sums of products of the centred values.

    A task multiplies its batches as matrices (with a matrix of present values, so each pair counts its own
    complete rows) and hands on one row per pair.
    """
    names = list(values)
    d = len(names)
    table = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    if mean is None:
        mean = table.agg(*[F.coalesce(F.avg(f"v{i}"), F.lit(0.0)).alias(f"v{i}") for i in range(d)]).first()
    centre = [float(m) if math.isfinite(m) else 0.0 for m in mean]

    def sums(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((4, d, d))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - centre if batch.num_rows else np.zeros((0, d))
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            m = there.astype(float)
            total += np.stack([m.T @ m, x.T @ m, x.T @ x, (x * x).T @ m])
        a, b = np.triu_indices(d, 1)
        n, s, xy, q = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (a, b, n[a, b], s[a, b], s[b, a], xy[a, b], q[a, b], q[b, a])], names=["i", "j", "n", "x", "y", "xy", "xx", "yy"]
        )

    fields = "i long, j long, n double, x double, y double, xy double, xx double, yy double"
    summed = table.mapInArrow(sums, fields).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xy", "xx", "yy")])
    spread = lambda c: f"IF(n * {c}{c} - {c} * {c} > {NO_SPREAD} * n * {c}{c}, n * {c}{c} - {c} * {c}, NULL)"
    label = F.array(*[F.lit(c) for c in names])
    return summed.selectExpr("i", "j", f"try_divide(n * xy - x * y, sqrt({spread('x')}) * sqrt({spread('y')})) AS corr").select(
        label[F.col("i").cast("int")].alias("feature_a"), label[F.col("j").cast("int")].alias("feature_b"), "corr"
    )


def _pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], values: Mapping[str, Column]) -> DataFrame:
    if not pairs:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    parts = []
    for start in range(0, len(pairs), PAIRS_PER_SCAN):
        chunk = pairs[start : start + PAIRS_PER_SCAN]
        wide = df.agg(*[pair_correlation(values[a], values[b]).alias(f"r{i}") for i, (a, b) in enumerate(chunk)])
        parts.append(
            rows_from(
                wide,
                [{"feature_a": text(a), "feature_b": text(b), "corr": f"r{i}"} for i, (a, b) in enumerate(chunk)],
            )
        )
    return reduce(DataFrame.unionByName, parts)


# Distinct values of all columns together whose ranks may be sent to every executor (some 20 bytes each).
BROADCAST_RANKS = 1_000_000


def average_ranks(counts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups…, value, rank) from (groups…, value, n): 1-based rank of every distinct value, ties sharing their mean rank."""
    return running_totals(counts, "value", ["n"], groups=groups).select(
        *groups, "value", (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank")
    )


def spearman_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair over the rows where both values are present.

    Columns without missing values share one ranking: the distinct values of all of them are
    counted in one scan and ranked together. Where they are few, counted, each column looks its ranks up
    in a broadcast table; otherwise all values travel in long form, meet their ranks in one join and
    return to their rows in one more exchange. Pairs with missing
    values are ranked on their own complete rows; these are counted per pair of values first, all
    pairs in one scan, so repeated pairs travel once. In joins that are not broadcast, adaptive
    execution splits a hot value.
    """
    sizes = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(double_value(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]
    ).first()
    complete = [c for i, c in enumerate(columns) if sizes[f"n{i}"] == sizes["rows"]]
    gappy = [(a, b) for a, b in combinations(columns, 2) if a not in complete or b not in complete]
    parts = [_gappy_ranks(df, gappy[i : i + PAIRS_PER_SCAN]) for i in range(0, len(gappy), PAIRS_PER_SCAN)]
    if len(complete) > 1:
        parts.append(_complete_ranks(df, complete, sizes["rows"]))
    if not parts:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _complete_ranks(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    values = [double_value(df, c).alias(f"v{i}") for i, c in enumerate(columns)]
    wide = len(columns) >= WIDE_COLUMNS
    kept = df.select(*values)
    numbered = F.posexplode(F.array(*[F.col(f"v{i}") for i in range(len(columns))])).alias("column", "value")
    counts = kept.select(numbered).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranks = checkpoint(average_ranks(counts, ["column"]))
    few = ranks.count() <= BROADCAST_RANKS
    if few and not wide:
        ranked = kept
        for i in range(len(columns)):
            own = ranks.filter(F.col("column") == i).select(F.col("value").alias(f"v{i}"), F.col("rank").alias(f"r{i}"))
            ranked = ranked.join(F.broadcast(own), f"v{i}").drop(f"v{i}")
        return _pairs(ranked, list(combinations(columns, 2)), {c: F.col(f"r{i}") for i, c in enumerate(columns)})
    if few:
        return _looked_up(kept, ranks, columns, n)
    # Rows get a number that must not change when a lost part of them is computed again.
    kept = checkpoint(kept.select(F.monotonically_increasing_id().alias("row"), "*"))
    long = kept.select("row", numbered).join(ranks, ["column", "value"])
    # A list has one entry for each column.
    rows = long.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("column", "rank"))).alias("r"))
    return _wide_pairs(rows, {c: F.col("r")[i]["rank"] for i, c in enumerate(columns)})


def _looked_up(kept: DataFrame, ranks: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """All pairs of complete columns v0, v1, … with few distinct values: rows stay where they are, and each looks its ranks
    up in the sorted values of every column, at most BROADCAST_RANKS in all, that every executor holds."""
    import numpy as np

    table = ranks.select("column", "value", "rank").toPandas().sort_values(["column", "value"])
    own = {int(c): (t["value"].to_numpy(), t["rank"].to_numpy()) for c, t in table.groupby("column")}
    none = (np.zeros(0), np.zeros(0))
    shared = kept.sparkSession.sparkContext.broadcast([own.get(i, none) for i in range(len(columns))])

    def look_up(batches):
        import pyarrow as pa

        for batch in batches:
            found = [rank[np.searchsorted(value, c.to_numpy(zero_copy_only=False))] for (value, rank), c in zip(shared.value, batch.columns)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=batch.schema.names)

    ranked = kept.mapInArrow(look_up, ", ".join(f"v{i} double" for i in range(len(columns))))
    # Ranks of a complete column add up to n (n + 1) / 2, ties or not.
    return _wide_pairs(ranked, {c: F.col(f"v{i}") for i, c in enumerate(columns)}, [(n + 1) / 2] * len(columns))


def _gappy_ranks(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    both = [F.struct(F.lit(i).alias("pair"), double_value(df, a).alias("a"), double_value(df, b).alias("b")) for i, (a, b) in enumerate(pairs)]
    cells = checkpoint(
        df.select(F.inline(F.array(*both))).filter("a is not null and b is not null").groupBy("pair", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    )
    sides = F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("value"), F.col("n").alias("n")) for s in "ab"]))
    counts = cells.select("pair", sides).groupBy("pair", "side", "value").agg(F.sum("n").alias("n"))
    ranks = average_ranks(counts, ["pair", "side"])
    ranked = cells
    for s in "ab":
        own = ranks.filter(F.col("side") == s).select("pair", F.col("value").alias(s), F.col("rank").alias(f"r{s}"))
        ranked = ranked.join(own, ["pair", s])
    n, x, y = F.col("n").cast("double"), F.col("ra"), F.col("rb")
    sums = ranked.groupBy("pair").agg(
        F.sum(n).alias("n"), F.sum(n * x).alias("x"), F.sum(n * y).alias("y"), F.sum(n * x * y).alias("xy"),
        F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"),
    )
    spread = lambda c: f"greatest(n * {c}{c} - {c} * {c}, 0D)"
    corr = f"try_divide(n * xy - x * y, sqrt({spread('x')}) * sqrt({spread('y')}))"
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, feature_a string, feature_b string")
    return names.join(sums, "pair", "left").selectExpr("feature_a", "feature_b", f"{corr} AS corr")


def correlation_pairs(df: DataFrame, cfg: CorrelationConfig = CorrelationConfig()) -> DataFrame:
    columns = numeric_columns(df, cfg.exclude)
    if cfg.method == "pearson":
        return pearson_pairs(df, columns)
    if cfg.method == "spearman":
        return spearman_pairs(df, columns)
    raise ValueError(f"Unknown correlation method: {cfg.method}")


def correlation_matrix(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Square table (feature, one column per feature) from the pair table; empty below two columns."""
    schema = "feature string, " + ", ".join(f"`{c}` double" for c in columns)
    if len(columns) < 2:
        return pairs.sparkSession.createDataFrame([], schema)
    mirrored = pairs.unionByName(
        pairs.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "corr")
    )
    wide = mirrored.groupBy(F.col("feature_a").alias("feature")).agg(
        *[
            F.max(F.when(F.col("feature_b") == c, F.col("corr"))).alias(f"m{i}")
            for i, c in enumerate(columns)
        ]
    )
    diagonal = lambda i, c: F.when(F.col("feature") == c, F.lit(1.0)).otherwise(F.col(f"m{i}")).alias(c)
    return wide.select("feature", *[diagonal(i, c) for i, c in enumerate(columns)])


def high_correlations(pairs: DataFrame, threshold: float) -> DataFrame:
    """(feature_a, feature_b, corr, abs_corr) at or above the threshold, strongest first; may be empty."""
    return (
        pairs.withColumn("abs_corr", F.abs("corr"))
        .filter(F.col("abs_corr") >= threshold)
        .orderBy(F.desc("abs_corr"), "feature_a", "feature_b")
    )


def correlation_gate(df: DataFrame, cfg: CorrelationConfig = CorrelationConfig()) -> DataFrame:
    """One row: status, features used, number of high pairs."""
    columns = numeric_columns(df, cfg.exclude)
    if not cfg.enabled or len(columns) < 2:
        status = "warn" if cfg.enabled else "pass"
        return df.sparkSession.range(1).select(
            F.lit(status).alias("status"), F.lit(0).alias("n_features_used"), F.lit(0).cast("bigint").alias("n_high_corr_pairs")
        )
    high = high_correlations(correlation_pairs(df, cfg), cfg.threshold)
    return high.agg(F.count(F.lit(1)).alias("n")).select(
        level(F.col("n") > 0).alias("status"), F.lit(len(columns)).alias("n_features_used"), F.col("n").alias("n_high_corr_pairs")
    )


def prune_correlated(
    pairs: Mapping[tuple[str, str], float], candidates: Sequence[str], scores: Mapping[str, float], threshold: float
) -> list[str]:
    """Greedy pruning in candidate order over the small pair table.

    Of two kept columns with |corr| at or above the threshold the lower score goes; a tie keeps
    the earlier one. The result is sorted by name.
    """
    keep = dict.fromkeys(candidates, True)
    for a, b in combinations(candidates, 2):
        r = pairs.get((a, b), pairs.get((b, a)))
        if keep[a] and keep[b] and r is not None and abs(r) >= threshold:
            keep[b if scores.get(a, 0.0) >= scores.get(b, 0.0) else a] = False
    return sorted(c for c in candidates if keep[c])


def prune_correlated_features(
    df: DataFrame, candidates: Sequence[str], scores: Mapping[str, float], threshold: float
) -> list[str]:
    present = [c for c in candidates if c in df.columns]
    found = {(r["feature_a"], r["feature_b"]): r["corr"] for r in pearson_pairs(df, present).collect()}
    return prune_correlated(found, present, scores, threshold)
