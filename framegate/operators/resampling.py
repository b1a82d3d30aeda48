"""Class rebalancing of training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.config import SmoteConfig
from framegate.functions.hashing import row_hash, unit_draw
from framegate.functions.neighbours import BROADCAST_POINTS, nearest_neighbours
from framegate.functions.nulls import col
from framegate.functions.quantiles import column_extent, order_statistics


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    rows = df.filter(col(label).isin(0, 1)).groupBy(col(label).cast("int").alias("y")).count().collect()
    return {r["y"]: r["count"] for r in rows}


def smote(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    keys: Sequence[str],
    cfg: SmoteConfig = SmoteConfig(),
    seed: int = 42,
    broadcast_points: int = BROADCAST_POINTS,
) -> DataFrame:
    """(features…, label, synthetic): the rows plus as many minority rows as balance needs (see `synthetic_rows`)."""
    base = df.select(*[col(f).cast("double").alias(f) for f in features], col(label).cast("int").alias(label))
    base = base.withColumn("synthetic", F.lit(False))
    made = synthetic_rows(df, label, features, keys, cfg, seed, broadcast_points)
    return base if made is None else base.unionByName(made)


def synthetic_rows(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    keys: Sequence[str],
    cfg: SmoteConfig = SmoteConfig(),
    seed: int = 42,
    broadcast_points: int = BROADCAST_POINTS,
) -> DataFrame | None:
    """(features…, label, synthetic): as many minority rows as balance needs, or None if it needs none.

    A synthetic row lies on the segment between a minority row and one of its k nearest minority
    rows. Every minority row is the start of the same number of segments, give or take one; the
    neighbour and the position are drawn from the row's hash, so reruns give the same rows. Rows
    are told apart by keys, features and, where these are equal, a number among the copies; keys
    need not be unique.
    """
    counts = class_counts(df, label)
    if not cfg.enabled or len(counts) < 2 or counts[0] == counts[1]:
        return None
    minority = min(counts, key=counts.get)
    have, missing = counts[minority], max(counts.values()) - counts[minority]
    if have <= cfg.k_neighbors:
        raise ValueError(f"Class {minority} has {have} rows; {cfg.k_neighbors} neighbours need more")
    vec = F.array(*[col(f).cast("double") for f in features])
    key = F.xxhash64(F.lit(seed), *[col(k) for k in keys], *[col(f).cast("double") for f in features])
    rows = df.filter(col(label) == minority).select(key.alias("key"), vec.alias("vec"))
    points = rows.groupBy("key").agg(F.any_value("vec").alias("vec"), F.count(F.lit(1)).alias("n"))
    near = nearest_neighbours(points, cfg.k_neighbors, broadcast_points=broadcast_points)
    each, rest = divmod(missing, have)
    numbered = lambda t: t.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    times = F.lit(each) + _first_by_hash(numbered(points.select("key", "n")), rest, seed)
    draws = numbered(near).withColumn("times", times).filter("times > 0").withColumn("j", F.explode(F.sequence(F.lit(1), "times")))
    u = unit_draw(row_hash(["key", "copy", "j"], seed))
    other = F.col("near")[F.pmod(F.xxhash64("key", "copy", "j", F.lit(seed + 1)), F.size("near")).cast("int")]
    mixed = draws.withColumn("other", other).withColumn("u", u).select(
        F.zip_with("vec", "other", lambda a, b: a + F.col("u") * (b - a)).alias("x")
    )
    return mixed.select(
        *[F.col("x")[i].alias(f) for i, f in enumerate(features)],
        F.lit(minority).alias(label),
        F.lit(True).alias("synthetic"),
    )


def _first_by_hash(rows: DataFrame, n: int, seed: int) -> Column:
    """1 for the n rows with the smallest hash, else 0; the cut-off is found by counting."""
    if n == 0:
        return F.lit(0)
    hashed = row_hash(["key", "copy"], seed)
    h = rows.select(hashed.cast("double").alias("h"))
    extent = column_extent(h, ["h"])["h"]
    cut = order_statistics(h, {"h": (extent, {n - 1})})["h"][n - 1]
    return (hashed <= F.lit(int(cut))).cast("int")


def balancing_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Adds a weight that gives both classes the same total."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    w = F.lit(None).cast("double")
    for y, n in counts.items():
        w = F.when(col(label) == y, F.lit(total / (len(counts) * n))).otherwise(w)
    return df.withColumn(weight, w)
