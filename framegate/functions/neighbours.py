"""Exact k nearest neighbours inside one table of points.

A point has a unique key, a vector, and a number of copies, so however many rows are equal they are one point here.
Neighbours are ranked by distance, then key, and both ways of searching rank alike. Points of a proven small total size
are compared in numpy against a broadcast matrix. Beyond that the points are cut into shards around pivots: every point
searches its own shard, and its k-th distance then tells which other shards can still hold a nearer point. Only those
are searched, each by bounded groups, so the answer stays exact at any size. Two lower bounds exclude shards: the
triangle inequality around pivots, and the distance to the box that a shard's points fill on a few orthogonal axes (the
directions in which a sample of points varies most), with the length of what the axes leave over as one more side. The
box still excludes where features are many and related and distances to pivots are all alike; where every direction
varies as much as every other, neither does.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegate.functions.longform import scalar_struct
from framegate.session import checkpoint

# The functions below travel to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Points that may be sent to every executor, and numbers they may hold together (40 MB).
BROADCAST_POINTS = 50_000
BROADCAST_NUMBERS = 5_000_000
# Pivots are drawn from the points, so dense regions get more of them and shards stay even.
MAX_PIVOTS = 65_536
SHARD_POINTS = 20_000
# Tasks that shards are dealt out to.
MAX_SHARD_TASKS = 2_000
# Directions of the boxes, and points that they are taken from. Any directions keep the answer exact.
AXES = 8
AXIS_POINTS = 4_096
PAIR_BLOCK = 2_000_000
# Pairs that a task compares, about: a small table of points is one task's worth of bytes, but not of pairs.
TASK_PAIRS = 100_000_000

RESULT = "key bigint, vec array<double>, n bigint, near array<array<double>>"
# `squared` is the squared distance, `copies` how often the other point is there.
CANDIDATE = "key bigint, squared double, other bigint, other_vec array<double>, copies bigint"


def nearest_neighbours(
    points: DataFrame, k: int, *, broadcast_points: int = BROADCAST_POINTS, shard_points: int = SHARD_POINTS, axes: int = AXES
) -> DataFrame:
    """(key, vec, n) to (key, vec, n, near): the vectors of the k nearest other rows, nearest first.

    A point that is there n times has its n - 1 copies as nearest neighbours; without a column n it is there once.
    """
    if "n" not in points.columns:
        points = points.withColumn("n", F.lit(1).cast("bigint"))
    size = points.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("rows"), F.max(F.size("vec")).alias("d")).first()
    if (size["rows"] or 0) <= k:
        raise ValueError(f"{k} neighbours need more than {k} points, got {size['rows'] or 0}")
    if size["n"] <= broadcast_points and size["n"] * size["d"] <= BROADCAST_NUMBERS:
        return _by_broadcast(points, k)
    return _by_shards(points, k, size["n"], shard_points, axes)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in vectors])


def _search(queries: np.ndarray, query_keys: np.ndarray, data: np.ndarray, keys: np.ndarray, k: int):
    """(query, row, squared distance) of the k nearest rows with another key, by query, distance and key; in bounded blocks."""
    step = max(1, PAIR_BLOCK // max(1, len(data)))
    for start in range(0, len(queries), step):
        q = queries[start : start + step]
        squared = np.zeros((len(q), len(data)))
        for j in range(data.shape[1]):
            squared += (q[:, j, None] - data[None, :, j]) ** 2
        squared[query_keys[start : start + step, None] == keys[None, :]] = np.inf
        last = np.partition(squared, min(k, len(data)) - 1, axis=1)[:, min(k, len(data)) - 1]
        row, col = np.nonzero((squared <= last[:, None]) & np.isfinite(squared))
        d = squared[row, col]
        order = np.lexsort((keys[col], d, row))
        row, col, d = row[order], col[order], d[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        yield start + row[place < k], col[place < k], d[place < k]


def _by_broadcast(points: DataFrame, k: int) -> DataFrame:
    rows = points.select("key", "vec", "n").orderBy("key").collect()
    keys, copies = (np.array([r[c] for r in rows], dtype=np.int64) for c in ("key", "n"))
    shared = points.sparkSession.sparkContext.broadcast((keys, copies, np.array([r["vec"] for r in rows], dtype=float)))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_keys, copies, data = shared.value
        for batch in batches:
            if not len(batch):
                continue
            near: list[list] = [[v] * min(k, n - 1) for v, n in zip(batch["vec"], batch["n"])]
            for query, found, _ in _search(_matrix(batch["vec"]), batch["key"].to_numpy(), data, all_keys, k):
                for i, j in zip(query.tolist(), found.tolist()):
                    near[i] += [data[j].tolist()] * min(int(copies[j]), k - len(near[i]))
            yield batch.assign(near=near)

    dealt = points.select("key", "vec", "n").repartition(1 + len(keys) ** 2 // TASK_PAIRS, "key")
    return dealt.mapInPandas(search, RESULT)


def probes_per_point(points: DataFrame, k: int, *, shard_points: int = SHARD_POINTS, axes: int = AXES) -> DataFrame:
    """(points, shards, probes): what the search by shards costs. `probes` is the mean of other shards a point is sent to."""
    points = points if "n" in points.columns else points.withColumn("n", F.lit(1).cast("bigint"))
    n = points.count()
    _, sharded, _, probes = _probes(points, k, n, shard_points, axes)
    shards = sharded.agg(F.count_distinct("cell", "shard").alias("shards"))
    return shards.select(
        F.lit(n).cast("bigint").alias("points"), "shards", (scalar_struct(probes.agg(F.count(F.lit(1)).alias("n")))["n"] / max(1, n)).alias("probes")
    )


def _directions(sample: np.ndarray, axes: int) -> np.ndarray:
    """Orthonormal columns along which the sample varies most."""
    centred = sample - sample.mean(axis=0)
    if not axes or not np.isfinite(centred).all():
        return np.zeros((sample.shape[1], 0))
    _, spread, rows = np.linalg.svd(centred, full_matrices=False)
    return rows[: min(axes, int((spread > 0).sum()))].T


def _probes(points: DataFrame, k: int, n: int, shard_points: int, axes: int):
    """(celled, sharded, own, probes): points with their cell, and shard; neighbours inside the own shard; other shards to search."""
    pivots = min(MAX_PIVOTS, max(1, math.ceil(n / shard_points)))
    drawn = points.orderBy(F.xxhash64("key"), "key").limit(max(pivots, AXIS_POINTS)).select("vec").collect()
    sample = np.array([r["vec"] for r in drawn], dtype=float)
    middle, turn = sample.mean(axis=0), _directions(sample, axes)
    centres = points.sparkSession.sparkContext.broadcast((sample[:pivots], middle, turn))

    def distances(vectors: pd.Series) -> Iterator[tuple[slice, np.ndarray]]:
        """Distances to all pivots, a block of rows at a time."""
        x, pivot = _matrix(vectors), centres.value[0]
        step = max(1, PAIR_BLOCK // len(pivot))
        for start in range(0, len(x), step):
            block = slice(start, start + step)
            squared = np.zeros((len(x[block]), len(pivot)))
            for j in range(x.shape[1]):
                squared += (x[block, j, None] - pivot[None, :, j]) ** 2
            yield block, np.sqrt(squared)

    def places(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates on the axes and the length of the rest; the length of the whole vector."""
        _, middle, turn = centres.value
        x = _matrix(vectors) - middle
        on = x @ turn
        rest = np.sqrt(((x - on @ turn.T) ** 2).sum(axis=1))
        return np.column_stack([on, rest]), np.sqrt((x**2).sum(axis=1))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            place, length = places(batch["vec"])
            for block, d in distances(batch["vec"]):
                cell = d.argmin(axis=1)
                found = batch.iloc[block].assign(cell=cell.astype("int32"), gap=d[np.arange(len(d)), cell], length=length[block])
                yield found.assign(place=list(place[block]))

    schema = "key bigint, vec array<double>, n bigint, cell int, gap double, length double, place array<double>"
    placed = checkpoint(points.select("key", "vec", "n").mapInPandas(assign, schema))
    sides = range(turn.shape[1] + 1)
    ends = [f(F.col("place")[i]).alias(f"{name}{i}") for i in sides for name, f in (("low", F.min), ("high", F.max))]
    measured = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius"), F.max("length").alias("length"), *ends)
    # At most MAX_PIVOTS rows of 2 * AXES + 6 numbers.
    cells = {r["cell"]: r for r in measured.collect()}
    celled = placed.drop("length", "place")
    shards = {c: math.ceil(r["n"] / shard_points) for c, r in cells.items()}
    # At most MAX_PIVOTS rows of two integers.
    per_cell = F.broadcast(points.sparkSession.createDataFrame(list(shards.items()), "cell int, parts int"))
    sharded = celled.join(per_cell, "cell").withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "key"), F.col("parts")).cast("int")).drop("parts")

    def within(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        return _candidates(group, group, k)

    # Bytes are few and pairs are many here, so shards are dealt out by number; a shard is as many pairs whatever its bytes.
    dealt = sharded.repartition(min(MAX_SHARD_TASKS, max(1, sum(shards.values()))), "cell", "shard")
    own = checkpoint(dealt.groupBy("cell", "shard").applyInPandas(within, CANDIDATE))
    reach = own.groupBy("key").agg(F.count(F.lit(1)).alias("found"), F.sqrt(F.max("squared")).alias("d")).select(
        "key", F.when(F.col("found") >= k, F.col("d")).otherwise(F.lit(float("inf"))).alias("reach")
    )
    known = sharded.join(reach, "key", "left").fillna(float("inf"), ["reach"])
    column = lambda name: np.array([cells[c][name] for c in sorted(cells)], dtype=float)
    order, parts = np.array(sorted(shards)), np.array([shards[c] for c in sorted(shards)])
    boxes = points.sparkSession.sparkContext.broadcast(
        (order, parts, column("radius"), column("length"), np.column_stack([column(f"low{i}") for i in sides]), np.column_stack([column(f"high{i}") for i in sides]))
    )

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order, parts, radii, longest, low, high = boxes.value
        for batch in batches:
            if not len(batch):
                continue
            place, length = places(batch["vec"])
            for block, d in distances(batch["vec"]):
                rows = batch.iloc[block]
                around = d[:, order] - radii[None, :]
                squared = np.zeros(around.shape)
                for j in range(place.shape[1]):
                    at = place[block, j, None]
                    squared += np.maximum(0.0, np.maximum(low[None, :, j] - at, at - high[None, :, j])) ** 2
                # A hair of slack keeps rounding, which grows with the numbers, from closing a shard too early.
                reach_ = rows["reach"].to_numpy()[:, None]
                slack = 1e-12 * (1 + length[block, None] + longest[None, :])
                i, j = np.nonzero(np.maximum(around, np.sqrt(squared)) <= reach_ * (1 + 1e-9) + slack)
                point, cell = np.repeat(i, parts[j]), np.repeat(j, parts[j])
                shard = np.concatenate([np.arange(n) for n in parts[j]]) if len(j) else np.array([], dtype=int)
                found = rows.iloc[point][["key", "vec"]].assign(cell=order[cell].astype("int32"), shard=shard.astype("int32"))
                own = (found["cell"].to_numpy() == rows["cell"].to_numpy()[point]) & (shard == rows["shard"].to_numpy()[point])
                yield found[~own]

    probes = checkpoint(known.mapInPandas(probe, "key bigint, vec array<double>, cell int, shard int"))
    return celled, sharded, own, probes


def _by_shards(points: DataFrame, k: int, n: int, shard_points: int, axes: int) -> DataFrame:
    celled, sharded, own, probes = _probes(points, k, n, shard_points, axes)
    # Many points may ask for one shard: their groups are cut, and the shard is copied for each.
    load = probes.groupBy("cell", "shard").agg(F.count(F.lit(1)).alias("asked")).select(
        "cell", "shard", F.ceil(F.col("asked") / shard_points).cast("int").alias("copies")
    )
    load = checkpoint(load)
    asking = probes.join(load, ["cell", "shard"]).withColumn("copy", F.pmod(F.xxhash64(F.lit(11), "key"), F.col("copies")).cast("int"))
    asked = sharded.join(load, ["cell", "shard"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _candidates(left, right.sort_values("key"), k)

    others = (
        asking.groupBy("cell", "shard", "copy")
        .cogroup(asked.groupBy("cell", "shard", "copy"))
        .applyInPandas(across, CANDIDATE)
    )
    nearest = Window.partitionBy("key").orderBy("squared", "other")
    # At most k candidates per searched shard and point.
    best = own.unionByName(others).withColumn("r", F.row_number().over(nearest)).filter(F.col("r") <= k)
    near = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("r", "other_vec", "copies"))).alias("l"))
    same = F.array_repeat("vec", F.least(F.col("n") - 1, F.lit(k)).cast("int"))
    others_of = F.flatten(F.transform("l", lambda x: F.array_repeat(x["other_vec"], F.least(x["copies"], F.lit(k)).cast("int"))))
    return celled.join(near, "key", "left").select(
        "key", "vec", "n", F.slice(F.concat(same, F.coalesce(others_of, F.array())), 1, k).alias("near")
    )


def _candidates(queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    if not len(queries) or not len(data):
        return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("key", "squared", "other", "other_vec", "copies")})
    q_keys, keys, matrix = queries["key"].to_numpy(), data["key"].to_numpy(), _matrix(data["vec"])
    parts = list(_search(_matrix(queries["vec"]), q_keys, matrix, keys, k))
    query, row, squared = (np.concatenate(x) for x in zip(*parts))
    vectors = pd.Series(matrix[row].tolist(), dtype=object)
    return pd.DataFrame({"key": q_keys[query], "squared": squared, "other": keys[row], "other_vec": vectors, "copies": data["n"].to_numpy()[row]})
