"""Boosting and forests of a search, each fitted by one task that holds a whole fold as bins.

A fold is written once as bytes: every feature cut into bins, rows in one order. Trials meet folds in a small cross join, so
a search of any number of trials is one job, and trees grow without a job for each of their levels. The models are those of
`GBTClassifier` without sampling and of `trees.BaggedForest`, with the same bins, draws, splits and leaves, and forests as
`RandomForestClassifier` grows them, with draws of their own: Spark's depend on how rows lie in partitions. Boosting adds its
sums up in another order, which can decide between splits of equal gain. Bins come of all rows, where Spark draws a sample of
some 10,000.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The functions below travel to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
# Numbers (rows times features) of a fold that one task may hold.
FOLD_NUMBERS = 1 << 24
# Rows of bags that grow together, and nodes whose cells are counted at once.
CHUNK_ROWS = 1 << 17
SLAB_NODES = 1 << 14

BOOSTING, BALANCED, FOREST = "boosting", "balanced", "forest"

PACKED = "fold int, width int, cuts string, y binary, boosting binary, balanced binary, held_y binary, held_boosting binary, held_balanced binary"
PREDICTED = "trial int, fold int, label int, score double, prediction int"


# Folds as bytes -------------------------------------------------------------------------------


def packed(folds: Sequence[tuple[int, DataFrame, DataFrame]], label: str) -> DataFrame | None:
    """A row of bytes for each (fold, training rows, held-out rows); None if a fold is more than a task should hold, or has
    training labels other than 0 and 1."""
    parts = []
    for fold, train, held in folds:
        for is_held, rows in ((False, train), (True, held)):
            y = F.col(f"`{label}`").cast("double")
            parts.append(rows.select(F.lit(fold).alias("fold"), F.lit(is_held).alias("held"), vector_to_array("features").alias("x"), y.alias("y")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    odd = F.count_if(~F.col("held") & ~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False)))
    sizes = rows.groupBy("fold").agg(F.sum(F.size("x")).alias("numbers"), odd.alias("odd"), F.count_if(~F.col("held")).alias("train")).collect()
    if any(r["odd"] or not r["train"] or r["numbers"] > FOLD_NUMBERS for r in sizes):
        return None
    return rows.groupBy("fold").applyInArrow(_pack, PACKED)


def _pack(rows: pa.Table) -> pa.Table:
    held = rows["held"].to_numpy()
    y = rows["y"].to_numpy().astype(np.float64)  # null is NaN
    flat = rows["x"].combine_chunks()
    x = np.asarray(flat.flatten(), np.float64).reshape(len(y), -1) + 0.0
    train_x, train_y = x[~held], y[~held]
    order = np.lexsort([train_y, *train_x.T[::-1]])
    train_x, train_y = train_x[order], train_y[order]
    held_x, held_y = x[held], y[held]
    boosting = [boosting_cuts(v) for v in train_x.T]
    balanced = [quantile_cuts(v) for v in train_x.T]
    # boosting sends values up to a cut left, the forest values below it
    sides = ((boosting, "left"), (balanced, "right"))
    bins = [
        np.stack([np.searchsorted(cuts, v, side) for cuts, v in zip(own, values.T)]).astype(np.uint8).tobytes()
        for values in (train_x, held_x) for own, side in sides
    ]
    named = json.dumps({BOOSTING: [len(c) for c in boosting], BALANCED: [len(c) for c in balanced]})
    fields = [
        rows["fold"][0].as_py(), x.shape[1], named, train_y.astype(np.uint8).tobytes(), bins[0], bins[1], held_y.tobytes(), bins[2], bins[3],
    ]
    kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 6]
    names = [f.split()[0] for f in PACKED.split(", ")]
    return pa.table({name: pa.array([value], kind) for name, value, kind in zip(names, fields, kinds)})


def boosting_cuts(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Cut points as Spark's trees choose them: halfway between neighbouring values, all of them or about as many rows apart."""
    distinct, counts = np.unique(values, return_counts=True)
    most = min(bins, len(values)) - 1
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) <= most:
        return middle
    stride, upto, cuts = len(values) / (most + 1), np.cumsum(counts), []
    target = stride
    for k in range(1, len(distinct)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            cuts.append(middle[k - 1])
            target += stride
    return np.array(cuts)


def quantile_cuts(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The distinct exact quantiles that `trees.cut_points` finds."""
    ordered, found = np.sort(values), set()
    for k in range(1, bins):
        at = (len(ordered) - 1) * (k / bins)
        a, b = float(ordered[math.floor(at)]), float(ordered[math.ceil(at)])
        found.add(a if a == b else a + (b - a) * (at - math.floor(at)))
    return np.array(sorted(found))


# Trials ---------------------------------------------------------------------------------------


def predictions(folds: DataFrame, trials: Sequence[Mapping[str, object]]) -> DataFrame:
    """(trial, fold, label, score, prediction) of all held-out rows: every trial on every fold of `packed`, a task for each."""
    asked = folds.sparkSession.createDataFrame([(k, json.dumps(dict(t))) for k, t in enumerate(trials)], "trial int, params string")
    pairs = folds.crossJoin(F.broadcast(asked))
    return pairs.repartition(len(trials) * folds.count()).mapInArrow(_fit_all, PREDICTED)


def _fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _fit_one({name: batch.column(name)[k].as_py() for name in batch.schema.names})


def _fit_one(row: Mapping[str, object]) -> pa.RecordBatch:
    params = json.loads(row["params"])
    kind, width = params.pop("kind"), row["width"]
    y, held_y = np.frombuffer(row["y"], np.uint8), np.frombuffer(row["held_y"], np.float64)
    cut = BALANCED if kind == BALANCED else BOOSTING  # Spark's trees share their cut points
    bins = np.frombuffer(row[cut], np.uint8).reshape(width, len(y))
    held = np.frombuffer(row[f"held_{cut}"], np.uint8).reshape(width, len(held_y))
    fit = {BOOSTING: boosted, BALANCED: balanced_forest, FOREST: forest}[kind]
    score, prediction = fit(bins, y, held, json.loads(row["cuts"])[cut], **params)
    n, unknown = len(held_y), np.isnan(held_y)
    columns = [
        pa.array(np.full(n, row["trial"], np.int32)), pa.array(np.full(n, row["fold"], np.int32)),
        pa.array(np.where(unknown, 0, held_y).astype(np.int32), mask=unknown), pa.array(score), pa.array(prediction.astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["trial", "fold", "label", "score", "prediction"])


# Boosting -------------------------------------------------------------------------------------


def boosted(
    bins: np.ndarray, y: np.ndarray, held: np.ndarray, cuts: Sequence[int], trees: int, depth: int, rate: float
) -> tuple[np.ndarray, np.ndarray]:
    """(score, prediction) of the held-out rows by trees on the logistic loss, as `GBTClassifier` grows them."""
    sign = 2.0 * y - 1
    margin, held_margin = np.zeros(len(y)), np.zeros(held.shape[1])
    wanted = sign
    for k in range(trees):
        value, at, held_at = _regression_tree(bins, wanted, held, cuts, depth)
        weight = rate if k else 1.0
        margin += weight * value[at]
        held_margin += weight * value[held_at]
        with np.errstate(over="ignore"):
            wanted = 4 * sign / (1 + np.exp(2 * sign * margin))
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-2 * held_margin)), held_margin > 0


def _regression_tree(bins: np.ndarray, wanted: np.ndarray, held: np.ndarray, cuts: Sequence[int], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the nodes, and the node of each row and each held-out row. Splits lower the variance; a leaf's value is its mean."""
    width, n = bins.shape
    cells = max(cuts, default=0) + 1
    at, held_at = np.zeros(n, np.int64), np.zeros(held.shape[1], np.int64)
    value = np.array([wanted.mean()])
    open_ = np.array([0])
    rows, held_rows = np.arange(n), np.arange(held.shape[1])
    for _ in range(depth):
        place = np.full(len(value), -1)
        place[open_] = np.arange(len(open_))
        c = place[at[rows]]
        rows, c = rows[c >= 0], c[c >= 0]
        g = wanted[rows]
        count, total, squares = (np.bincount(c, w, len(open_)).astype(float) for w in (None, g, g * g))
        best = np.full(len(open_), 1e-14) * squares
        feature, bin_ = np.full(len(open_), -1), np.zeros(len(open_), np.int64)
        left = [np.zeros(len(open_)) for _ in range(3)]
        for f in range(width):
            if not cuts[f]:
                continue
            key = c * cells + bins[f, rows]
            upto = [np.bincount(key, w, len(open_) * cells).reshape(-1, cells)[:, : cuts[f]].cumsum(1, dtype=float) for w in (None, g)]
            rest = count[:, None] - upto[0]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = upto[1] ** 2 / upto[0] + (total[:, None] - upto[1]) ** 2 / rest - (total**2 / count)[:, None]
            gain[(upto[0] < 1) | (rest < 1)] = -np.inf
            k = gain.argmax(1)
            found = gain[np.arange(len(k)), k]
            better = found > best
            best[better], feature[better], bin_[better] = found[better], f, k[better]
            for side, sums in zip(left, upto):
                side[better] = sums[np.arange(len(k)), k][better]
        split = feature >= 0
        if not split.any():
            break
        many, base = int(split.sum()), len(value)
        first = np.full(len(open_), -1)
        first[split] = base + 2 * np.arange(many)
        means = np.stack([left[1][split] / left[0][split], (total - left[1])[split] / (count - left[0])[split]], 1)
        value = np.concatenate([value, means.ravel()])
        goes = split[c]
        rows, c = rows[goes], c[goes]
        at[rows] = first[c] + (bins[feature[c], rows] > bin_[c])
        held_c = place[held_at[held_rows]]
        held_rows, held_c = held_rows[held_c >= 0], held_c[held_c >= 0]
        goes = split[held_c]
        held_rows, held_c = held_rows[goes], held_c[goes]
        held_at[held_rows] = first[held_c] + (held[feature[held_c], held_rows] > bin_[held_c])
        # a node whose rows want the same is a leaf
        sizes, sums, squares = (np.bincount(at[rows] - base, w, 2 * many) for w in (None, wanted[rows], wanted[rows] ** 2))
        open_ = np.arange(base, len(value))[squares / sizes - (sums / sizes) ** 2 >= np.finfo(float).eps]
        if not len(open_):
            break
    return value, at, held_at


# Balanced forests -----------------------------------------------------------------------------

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _hash_int(values, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int, after a seed that may be the hash of the values before it."""
    v = np.asarray(values, np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    return _mixed(_turned((seed + _P5 + np.uint64(4)) ^ (v * _P1), 23) * _P2 + _P3)


def _hash_long(values, seed: np.ndarray) -> np.ndarray:
    v = np.asarray(values, np.int64).astype(np.uint64)
    return _mixed(_turned((seed + _P5 + np.uint64(8)) ^ (_turned(v * _P2, 31) * _P1), 27) * _P1 + _P4)


_START = np.array([42], np.uint64)


def drawn(ids: np.ndarray, seed: int, size: int) -> np.ndarray:
    """The row, of `size`, that each draw of a bag takes; as `trees.balanced_bags` draws."""
    return ((_hash_long(ids, _hash_int([seed], _START)) >> np.uint64(12)) % np.uint64(size)).astype(np.int64)


def balanced_forest(
    bins: np.ndarray, y: np.ndarray, held: np.ndarray, cuts: Sequence[int], trees: int, depth: int, min_leaf: int, min_split: int, features: str, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """(score, prediction) of the held-out rows by trees on balanced bags, as `trees.BaggedForest` grows them."""
    own = [np.flatnonzero(y == k) for k in (0, 1) if (y == k).any()]
    many, width = min(map(len, own)), len(cuts)
    used = max(1, {"sqrt": int(math.sqrt(width)), "log2": int(math.log2(width)) if width else 0, "all": width}[features])

    def bag(t: int) -> tuple[np.ndarray, np.ndarray]:
        rows, n = [], []
        for k, members in enumerate(own):
            ids = np.arange(many, dtype=np.int64) + (t * len(own) + k) * many
            taken = np.bincount(drawn(ids, seed, len(members)), minlength=len(members))
            some = np.flatnonzero(taken)
            rows.append(members[some])
            n.append(taken[some])
        return np.concatenate(rows), np.concatenate(n)

    return _voted(bins, y, held, cuts, bag, trees, many * len(own), depth, min_leaf, min_split, used, seed, False)


def forest(
    bins: np.ndarray, y: np.ndarray, held: np.ndarray, cuts: Sequence[int], trees: int, depth: int, min_leaf: int, features: str, seed: int, bootstrap: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """(score, prediction) of the held-out rows by a forest as `RandomForestClassifier` grows it: every row is in a tree's bag
    as often as a Poisson draw of mean 1 says, and sister leaves of the same class are one leaf."""
    width = len(cuts)
    used = max(1, {"sqrt": math.ceil(math.sqrt(width)), "log2": math.ceil(math.log2(width)) if width else 0, "all": width}[features])

    def bag(t: int) -> tuple[np.ndarray, np.ndarray]:
        n = np.random.default_rng([seed & 0xFFFFFFFF, t]).poisson(1.0, len(y)) if bootstrap else np.ones(len(y), np.int64)
        rows = np.flatnonzero(n)
        return (rows, n[rows]) if len(rows) else (np.zeros(1, np.int64), np.ones(1, np.int64))

    return _voted(bins, y, held, cuts, bag, trees, len(y), depth, min_leaf, 2, used, seed, True)


def _voted(bins, y, held, cuts, bag, trees: int, size: int, depth, min_leaf, min_split, used, seed, merge: bool) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(held.shape[1])
    step = max(1, CHUNK_ROWS // size)
    for start in range(0, trees, step):
        chunk = range(start, min(trees, start + step))
        bags = [bag(t) for t in chunk]
        tree = np.repeat(np.arange(len(chunk)), [len(rows) for rows, _ in bags])
        rows, n = (np.concatenate(c) for c in zip(*bags))
        total += _forest(bins, y, held, cuts, tree, rows, n.astype(float), chunk, depth, min_leaf, min_split, used, seed, merge)
    score = total / trees
    return score, score > 0.5


def _score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num((a * a + b * b) / (a + b))


def _forest(bins, y, held, cuts, tree, rows, n, chunk: range, depth: int, min_leaf: int, min_split: int, used: int, seed: int, merge: bool) -> np.ndarray:
    """Sum of the values of the chunk's trees for each held-out row. Nodes of a tree are numbered as they are made."""
    width, cells, trees = len(cuts), max(cuts, default=0) + 1, len(chunk)
    a_row = n * y[rows]
    b_row = n - a_row
    a0, b0 = np.bincount(tree, a_row, trees), np.bincount(tree, b_row, trees)
    # columns of all nodes of all trees; `own` is a node's number in its tree
    of, own, value = np.arange(trees), np.zeros(trees, np.int64), a0 / (a0 + b0)
    feature, cut, left = np.zeros(trees, np.int64), np.zeros(trees, np.int64), np.full(trees, -1)
    sizes = np.ones(trees, np.int64)
    at, live = tree.copy(), np.arange(len(rows))
    open_, a, b = np.arange(trees), a0, b0
    tree_seed = _hash_int([seed], _START)
    parents = []
    for level in range(depth):
        m = len(open_)
        if not m:
            break
        place = np.full(len(of), -1)
        place[open_] = np.arange(m)
        c = place[at[live]]
        live, c = live[c >= 0], c[c >= 0]
        node_hash = _hash_int(own[open_], _hash_int(of[open_] + chunk.start, tree_seed))
        draws = np.stack([_hash_int(np.full(m, f), node_hash).view(np.int64) for f in range(width)], 1)
        may = draws.argsort(1, kind="stable").argsort(1) < used
        best, by, where = np.full(m, 1e-9), np.full(m, -1), np.zeros(m, np.int64)
        la, lb = np.zeros(m), np.zeros(m)
        for lo in range(0, m, SLAB_NODES):
            hi = min(m, lo + SLAB_NODES)
            inside = slice(None) if m <= SLAB_NODES else (c >= lo) & (c < hi)
            here, cell = live[inside], c[inside] - lo
            sa, sb = a[lo:hi, None], b[lo:hi, None]
            for f in range(width):
                if not cuts[f]:
                    continue
                key = cell * cells + bins[f, rows[here]]
                ca, cb = (np.bincount(key, w[here], (hi - lo) * cells).reshape(-1, cells)[:, : cuts[f]].cumsum(1) for w in (a_row, b_row))
                gain = _score(ca, cb) + _score(sa - ca, sb - cb) - _score(sa, sb)
                sizes_l, sizes_r = ca + cb, sa + sb - ca - cb
                fits = (sizes_l >= min_leaf) & (sizes_l > 0) & (sizes_r >= min_leaf) & (sizes_r > 0) & (sa + sb >= min_split) & may[lo:hi, f, None]
                gain[~fits] = -np.inf
                k = gain.argmax(1)
                line = np.arange(hi - lo)
                found = gain[line, k]
                better = np.flatnonzero(found > best[lo:hi])
                best[lo + better], by[lo + better], where[lo + better] = found[better], f, k[better]
                la[lo + better], lb[lo + better] = ca[better, k[better]], cb[better, k[better]]
        split = np.flatnonzero(by >= 0)
        if not len(split):
            break
        parent = open_[split]
        parents.append(parent)
        born = len(of) + 2 * np.arange(len(split))
        feature[parent], cut[parent], left[parent] = by[split], where[split], born
        # nodes are in the order of their trees, so a split's place among those of its tree numbers its children
        owner = of[parent]
        nth = np.arange(len(split)) - np.searchsorted(owner, owner)
        numbers = sizes[owner] + 2 * nth
        sizes += 2 * np.bincount(owner, minlength=trees)
        sides_a = np.stack([la[split], a[split] - la[split]], 1).ravel()
        sides_b = np.stack([lb[split], b[split] - lb[split]], 1).ravel()
        of, own = np.concatenate([of, np.repeat(owner, 2)]), np.concatenate([own, np.stack([numbers, numbers + 1], 1).ravel()])
        value = np.concatenate([value, sides_a / (sides_a + sides_b)])
        feature, cut, left = (np.concatenate([x, np.full(2 * len(split), fill)]) for x, fill in ((feature, 0), (cut, 0), (left, -1)))
        goes = by[c] >= 0
        live, c = live[goes], c[goes]
        at[live] = left[open_[c]] + (bins[by[c], rows[live]] > where[c])
        again = (sides_a + sides_b >= min_split) & (level + 1 < depth)
        open_ = np.stack([born, born + 1], 1).ravel()[again]
        a, b = sides_a[again], sides_b[again]
    for parent in reversed(parents) if merge else ():
        one, other = left[parent], left[parent] + 1
        same = (left[one] < 0) & (left[other] < 0) & ((value[one] > 0.5) == (value[other] > 0.5))
        left[parent[same]] = -1
    total = np.zeros(held.shape[1])
    everyone = np.arange(held.shape[1])
    for t in range(trees):
        node = np.full(held.shape[1], t)
        moving = everyone
        while len(moving):
            moving = moving[left[node[moving]] >= 0]
            now = node[moving]
            node[moving] = left[now] + (held[feature[now], moving] > cut[now])
        total += value[node]
    return total
