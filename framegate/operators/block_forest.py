"""Importances of a forest over any number of rows, from blocks of bins that are written once.

Spark's forest keeps a number for every row and tree, which for hundreds of trees is many times the table. Here a block of
rows is written as cells: rows of a block that share all bins and the label are one, with their number. A row's draws are not
kept but drawn again, from (seed, tree, block), whenever a level counts its cells; so a level of all trees is one pass over
the blocks, and one line for each tree reaches the driver. Trees grow as `RandomForestClassifier` grows them: Poisson bags,
the square root of the features for a node, Gini impurity, and sister leaves of the same class are one leaf.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.operators.trees import cut_points
from framegate.session import checkpoint

# The functions below travel to the executors by value, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
BLOCK_ROWS = 1 << 20
# Bytes of counts that a task holds; more trees take more passes.
COUNT_BYTES = 64 << 20
MOST_DEPTH = 10

BLOCK = "block bigint, bins binary, y binary, n binary"

# How many rows are drawn at most as often as 0, 1, 2 … times.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def forest_shares(rows: DataFrame, names: Sequence[str], label: str, classes: int, trees: int, depth: int, min_leaf: int, seed: int) -> list[float]:
    """The impurity importance of each of the columns `names` (doubles without nulls) for labels 0, 1, …; they add up to 1."""
    cuts = cut_points(rows, names, BINS)
    blocks = checkpoint(rows.select(*names, F.col(label).cast("int").alias("y")).mapInArrow(_blocks([np.array(c) for c in cuts]), BLOCK))
    made = [_Tree() for _ in range(trees)]
    node_bytes = len(names) * BINS * classes * 8
    for level in range(depth):
        todo = [t for t in range(trees) if made[t].open]
        while todo:
            held, part = 0, []
            while todo and (not part or held + len(made[todo[0]].open) * node_bytes <= COUNT_BYTES):
                held += len(made[todo[0]].open) * node_bytes
                part.append(todo.pop(0))
            counted = blocks.mapInArrow(_counts({t: made[t].routes() for t in part}, len(names), classes, level, seed), "tree int, counts binary")
            find = _splits({t: made[t].open for t in part}, len(names), classes, _used(len(names), trees), min_leaf, seed)
            for r in counted.groupBy("tree").applyInArrow(find, "tree int, splits string").collect():
                made[r["tree"]].grow(json.loads(r["splits"]), level + 1 < depth)
    total = np.zeros(len(names))
    for t in made:
        own = t.gains(len(names))
        if own.sum() > 0:
            total += own / own.sum()
    return (total / total.sum() if total.sum() > 0 else total).tolist()


def _used(features: int, trees: int) -> int:
    return features if trees == 1 else max(1, math.ceil(math.sqrt(features)))


class _Tree:
    """Nodes as columns, the root first; a leaf's `left` is the leaf itself, and no bin exceeds its cut."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.gain, self.best = [0], [BINS], [0], [0.0], [0]
        self.open = [0]

    def routes(self) -> tuple[list[int], list[int], list[int], list[int]]:
        return self.feature, self.cut, self.left, self.open

    def grow(self, splits: Sequence, deeper: bool) -> None:
        born = []
        for node, found in zip(self.open, splits):
            if found is None:
                continue
            feature, cut, gain, sides = found
            self.feature[node], self.cut[node], self.gain[node], self.left[node] = feature, cut, gain, len(self.left)
            for counts in sides:
                if deeper and sum(c > 0 for c in counts) > 1:
                    born.append(len(self.left))
                for column, x in ((self.feature, 0), (self.cut, BINS), (self.gain, 0.0), (self.best, int(np.argmax(counts))), (self.left, len(self.left))):
                    column.append(x)
        self.open = born

    def gains(self, features: int) -> np.ndarray:
        left = list(self.left)
        for node in reversed(range(len(left))):
            a = left[node]
            if a != node and left[a] == a and left[a + 1] == a + 1 and self.best[a] == self.best[a + 1]:
                left[node] = node
        out = np.zeros(features)
        for node, a in enumerate(left):
            if a != node:
                out[self.feature[node]] += self.gain[node]
        return out


def _blocks(cuts: Sequence[np.ndarray]):
    """Rows to blocks of cells, the rows of a cell counted."""

    def block(number: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts, 1)
        key = np.zeros(rows.shape[1], np.int64)
        for k, line in enumerate(rows):
            key = key * 256 + line
            if k % 4 == 3:
                key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        cells = rows[:, first]
        bytes_ = [np.ascontiguousarray(x).tobytes() for x in (cells[:-1], cells[-1], n.astype(np.int32))]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([b], pa.binary()) for b in bytes_)], names=["block", "bins", "y", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            lines = [np.searchsorted(c, v + 0.0, "right").astype(np.uint8) for c, v in zip(cuts, values)]
            parts.append(np.stack([*lines, values[-1].astype(np.uint8)]))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield block(number, parts)
                number, parts, held = number + 1, [], 0
        if held:
            yield block(number, parts)

    return run


def draws(n: np.ndarray, seed: int, tree: int, block: int) -> np.ndarray:
    """How often the rows of each cell are in a tree's bag: the sum of a Poisson draw of mean 1 for each of its `n` rows."""
    own = np.random.default_rng([seed & 0xFFFFFFFF, tree, block])
    out = np.searchsorted(_POISSON, own.random(len(n)), "right")
    more = np.flatnonzero(n > 1)
    out[more] = own.poisson(n[more])
    return out


def _counts(routes: dict[int, tuple], features: int, classes: int, level: int, seed: int):
    """(tree, counts): draws by (open node, feature, bin, class) of the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = BINS * classes
        total = {t: np.zeros((features, len(r[3]) * wide), np.int64) for t, r in routes.items()}
        trees = {}
        for t, (feature, cut, left, open_) in routes.items():
            place = np.full(len(left), -1)
            place[open_] = np.arange(len(open_))
            trees[t] = np.array(feature), np.array(cut), np.array(left), place
        for batch in batches:
            for k in range(batch.num_rows):
                number = batch.column("block")[k].as_py()
                y, n = (np.frombuffer(batch.column(c)[k].as_py(), kind) for c, kind in (("y", np.uint8), ("n", np.int32)))
                bins = np.frombuffer(batch.column("bins")[k].as_py(), np.uint8).reshape(features, len(n))
                flat, lines = bins.ravel(), [b.astype(np.int64) * classes + y for b in bins]
                for t, (feature, cut, left, place) in trees.items():
                    drawn = draws(n, seed, t, number)
                    at = np.flatnonzero(drawn)
                    node = np.zeros(len(at), np.int64)
                    for _ in range(level):
                        node = left[node] + (flat[feature[node] * len(n) + at] > cut[node])
                    c = place[node]
                    some = c >= 0
                    at, start = at[some], c[some] * wide
                    weight = drawn[at].astype(float)
                    for f, line in enumerate(lines):
                        total[t][f] += np.bincount(start + line[at], weight, total[t].shape[1]).astype(np.int64)
        for t, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["tree", "counts"])

    return run


def _splits(opened: dict[int, list[int]], features: int, classes: int, used: int, min_leaf: int, seed: int):
    """The best split of each open node of a tree as JSON: feature, highest bin on the left, gain, and both sides' classes."""

    def run(rows: pa.Table) -> pa.Table:
        tree = rows["tree"][0].as_py()
        nodes = opened[tree]
        counts = sum(np.frombuffer(b.as_py(), np.int64) for b in rows["counts"])
        counts = counts.reshape(features, len(nodes), BINS, classes).astype(float)
        found = [_best(counts[:, k], np.random.default_rng([seed & 0xFFFFFFFF, tree, node, 1]).permutation(features)[:used], min_leaf) for k, node in enumerate(nodes)]
        return pa.table({"tree": pa.array([tree], pa.int32()), "splits": [json.dumps(found)]})

    return run


def _best(counts: np.ndarray, tried: np.ndarray, min_leaf: int) -> list | None:
    all_ = counts[0].sum(0)
    n, best, out = all_.sum(), 0.0, None
    if not n:
        return None
    least = 1e-12 * n
    for f in sorted(tried):
        left = counts[f].cumsum(0)[:-1]
        right = all_ - left
        nl, nr = left.sum(1), right.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left**2).sum(1) / nl + (right**2).sum(1) / nr - (all_**2).sum() / n
        gain[(nl < max(1, min_leaf)) | (nr < max(1, min_leaf))] = -np.inf
        k = int(gain.argmax())
        if gain[k] > max(best, least):
            best, out = float(gain[k]), [int(f), k, float(gain[k]), [left[k].tolist(), right[k].tolist()]]
    return out
