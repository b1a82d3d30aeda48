"""Links between texts by the share of common n-grams: an exact Jaccard join of the sets of n-grams with prefix filtering.

Two sets of a similarity of t or more share an n-gram among the first n - ceil(t n) + 1 of each, in any order that is the
same for all sets. The order is rarest first, so few sets meet at such an n-gram. How often an n-gram occurs is told by a
sketch of all texts: it may take an n-gram for more frequent than it is, which only changes the order.

Equal sets are one set from the beginning. Sets that meet at a prefix n-gram are filtered by three bounds on the number
of n-grams that only one of two sets has:

* length: the difference of their sizes;
* position: n-grams before the place of the first common one are not shared;
* suffix: the n-grams after that place are counted in eight ranges of their value; differences of the counts add up.

What passes is held against a bound on whole sets before any set travels: of 1,024 bits, a set has those that an odd number
of its n-grams name, and two sets differ in no more bits than in n-grams.

Where n-gram sets of a bucket pass, they are gathered around leaders: the first one, and every one that passes with no
leader before it. Pairs of a member and its leader are verified by their whole sets, each pair once. Members of a bucket
that are not connected by then are verified among themselves, across components only, so a large group of near copies
costs about its size, and no pairs of it are ever listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.llm.components import components
from framegate.llm.frames import broadcast_if_small, lists, only, slices, text_bytes, with_text_columns
from framegate.llm.messages import add_sparse, added, sparse
from framegate.llm.words import LOWER, NOT_SPACE, ranges, run_starts, run_values, scan, word_values
from framegate.session import checkpoint

WORDS = 3
#: Least similarity of linked sets, as a fraction.
LEAST = (9, 10)
#: Cells of the sketch of n-gram counts, and cells of a block of it (powers of two). A cell is sent as one byte.
CELL_BITS, BLOCK_BITS = 22, 16
#: A byte of the sketch is this many times the logarithm to base 2 of its count.
LEVELS = 8
#: Ranges of n-gram values in which a suffix is counted.
RANGES = 8
#: Words of 64 parity bits of a set.
PARITY_WORDS = 16
#: Sets of a bucket that are compared in one piece; more are dealt out to pairs of pieces. Below: the same for n-grams of sets to verify.
BUCKET_ROWS = 20_000
#: Sets of a bucket whose pairs are filtered all at once; in larger ones a set at a time.
MATRIX_ROWS = 200
PIECE_GRAMS = 4 << 20


# Sets -----------------------------------------------------------------------------------------


class Sets(NamedTuple):
    """Distinct n-grams of texts: one 64-bit value each, ascending in a text, and where each text's begin (n + 1 places)."""

    value: np.ndarray
    at: np.ndarray


def sets_of(texts: pa.Array, words: int = WORDS) -> Sets:
    """A text of fewer words is one n-gram of all of them, a text without words is empty."""
    data, at = text_bytes(texts)
    data = LOWER[data]
    found = scan(data, at, NOT_SPACE)
    of_word, count = word_values(data, found), found.counts
    start, text = run_starts(found, words)
    values, owner = [run_values(of_word, start, words)[0]], [text]
    for n in range(1, words):
        few = np.flatnonzero(count == n)
        values.append(run_values(of_word, found.first[:-1][few], n)[0])
        owner.append(few)
    value, text = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])] if len(value) else np.zeros(0, bool)
    return Sets(value[new], np.searchsorted(text[new], np.arange(len(count) + 1)))


def digests(sets: Sets) -> np.ndarray:
    """128 bits of each set, as two columns."""
    from xxhash import xxh3_128_digest

    ends = sets.at.tolist()
    return np.frombuffer(b"".join(xxh3_128_digest(sets.value[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])), "<i8").reshape(-1, 2)


def level(count: np.ndarray | int) -> np.ndarray:
    """Counts in steps of a logarithm, as bytes."""
    return np.minimum(255, LEVELS * np.log2(np.maximum(count, 1))).astype(np.uint8)


def levels_of(value: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The level of each n-gram, whose highest bits name its cell."""
    return levels[value >> np.uint64(65 - int(len(levels)).bit_length())]


def prefixes(sets: Sets, levels: np.ndarray, least: tuple[int, int] = LEAST) -> Sets:
    """The n-grams by which each set has to be found, rarest first. Sets too small to be linked with another one have none."""
    size = np.diff(sets.at)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((sets.value, levels_of(sets.value, levels), owner))
    length = size - -(-size * least[0] // least[1]) + 1
    # the next larger set that holds this one must be similar, and so must one of the same size that differs in two
    length[size * least[1] < (size + 1) * least[0]] = 0
    kept = np.r_[0, np.cumsum(length)]
    return Sets(sets.value[order[ranges(sets.at[:-1], length)]], kept)


def parities(value: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """[set, word]: bits that an odd number of n-grams of each of n sets name."""
    out = np.zeros(n * PARITY_WORDS, np.uint64)
    np.bitwise_xor.at(out, owner * PARITY_WORDS + (value & np.uint64(PARITY_WORDS - 1)).astype(np.int64), np.uint64(1) << ((value >> np.uint64(8)) & np.uint64(63)))
    return out.reshape(n, PARITY_WORDS)


def as_binary(rows: np.ndarray) -> pa.Array:
    edge = np.arange(len(rows) + 1, dtype=np.int32) * (8 * PARITY_WORDS)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(edge), pa.py_buffer(np.ascontiguousarray(rows, "<u8"))])


def from_binary(column) -> np.ndarray:
    """The same back, from a binary column or an array of bytes."""
    rows = column.to_pylist() if isinstance(column, pa.Array) else column
    return np.frombuffer(b"".join(rows), "<u8").reshape(-1, PARITY_WORDS) if len(rows) else np.zeros((0, PARITY_WORDS), np.uint64)


def counted(value: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """[set, range]: n-grams of each of n sets in each range of values."""
    of = (value >> np.uint64(61)).astype(np.int64)
    return np.bincount(owner * RANGES + of, minlength=n * RANGES).reshape(n, RANGES)


# Sketch ---------------------------------------------------------------------------------------


def sketch_rows(batches: Iterator[pa.RecordBatch], words: int, cell_bits: int) -> Iterator[pa.RecordBatch]:
    """The counts of a task: a row for each block of the sketch that it has counted in."""
    total = np.zeros(1 << cell_bits, np.uint32)
    for batch in batches:
        texts = batch.column("text")
        for i, j in slices(texts):
            cell, n = np.unique(sets_of(texts.slice(i, j - i), words).value >> np.uint64(64 - cell_bits), return_counts=True)
            total[cell.astype(np.int64)] += n.astype(np.uint32)
    width = 1 << min(BLOCK_BITS, cell_bits)
    for block, own in enumerate(total.reshape(-1, width)):
        if own.any():
            yield pa.RecordBatch.from_pydict({"block": [block], "width": [width], "amount": [int(own.sum())], "cells": [sparse(own)]})


def gram_levels(texts: DataFrame, words: int = WORDS, cell_bits: int = CELL_BITS) -> np.ndarray:
    """The level of the count of every cell; an n-gram's cell is told by its highest bits.

    Tasks count, and their blocks are added up. The driver gets a byte a cell, a fixed size.
    """
    rows = texts.select("text").mapInArrow(lambda batches: sketch_rows(batches, words, cell_bits), "block long, width long, amount long, cells binary")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for width, sent in zip(batch.column("width").to_pylist(), batch.column("cells").to_pylist()):
                total = np.zeros(width, np.int64)
                add_sparse(total, sent)
                out.append(level(total).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["block", "levels"])

    width = 1 << min(BLOCK_BITS, cell_bits)
    out = np.zeros(((1 << cell_bits) // width, width), np.uint8)
    for r in added(rows, ["block"]).mapInArrow(short, "block long, levels binary").collect():
        out[r["block"]] = np.frombuffer(r["levels"], np.uint8)
    return out.ravel()


# Candidates -----------------------------------------------------------------------------------

ENTRY = "key long, node long, size long, place int, left long"


def in_bytes(counts: np.ndarray) -> np.ndarray:
    """Counts in the ranges as one long, a byte each, 255 for more: differences of such counts are none too large."""
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, RANGES).view("<i8").ravel()


def from_bytes(packed: np.ndarray) -> np.ndarray:
    return packed.astype("<i8").view(np.uint8).reshape(-1, RANGES).astype(np.int16)


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each prefix n-gram of (node, size, keys, counts): its place and what the suffix after it holds in each range."""
    for batch in batches:
        keys = batch.column("keys")
        value, at = keys.values.to_numpy()[keys.offsets[0].as_py() : keys.offsets[-1].as_py()], keys.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        many = np.diff(at)
        owner = np.repeat(np.arange(len(many)), many)
        place = np.arange(len(value)) - at[:-1][owner]
        hot = np.zeros((len(value) + 1, RANGES), np.int32)
        hot[np.arange(1, len(value) + 1), (value.view(np.uint64) >> np.uint64(61)).astype(np.int64)] = 1
        upto = np.cumsum(hot, axis=0, dtype=np.int32)
        counts = batch.column("counts").flatten().to_numpy().reshape(-1, RANGES)
        left = in_bytes(counts[owner] - (upto[1:] - upto[at[:-1]][owner]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(value), batch.column("node").take(pa.array(owner)), batch.column("size").take(pa.array(owner)), pa.array(place.astype(np.int32)),
                pa.array(left),
            ],
            names=["key", "node", "size", "place", "left"],
        )


def frequent(batches: Iterator[pa.RecordBatch], levels: np.ndarray, rows: int) -> Iterator[pa.RecordBatch]:
    """Prefix n-grams that may have more than `rows` sets, as the sketch tells. It never takes an n-gram for rarer than it is."""
    for batch in batches:
        value = batch.column("keys").flatten().to_numpy()
        kept = value[levels_of(value.view(np.uint64), levels) >= level(rows)]
        yield pa.RecordBatch.from_arrays([pa.array(kept)], names=["key"])


class Bucket(NamedTuple):
    """Sets that share a prefix n-gram, by size: what the filters look at."""

    node: np.ndarray
    size: np.ndarray
    place: np.ndarray
    left: np.ndarray

    def passes(self, i: int, others: np.ndarray, least: tuple[int, int] = LEAST) -> np.ndarray:
        """Which of `others`, none smaller than i, can be similar to i if this is the first n-gram that they share."""
        most = apart(self.size[i] + self.size[others], least)
        near = (self.size[others] - self.size[i] <= most) & (self.place[i] + self.place[others] <= most)
        some = np.flatnonzero(near)
        gone = self.place[i] + self.place[others[some]] + np.abs(self.left[others[some]] - self.left[i]).sum(axis=1)
        near[some] = gone <= most[some]
        return near


def apart(sizes, least: tuple[int, int] = LEAST):
    """How many n-grams may be in one set only, for similar sets with so many n-grams together: |a|+|b|-2c where c is the least overlap."""
    # c / (s - c) >= p / q  <=>  c >= p s / (p + q)
    return sizes - 2 * -(-sizes * least[0] // (least[0] + least[1]))


def passing(bucket: Bucket, least: tuple[int, int]) -> np.ndarray:
    """[i, j] for i < j: do these sets pass all filters? For buckets of MATRIX_ROWS at most."""
    both = bucket.size[:, None] + bucket.size
    gone = bucket.place[:, None] + bucket.place + np.abs(bucket.left[:, None] - bucket.left).sum(axis=2)
    most = apart(both, least)
    return np.triu((gone <= most) & (bucket.size - bucket.size[:, None] <= most), 1)


def leaders(bucket: Bucket, least: tuple[int, int] = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """For each set the first leader that it passes with, or its own place if it leads, and whether it may pass with yet another one."""
    n = len(bucket.node)
    table = passing(bucket, least) if n <= MATRIX_ROWS else None
    out, free = np.arange(n), np.ones(n, bool)
    for i in range(n):
        if not free[i]:
            continue
        free[i] = False
        if table is None:
            others = np.flatnonzero(free[i + 1 :]) + i + 1
            mine = others[bucket.passes(i, others, least)]
        else:
            mine = np.flatnonzero(table[i] & free)
        out[mine] = i
        free[mine] = False
    if table is None:
        return out, np.ones(n, bool)
    table[out, np.arange(n)] = False
    return out, table.any(axis=0) | table.any(axis=1)


class Chunk(NamedTuple):
    """Rows of several whole groups, sorted by group: the group of each row, its columns, where groups of two rows or more begin and end."""

    g: np.ndarray
    rows: list[np.ndarray]
    opens: np.ndarray
    ends: np.ndarray


def chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[Chunk]:
    """The groups of rows that come sorted by g; a group over several batches is put together."""
    held: list[list[np.ndarray]] = []

    def cut(last: bool) -> Chunk:
        rows = [np.concatenate(parts) for parts in zip(*held)]
        g = rows[0]
        end = len(g) if last else int(np.searchsorted(g, g[-1]))
        held[:] = [] if last else [[r[end:] for r in rows]]
        opens = np.flatnonzero(np.r_[True, g[1:end] != g[: end - 1]])
        ends = np.r_[opens[1:], end]
        several = ends - opens > 1
        return Chunk(g[:end], [r[:end] for r in rows[1:]], opens[several], ends[several])

    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", *columns)])
            if held[0][0][0] != held[-1][0][-1]:
                yield cut(False)
    if held:
        yield cut(True)


FOUND = "g long, node long, size long, place int, left long, leader long, rest boolean"


def around_leaders(batches: Iterator[pa.RecordBatch], least: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Members of buckets that pass with others, each with its leader. `rest`: may it pass with more than its leader?"""
    for chunk in chunks(batches, ("node", "size", "place", "left")):
        node, size, place, packed = chunk.rows
        left = from_bytes(packed)
        row, leader, rest = [], [], []
        # most buckets have two sets: all of these at once
        two = chunk.opens[chunk.ends - chunk.opens == 2]
        gone = place[two] + place[two + 1] + np.abs(left[two] - left[two + 1]).sum(axis=1)
        most = apart(size[two] + size[two + 1], least)
        two = two[(gone <= most) & (np.abs(size[two] - size[two + 1]) <= most)]
        row += [two, two + 1]
        leader += [two, two]
        rest += [np.zeros(2 * len(two), bool)]
        for a, b in zip(chunk.opens.tolist(), chunk.ends.tolist()):
            if b - a > 2:
                own = a + np.lexsort((node[a:b], size[a:b]))
                first, more = leaders(Bucket(node[own], size[own], place[own], left[own]), least)
                kept = np.flatnonzero(more | (np.bincount(first, minlength=b - a)[first] > 1))
                row.append(own[kept])
                leader.append(own[first[kept]])
                rest.append(more[kept])
        row, leader = np.concatenate(row), np.concatenate(leader)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chunk.g[row]), pa.array(node[row]), pa.array(size[row]), pa.array(place[row]), pa.array(packed[row]),
                pa.array(node[leader]), pa.array(np.concatenate(rest)),
            ],
            names=["g", "node", "size", "place", "left", "leader", "rest"],
        )


def across(batches: Iterator[pa.RecordBatch], least: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(g, node, root): members of buckets that pass with one of another component which isn't their leader.

    g is made of the members, so buckets of the same members give the same rows.
    """
    from xxhash import xxh64_intdigest

    for chunk in chunks(batches, ("node", "size", "place", "left", "leader", "root", "bits")):
        group, row, parity = [], [], from_binary(chunk.rows[6])
        for a, b in zip(chunk.opens.tolist(), chunk.ends.tolist()):
            if (chunk.rows[5][a:b] == chunk.rows[5][a]).all():
                continue
            own = a + np.lexsort((chunk.rows[0][a:b], chunk.rows[1][a:b]))
            node, size, place, left, leader, root = (r[own] for r in chunk.rows[:6])
            bits = parity[own]
            bucket, wanted = Bucket(node, size, place, from_bytes(left)), np.zeros(len(node), bool)
            for i in range(len(node) - 1):
                others = np.flatnonzero((root[i + 1 :] != root[i]) & (leader[i + 1 :] != node[i])) + i + 1
                mine = others[bucket.passes(i, others, least)]
                mine = mine[np.bitwise_count(bits[i] ^ bits[mine]).sum(axis=1) <= apart(size[i] + size[mine], least)]
                wanted[mine] = True
                wanted[i] |= len(mine) > 0
            if wanted.any():
                own = own[wanted]
                group.append(np.full(len(own), xxh64_intdigest(np.sort(chunk.rows[0][own]).tobytes()), np.uint64).view(np.int64))
                row.append(own)
        if row:
            row = np.concatenate(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(group)), pa.array(chunk.rows[0][row]), pa.array(chunk.rows[5][row])], names=["g", "node", "root"])


# Verification ---------------------------------------------------------------------------------


def similar(common, a, b, least: tuple[int, int] = LEAST):
    """Whether two sets of a and b n-grams, of which `common` are shared, are linked."""
    return common * least[1] >= (a + b - common) * least[0]


def near_pairs(batches: Iterator[pa.RecordBatch], least: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose parity bits don't differ in more places than similar sets may have n-grams of their own."""
    for batch in batches:
        sizes = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
        gone = np.bitwise_count(from_binary(batch.column("bits_a")) ^ from_binary(batch.column("bits_b"))).sum(axis=1)
        kept = batch.filter(pa.array(gone <= apart(sizes, least)))
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])


def pair_links(batches: Iterator[pa.RecordBatch], least: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) that are linked, by their whole sets: rows (a, b, side, held) sorted by the first three, maybe several of a side."""
    pair, one, done = None, None, False
    for batch in batches:
        found = []
        for i, (*own, side) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "side")))):
            if own != pair:
                pair, one, done = own, None, False
            if done or (side == 0 and one is not None):
                continue
            held = batch.column("held")[i].values.to_numpy()
            if side == 0:
                one = held
            elif one is not None:
                done = True
                if similar(len(np.intersect1d(one, held, assume_unique=True)), len(one), len(held), least):
                    found.append(own)
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def group_links(root: np.ndarray, value: np.ndarray, at: np.ndarray, least: tuple[int, int] = LEAST) -> list[tuple[int, int]]:
    """(i, j) of linked sets, enough of them to connect all that are; equal roots are connected already."""
    label = np.unique(root, return_inverse=True)[1]
    number = np.unique(value, return_inverse=True)[1]
    has = np.zeros(int(number.max()) + 1 if len(number) else 0, bool)
    size, out = np.diff(at), []
    for i in range(len(size) - 1):
        after = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(after):
            continue
        own = number[at[i] : at[i + 1]]
        has[own] = True
        common = np.add.reduceat(has[number[at[i + 1] :]], at[i + 1 : -1] - at[i + 1], dtype=np.int64)
        has[own] = False
        for j in after[similar(common[after - i - 1], size[i], size[after], least)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((i, j))
    return out


def groups_links(batches: Iterator[pa.RecordBatch], least: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Links within groups of rows (g, node, root, held), which come sorted by g; a node that comes again is left out."""

    def found(group: dict[int, tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if len(group) > 1:
            nodes, sets = list(group), [held for _, held in group.values()]
            got = group_links(np.array([root for root, _ in group.values()], np.int64), np.concatenate(sets), np.cumsum([0, *map(len, sets)]), least)
            if got:
                a, b = (pa.array([nodes[k] for k in side], pa.int64()) for side in zip(*got))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    last, group = None, {}
    for batch in batches:
        for i, (g, node, root) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("g", "node", "root")))):
            if g != last:
                yield from found(group)
                last, group = g, {}
            if node not in group:
                group[node] = root, batch.column("held")[i].values.to_numpy()
    yield from found(group)


def dealt(rows: DataFrame, by: str, pieces: DataFrame) -> DataFrame:
    """`rows` with `g`: one group for each value of `by`, or for each pair of its `pieces` (by, k), dealt out by a hash of the node."""
    k = F.coalesce("k", F.lit(1))
    return (
        rows.join(pieces, by, "left")
        .withColumn("own_", F.when(k > 1, F.pmod(F.xxhash64("node"), k)).otherwise(0).cast("int"))
        .withColumn("other_", F.explode(F.sequence(F.lit(0), k - 1)))
        .withColumn("g", F.when(k > 1, F.xxhash64(by, F.least("own_", "other_"), F.greatest("own_", "other_"))).otherwise(F.col(by)))
        .drop("own_", "other_", "k")
    )


# Operator -------------------------------------------------------------------------------------


def links(
    sets: DataFrame, texts: DataFrame, levels: np.ndarray, words: int = WORDS, least: tuple[int, int] = LEAST, bucket_rows: int = BUCKET_ROWS,
    piece: int = PIECE_GRAMS,
) -> DataFrame:
    """(a, b): links that connect exactly the nodes whose sets are connected by similar ones.

    `sets` has node, high, low, id (of one of its texts), size, keys, counts and bits; `texts` has doc_id and text.
    """
    fronts = sets.filter(F.size("keys") > 0)
    sent = sets.sparkSession.sparkContext.broadcast(levels)
    often = fronts.select("keys").mapInArrow(lambda batches: frequent(batches, sent.value, bucket_rows), "key long")
    pieces = often.groupBy("key").count().filter(F.col("count") > bucket_rows).select("key", F.ceil(F.col("count") / bucket_rows).cast("int").alias("k"))
    buckets = dealt(fronts.select("node", "size", "keys", "counts").mapInArrow(entries, ENTRY), "key", pieces).select("g", "node", "size", "place", "left")
    found = checkpoint(buckets.repartition("g").sortWithinPartitions("g").mapInArrow(lambda b: around_leaders(b, least), FOUND))

    met = found.filter("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    for side in ("a", "b"):
        met = met.join(sets.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    pairs = checkpoint(met.mapInArrow(lambda b: near_pairs(b, least), "a long, b long"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("side")), F.struct(F.col("b").alias("node"), F.lit(1).alias("side"))))
    both = with_held(pairs.select("a", "b", sides.alias("s")).select("a", "b", "s.*"), sets, texts, words).select("a", "b", "side", "held")
    first = checkpoint(both.repartition("a", "b").sortWithinPartitions("a", "b", "side").mapInArrow(lambda x: pair_links(x, least), "a long, b long"))

    rooted = found.filter("rest").join(components(first).withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node")).select("g", "node", "size", "place", "left", "leader", "root")
    rooted = rooted.join(sets.select("node", "bits"), "node")
    apart_ = checkpoint(rooted.repartition("g").sortWithinPartitions("g").mapInArrow(lambda b: across(b, least), "g long, node long, root long").distinct())
    weight = apart_.join(sets.select("node", "size"), "node").groupBy("g").agg(F.sum("size").alias("sum"))
    again = weight.filter(F.col("sum") > piece).select(F.col("g").alias("by"), F.ceil(F.col("sum") / piece).cast("int").alias("k"))
    rest = with_held(dealt(apart_.withColumnRenamed("g", "by"), "by", again), sets, texts, words).select("g", "node", "root", "held")
    return first.unionAll(checkpoint(rest.repartition("g").sortWithinPartitions("g").mapInArrow(lambda b: groups_links(b, least), "a long, b long")))


def held_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(high, low, held): the n-grams of the texts of a task, each set once."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        texts = batch.column("text")
        for i, j in slices(texts):
            own = sets_of(texts.slice(i, j - i), words)
            print_ = digests(own)
            new = []
            for k, key in enumerate(map(tuple, print_.tolist())):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            held = lists(pa.array(own.value.view(np.int64)), own.at).take(pa.array(new, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(print_[new, 0]), pa.array(print_[new, 1]), held], names=["high", "low", "held"])


def with_held(rows: DataFrame, sets: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """`rows` (node, …) with `held`, the set of the node, from the texts. A set can come several times, but once a task."""
    named = checkpoint(rows.join(sets.select("node", "high", "low", "id"), "node"))
    ids = broadcast_if_small(checkpoint(named.select("id").distinct()))
    # a set's text is found by its id; where ids repeat or are null, others come along
    wanted = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").select("text")
    held = wanted.mapInArrow(lambda batches: held_sets(batches, words), "high long, low long, held array<long>")
    return held.join(broadcast_if_small(named), ["high", "low"])


def with_sets(texts: DataFrame, levels: np.ndarray, words: int, least: tuple[int, int]) -> DataFrame:
    """doc_id, high and low (128 bits of the set), size, keys (the prefix), counts (n-grams in each range) and bits (parities) of each text."""
    sent = texts.sparkSession.sparkContext.broadcast(levels)

    def make():
        levels = sent.value

        def compute(column: pa.Array) -> dict[str, pa.Array]:
            own = sets_of(column, words)
            size, print_, front = np.diff(own.at), digests(own), prefixes(own, levels, least)
            owner = np.repeat(np.arange(len(size)), size)
            counts, bits = counted(own.value, owner, len(size)), parities(own.value, owner, len(size))
            return {
                "bits": as_binary(bits),
                "high": pa.array(print_[:, 0]), "low": pa.array(print_[:, 1]), "size": pa.array(size.astype(np.int64)),
                "keys": lists(pa.array(front.value.view(np.int64)), front.at), "counts": lists(pa.array(counts.astype(np.int32).ravel()), np.arange(len(size) + 1) * RANGES),
            }

        return compute

    fields = {"bits": "binary", "high": "long", "low": "long", "size": "long", "keys": "array<long>", "counts": "array<int>"}
    return with_text_columns(texts, "text", make, fields, keep_text=False)


def linked(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: tuple[int, int] = LEAST, cell_bits: int = CELL_BITS,
    bucket_rows: int = BUCKET_ROWS, piece: int = PIECE_GRAMS,
) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links, itself included) of every row of `docs`.

    A text's set is its distinct runs of `words` words, A to Z in lower case; a text of fewer words has all of them as one.
    Texts are linked if their sets have a Jaccard similarity of `least` or more; a null text and one without words have no
    set and are linked with nothing. Rows are neither dropped nor merged, and rows that share an id are rows of their own.
    A null id is never the smallest; a component of null ids only has component_id null. An empty table gives an empty one.
    Other columns are not read.
    """
    texts = only(docs, doc_id=id_col, text=text_col)
    levels = gram_levels(texts, words, cell_bits)
    rows = checkpoint(with_sets(texts, levels, words, least))
    unique = rows.filter("size > 0").groupBy("high", "low").agg(
        F.min("doc_id").alias("id"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("counts").alias("counts"),
        F.first("bits").alias("bits"),
    )
    sets = checkpoint(unique.withColumn("node", F.monotonically_increasing_id()))
    roots = components(links(sets, texts, levels, words, least, bucket_rows, piece))
    named = sets.select("node", "high", "low", "id").join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    named = checkpoint(named.select("high", "low", "id", F.coalesce("root", "node").alias("root")))
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    known = named.join(smallest, "root").select("high", "low", "component_id")
    own = rows.select("doc_id", "high", "low", "size")
    return own.filter("size > 0").join(known, ["high", "low"]).select("doc_id", F.col("size").alias("n_shingles"), "component_id").unionAll(
        own.filter("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    )
