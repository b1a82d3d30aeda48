"""Near duplicates by 64-bit SimHash: fingerprints that differ in at most three bits belong together.

Candidates come from a Gray-order hierarchical index. Bits are cut into five blocks; two fingerprints with at most three
differing bits agree in two whole blocks at least, so ten tables, each with another pair of blocks in front, hold every
link. Rows of a table that agree in front are sorted by their Gray rank; runs of neighbours become nodes that hold the
bits their members share, nodes of nodes hold what those share, and a search adds up differences on the way down and
leaves out whole nodes as soon as they are over three.

Links never leave a task as pairs: each group hands on one row per member that is linked (member, smallest member of its
group), and components are joined by large-star / small-star rounds, all of it on distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.llm.components import components
from framegate.llm.frames import fresh, only, text_bytes, with_text_columns
from framegate.session import checkpoint

SEED = 42
WORDS = 3
MOST_BITS = 3
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
FRONT = 25
#: Children of a node of the index.
FAN = 8
#: Distinct fingerprints of one table that agree in front and are searched in one piece; more are dealt out to pairs of pieces.
GROUP_ROWS = 20_000
#: Comparisons held in memory at a time.
FRONTIER = 1 << 20


# Fingerprints ---------------------------------------------------------------------------------


def simhash(text: bytes, words: int = WORDS, seed: int = SEED) -> tuple[np.ndarray, int]:
    """The 64-bit values of all shingles of a text, repeats included."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # both are ASCII only for bytes
    if not parts:
        return np.zeros(0, np.uint64)
    whole = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxh64_intdigest(whole, seed)], np.uint64)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[:-words].tolist()]
    return np.array([xxh64_intdigest(whole[a:b], seed) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], np.uint64)


def bit_sums(values: np.ndarray, most: int = 1 << 16) -> np.ndarray:
    """How many of the values have bit 0, 1 … 63."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(values), most):
        part = values[i : i + most].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bit by bit: set if it is set in over half of the shingle values. A text without words has 0."""
    values = simhash(text, words)
    if not len(values):
        return 0
    return int(np.packbits(2 * bit_sums(values) > len(values), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, name: str, words: int = WORDS) -> DataFrame:
    """`docs` without the texts, with the fingerprint of each as a signed long."""

    def make():
        def compute(texts: pa.Array) -> dict[str, pa.Array]:
            data, at = text_bytes(texts)
            raw = data.tobytes()
            got = [fingerprint(raw[a:b], words) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            return {name: pa.array(np.array(got, np.uint64).view(np.int64))}

        return compute

    return with_text_columns(docs, text, make, {name: "long"}, keep_text=False)


# Index ----------------------------------------------------------------------------------------


def tables() -> list[list[tuple[int, int]]]:
    """For each table, the blocks (lowest bit, bits) from the highest bits of its key down."""
    found = []
    for front in combinations(range(len(BLOCKS)), 2):
        found.append([BLOCKS[k] for k in (*front, *(k for k in range(len(BLOCKS)) if k not in front))])
    return found


def moved(x, blocks: list[tuple[int, int]]):
    """The bits of a column in the order of `blocks`, as a column expression."""
    out, room = F.lit(0).cast("long"), 64
    for low, bits in blocks:
        room -= bits
        piece = F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(piece, room))
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in Gray order, in which neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """Index over fingerprints in groups; entries are sorted by group and Gray rank."""

    def __init__(self, group: np.ndarray, x: np.ndarray):
        n = len(x)
        opens = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
        place = np.arange(n) - np.repeat(opens, np.diff(np.r_[opens, n]))
        self.x = x
        #: From the entries up: pattern, shared bits, first entry, first child of each node (one more each at the end).
        self.levels = [(x, np.full(n, ~np.uint64(0)), np.arange(n + 1), None)]
        below, step = self.levels[0], 1
        while n and (place >= step).any():
            step *= FAN
            first = np.flatnonzero(place % step == 0)
            kids = np.searchsorted(below[2][:-1], first)
            both, either = np.bitwise_and.reduceat(below[0], kids), np.bitwise_or.reduceat(below[0], kids)
            shared = np.bitwise_and.reduceat(below[1], kids) & ~(both ^ either)
            below = (both & shared, shared, np.r_[first, n], np.r_[kids, len(below[0])])
            self.levels.append(below)

    def pairs(self, most: int = MOST_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All (i, j) with i < j, of one group and at most `most` bits apart, in pieces."""
        top = len(self.levels) - 1
        if top < 1:
            return
        at = self.levels[top][2]
        entries = np.arange(len(self.x))
        todo = [(top, q, np.searchsorted(at, q, "right") - 1, np.zeros(len(q), np.uint8)) for q in np.array_split(entries, len(entries) * FAN // FRONTIER + 1)]
        while todo:
            level, q, node, gone = todo.pop()
            if len(q) * FAN > FRONTIER and len(q) > 1:
                half = len(q) // 2
                todo += [(level, q[:half], node[:half], gone[:half]), (level, q[half:], node[half:], gone[half:])]
                continue
            kids, shared = self.levels[level][3], self.levels[level][1]
            pattern, own, first, _ = self.levels[level - 1]
            count = kids[node + 1] - kids[node]
            k = np.repeat(np.arange(len(q)), count)
            child = np.arange(len(k)) + np.repeat(kids[node] - (np.cumsum(count) - count), count)
            k, child = (a[first[child + 1] - 1 > q[k]] for a in (k, child))
            new = own[child] & ~shared[node[k]]
            gone = gone[k] + np.bitwise_count((self.x[q[k]] ^ pattern[child]) & new)
            near = gone <= most
            q, child, gone = q[k][near], child[near], gone[near]
            if level > 1:
                todo.append((level - 1, q, child, gone))
            elif len(q):
                yield q, child


def joined_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each entry's smallest known partner) after linking a[k] with b[k]."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while not np.array_equal(up := label[label], label):
            label = up
        a, b = a[apart], b[apart]


def group_links(group: np.ndarray, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest linked member) of the original fingerprints `own`, within the groups."""
    order = np.lexsort((gray_rank(x), group))
    group, x, own = group[order], x[order], own[order]
    twin = np.flatnonzero(np.r_[False, group[1:] == group[:-1]] | np.r_[group[1:] == group[:-1], False]) if len(x) else []
    group, x, own = group[twin], x[twin], own[twin]
    label = np.arange(len(x))
    for a, b in GrayIndex(group, x).pairs():
        label = joined_labels(label, a, b)
    member = np.flatnonzero(label != np.arange(len(label)))
    return own[member], own[label[member]]


def links(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that join exactly the distinct fingerprints `print` that can be reached by steps of three bits.

    A group of more than `group_rows` fingerprints that agree in front is cut into k pieces by a hash; each of the
    k(k + 1)/2 pairs of pieces is searched on its own, so no task holds more than two pieces.
    """
    entries = prints.select(
        "print", F.explode(F.array(*(F.struct(F.lit(t).alias("t"), moved(F.col("print"), b).alias("x")) for t, b in enumerate(tables())))).alias("e")
    ).select("print", "e.x", F.col("e.t").cast("long").bitwiseOR(F.shiftleft(F.shiftrightunsigned("e.x", 64 - FRONT), 4)).alias("front"))
    pieces = entries.groupBy("front").count().filter(F.col("count") > group_rows).select("front", F.ceil(F.col("count") / group_rows).cast("int").alias("k"))
    k = F.coalesce("k", F.lit(1))
    own = F.when(k > 1, F.pmod(F.xxhash64("print"), k)).otherwise(0).cast("int")
    dealt = (
        entries.join(pieces, "front", "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
        .select("print", "x", F.xxhash64("front", F.least("own", "other"), F.greatest("own", "other")).alias("g"))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = group_links(rows[0], rows[1].view(np.uint64), rows[2])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "x", "print")]))
            last = held[-1][0, -1]
            if held[-1][0, 0] == last:
                continue  # one group goes on
            rows = np.concatenate(held, axis=1)
            cut = int(np.searchsorted(rows[0], last))
            yield from found(rows[:, :cut])
            held = [rows[:, cut:]]
        if held:
            yield from found(np.concatenate(held, axis=1))

    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(search, "a long, b long").distinct()


# Operators ------------------------------------------------------------------------------------


def print_components(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(print, component): for each distinct fingerprint of (doc_id, print) rows, the smallest document in reach."""
    ids = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = components(links(ids.select("print"), group_rows))
    named = ids.join(roots, F.col("print") == F.col("node"), "left").withColumn("root", F.coalesce("root", "print"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    return named.join(smallest, "root").select("print", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id in reach) of every row of `docs`.

    Rows are neither dropped nor merged: a repeated row comes back as often as it is there. A null text has no words
    and, like an empty one, fingerprint zero. A null id is a row like any other, but never the smallest; a component of
    null ids only has component_id null. Ties and repeated ids change nothing. An empty table gives an empty one.
    Columns of `docs` other than the two named ones are not read.
    """
    rows = checkpoint(with_fingerprints(only(docs, doc_id=id_col, text=text_col), "text", "print", words).select("doc_id", "print"))
    return rows.join(print_components(rows, group_rows), "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """`docs` with one row of each group of near duplicates: the one with the smallest id.

    Null ids come last. Of different texts of a group under one id, the one with the smallest hash stays; of equal rows,
    one does. Texts without words are one group. Columns that are neither id nor text don't matter, and all come back as
    they are, whatever their names. An empty table gives an empty one.
    """
    own, check = fresh(docs, "own"), fresh(docs, "check")
    hashed = docs.withColumn(own, F.xxhash64(f"`{id_col}`", f"`{text_col}`")).withColumn(check, F.coalesce(F.crc32(F.col(f"`{text_col}`")), F.lit(-1)))
    rows = only(hashed, doc_id=id_col, text=text_col, own=own, check=check)
    rows = checkpoint(with_fingerprints(rows, "text", "print", words).select("doc_id", "own", "check", "print"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own", "check")).alias("first")
    each = checkpoint(rows.groupBy("print").agg(first))
    roots = components(links(each.select("print"), group_rows))
    firsts = each.join(roots, F.col("print") == F.col("node"), "left").groupBy(F.coalesce("root", "print")).agg(F.min("first").alias("first"))
    kept = hashed.join(firsts.select(F.col("first.own").alias(own), F.col("first.check").alias(check)), [own, check], "left_semi")
    # the rows of a join lie by its columns, so equal ones meet without another shuffle
    return kept.dropDuplicates([own, check]).select(*(F.col(f"`{c}`") for c in docs.columns))
