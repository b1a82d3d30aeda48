"""Shards of nearly equal bytes that keep equal texts together: best-fit-decreasing bin packing.

What is packed is a bounded number of units, however large the corpus. A group of equal texts that is large for a unit is
a unit of its own; all small groups are hashed into a fixed number of bundles. Units, largest first, go to the shard with
the least room that still holds them, which a balanced tree over the shards' room finds; the capacity is the smallest one
for which the shards suffice. Everything about single documents is a join with that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegate.llm.frames import only
from framegate.session import checkpoint

SHARDS = 40
#: Bytes that a document takes besides its text.
OVERHEAD = 16
#: Units that a shard consists of, about.
UNITS_A_SHARD = 128
#: Documents of a large group are numbered in so many lanes, or more if it is to be cut.
LANES = 16


class RoomTree:
    """An AVL tree of (room, shard), for the tightest room that still suffices."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    # A node is [key, left, right, height].
    @staticmethod
    def _fixed(node: list) -> list:
        height = lambda x: x[3] if x else 0

        def measured(x: list) -> list:
            x[3] = 1 + max(height(x[1]), height(x[2]))
            return x

        def turned(x: list, down: int, up: int) -> list:
            top = x[up]
            x[up], top[down] = top[down], x
            measured(x)
            return measured(top)

        measured(node)
        for heavy, light in ((1, 2), (2, 1)):
            if height(node[heavy]) > height(node[light]) + 1:
                if height(node[heavy][light]) > height(node[heavy][heavy]):
                    node[heavy] = turned(node[heavy], heavy, light)
                return turned(node, light, heavy)
        return node

    def add(self, key: tuple[int, int]) -> None:
        def into(node):
            if node is None:
                return [key, None, None, 1]
            side = 1 if key < node[0] else 2
            node[side] = into(node[side])
            return self._fixed(node)

        self.root = into(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def out(node, key):
            if key == node[0]:
                if node[1] is None or node[2] is None:
                    return node[1] or node[2]
                least = node[2]
                while least[1]:
                    least = least[1]
                node[0] = least[0]
                node[2] = out(node[2], least[0])
            else:
                side = 1 if key < node[0] else 2
                node[side] = out(node[side], key)
            return self._fixed(node)

        self.root = out(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest (room, shard) with room for `size`."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                node, best = node[1], node[0]
            else:
                node = node[2]
        return best


def best_fit(sizes: list[int], capacity: int, bins: int) -> list[int] | None:
    """The bin of each size, given in decreasing order, or None if `bins` bins of that capacity don't suffice."""
    tree, opened, out = RoomTree(), 0, []
    for size in sizes:
        found = tree.tightest(size)
        if found:
            tree.remove(found)
            room, k = found
        elif opened < bins and size <= capacity:
            room, k, opened = capacity, opened, opened + 1
        else:
            return None
        tree.add((room - size, k))
        out.append(k)
    return out


def pack_units(sizes: list[int], bins: int) -> list[int]:
    """The bin of each size under the smallest capacity for which best-fit decreasing needs at most `bins` bins.

    Searched between what the bins must hold on average and what best fit needs surely.
    """
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    down = [sizes[k] for k in order]
    if not down:
        return []
    low = max(down[0], -(-sum(down) // bins))
    high = low + down[0]
    while (found := best_fit(down, high, bins)) is None:
        high += down[0]
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(down, middle, bins)
        if tried is None:
            low = middle + 1
        else:
            high, found = middle, tried
    out = [0] * len(sizes)
    for k, b in zip(order, found):
        out[k] = b
    return out


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, size, text_crc32, and a key that equal texts share."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return only(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("same"),
    )


def lane_of(lanes: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id"), lanes.cast("long")).cast("int")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, units_a_shard: int = UNITS_A_SHARD) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (0, 1 … without gaps in each shard) of every row of `docs`.

    Equal texts share a shard. Only a group of more bytes than a shard may hold on average can't: it is cut into pieces
    by a hash of the id, and the pieces are packed like groups. A null text counts as an empty one, a null id is an id like any other, rows
    are neither dropped nor merged, and an empty table gives an empty one. Other columns are not read. The units that
    reach the driver are at most `shards` x `units_a_shard` bundles, as many large groups, and 16 lanes (for a cut group
    four times `shards`) of each.
    """
    rows = checkpoint(measured(docs, id_col, text_col))
    bundles = shards * units_a_shard
    total = rows.agg(F.sum("size")).first()[0] or 0
    # more than this: at most `bundles` such groups
    large = rows.groupBy("same").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") * bundles > total).collect()
    cut = {bytes(r["same"]) for r in large if r["bytes"] * shards > total}
    many = [(bytes(r["same"]), bundles + k, 4 * shards if bytes(r["same"]) in cut else LANES) for k, r in enumerate(sorted(large, key=lambda r: bytes(r["same"])))]
    spark = docs.sparkSession
    own = F.broadcast(spark.createDataFrame(many, "same binary, own long, own_lanes int"))
    bundle = F.pmod(F.xxhash64("same"), F.lit(bundles))
    placed = (
        rows.join(own, "same", "left")
        .withColumn("unit", F.coalesce("own", bundle))
        .withColumn("lane", lane_of(F.coalesce("own_lanes", F.lit(1))))
        .select("doc_id", "size", "text_crc32", "unit", "lane")
    )
    lanes = placed.groupBy("unit", "lane").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    cut_units = {unit for same, unit, _ in many if same in cut}
    weight: dict[tuple, int] = {}
    for r in lanes:
        key = (r["unit"], r["lane"] if r["unit"] in cut_units else -1)
        weight[key] = weight.get(key, 0) + r["bytes"]
    keys = sorted(weight)
    where = dict(zip(keys, pack_units([weight[k] for k in keys], shards)))
    next_slot, table = [0] * shards, []
    for r in sorted(lanes, key=lambda r: (r["unit"], r["lane"])):
        k = where[r["unit"], r["lane"] if r["unit"] in cut_units else -1]
        table.append((r["unit"], r["lane"], k, next_slot[k]))
        next_slot[k] += r["n"]
    begin = F.broadcast(spark.createDataFrame(table, "unit long, lane int, shard int, begin long"))
    turn = F.row_number().over(Window.partitionBy("unit", "lane").orderBy("doc_id", "text_crc32", "size"))
    return (
        placed.withColumn("turn", turn)
        .join(begin, ["unit", "lane"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("turn") - 1).alias("slot"))
    )
