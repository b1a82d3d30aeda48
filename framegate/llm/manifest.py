"""Merkle manifest of a dataset: a tree over the rows of each language, a tree over the languages, and a proof for each row.

Every level of all trees is one self-join. A node asks for the places of its siblings, which are its own place with the
slot shifted by 1, 2 … (`xor` does the same in a tree of two); the nodes found there are its siblings, and the rows in
slot zero, which then know their whole run, emit the parents. All of it is SQL functions on digests of 64 characters:
texts are hashed where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framegate.session import checkpoint

ARITY = 8
#: What a leaf is the digest of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose place in the order of their tree is found by one task.
RANGE_ROWS = 200_000

#: What tells a node of a level.
NODE = ["tree", "place"]
PATH = "array<struct<left:binary,right:binary>>"


def as_hex(raw: Column) -> Column:
    """Digests travel as 32 bytes and are hashed as lower-case hex text."""
    return F.lower(F.hex(raw))


def digest(*parts: Column) -> Column:
    """32 bytes, from pieces of text or from columns of digests."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def encoded(column: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value; no two rows of values have the same concatenation."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def lowered(text: Column) -> Column:
    """`text` with A to Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def placed(leaves: DataFrame) -> DataFrame:
    """`leaves` (tree, doc_id, leaf, …) with `place`, from 0 in each tree by doc_id, then leaf, null ids first, and `size` of the tree.

    Rows are dealt out by ranges of the order, so a tree of any size is sorted by many tasks. They are written in that
    shape, and the numbers of rows of each tree in each range, which lie side by side, say where a range begins.
    """
    n = leaves.count()
    many = max(leaves.sparkSession.sparkContext.defaultParallelism, 1 + n // RANGE_ROWS)
    dealt = leaves.repartitionByRange(many, "tree", "doc_id", "leaf").sortWithinPartitions("tree", "doc_id", "leaf")
    ranged = checkpoint(dealt.withColumn("range_", F.spark_partition_id()).withColumn("row_", F.monotonically_increasing_id()))
    ranges = ranged.groupBy("tree", "range_").agg(F.min("row_").alias("first_"), F.count("*").alias("rows_"))
    whole, upto = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    start = ranges.select(
        "tree", "range_", (F.coalesce(F.sum("rows_").over(upto), F.lit(0)) - F.col("first_")).alias("shift_"), F.sum("rows_").over(whole).alias("size")
    )
    return ranged.join(start, ["tree", "range_"]).withColumn("place", F.col("row_") + F.col("shift_")).drop("range_", "row_", "shift_")


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """(tree, place, digest, …) with `left` and `right`: the digests of the siblings before and after, one after the other."""
    slot = F.col("place") % arity
    asked = nodes.select(*NODE, F.explode(F.sequence(F.lit(1), F.lit(arity - 1))).alias("shift")).select(
        *NODE, (F.col("place") - slot + (slot + F.col("shift")) % arity).alias("sibling")
    )
    there = nodes.select(F.col("tree").alias("t"), F.col("place").alias("sibling_"), F.col("digest").alias("d"))
    met = asked.join(there, (F.col("tree") == F.col("t")) & (F.col("sibling") == F.col("sibling_")))
    run = met.groupBy(*NODE).agg(F.array_sort(F.collect_list(F.struct("sibling", "d"))).alias("run"))
    side = lambda keep: F.unhex(F.array_join(F.transform(F.filter("run", keep), lambda s: F.hex(s["d"])), ""))
    sides = run.select(*NODE, side(lambda s: s["sibling"] < F.col("place")).alias("left"), side(lambda s: s["sibling"] > F.col("place")).alias("right"))
    empty = F.lit(b"")
    return nodes.join(sides, NODE, "left").withColumn("left", F.coalesce("left", empty)).withColumn("right", F.coalesce("right", empty))


def levels(leaves: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """(levels from the leaves up, lone nodes) of the trees over (tree, place, size, digest, …).

    A level has the nodes of trees that still have several, with their siblings; the lowest one has all columns of
    `leaves`. A tree's lone node is its root, with the tree's height: (tree, height, digest).
    The size of the largest tree is all that reaches the driver; every level is written before the next one.
    """
    up = lambda c: F.floor(F.col(c) / arity).cast("long")
    single = lambda nodes, height: nodes.filter("size = 1").select("tree", F.lit(height).alias("height"), "digest")
    most = leaves.agg(F.max("size")).first()[0] or 0
    found, nodes, roots = [], leaves, single(leaves, 0)
    while most > 1:
        found.append(checkpoint(with_siblings(nodes.filter("size > 1"), arity)))
        parents = found[-1].filter(F.col("place") % arity == 0)
        nodes = parents.select(
            "tree", up("place").alias("place"), (up("size") + (F.col("size") % arity > 0).cast("int")).alias("size"),
            digest(as_hex(F.concat("left", "digest", "right"))).alias("digest"),
        )
        roots = roots.unionAll(single(nodes, len(found)))
        most = -(-most // arity)
    return found, checkpoint(roots)


def with_paths(leaves: DataFrame, found: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """`leaves` with `path`, the siblings (left, right) on every level from the leaf up, then the path of the tree in `tops`.

    `tops` has (tree, height, path, …), whose other columns come along. A level takes the paths of the one above it, which
    has an eighth of its nodes, so no join meets all nodes of a tree under one key; only lone leaves meet their tree.
    """
    more = [c for c in tops.columns if c not in ("tree", "height", "path")]
    at = lambda h: tops.filter(F.col("height") == h).select("tree", "path", *more)
    own = [*leaves.columns, "path", *more]
    above = None
    for height in range(len(found), -1, -1):
        if height:
            lone = at(height).select("tree", F.lit(0).cast("long").alias("place"), "path", *more)
            columns = lone.columns
        else:
            lone, columns = leaves.filter("size = 1").join(at(0), "tree").select(*own), own
        if height < len(found):
            up = above.select(F.col("tree").alias("t"), F.col("place").alias("up"), F.col("path").alias("rest"), *more)
            joined = found[height].join(up, (F.col("tree") == F.col("t")) & (F.floor(F.col("place") / arity) == F.col("up")))
            lone = joined.withColumn("path", F.concat(F.array(F.struct("left", "right")), F.col("rest"))).select(*columns).unionAll(lone)
        above = lone
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root, in hex, that follows from a leaf and its path."""
    return F.aggregate(path, as_hex(leaf), lambda own, s: F.sha2(F.concat(as_hex(s["left"]), own, as_hex(s["right"])), 256))


def proof(path: Column) -> Column:
    """The siblings' digests, level by level, left to right, one after the other."""
    return F.array_join(F.transform(path, lambda s: as_hex(F.concat(s["left"], s["right"]))), "")


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
    tampered: Column | None = None, arity: int = ARITY,
) -> DataFrame:
    """doc_id, leaf, subroot, root, path and folded_root of every row of `docs`.

    A leaf is the digest of the row's `fields`. The leaves of a language in the order of their ids are cut into runs of
    `arity`, whose digests are the next level, until one is left, the subroot; subroots in the order of their languages,
    null first, give the root alike. `path` is the siblings (left, right) of each level as bytes, from the leaf to the root,
    and folded_root what follows from the path and the leaf of the row, or of its tampered form where `tampered`, a condition
    on `docs`, holds: A to Z of its text in lower case. It differs from root where that changes a text.

    Null languages are a tree of their own, apart from empty names. Null ids come first and are never tampered with.
    Rows that share an id are ordered by their leaves; equal rows are leaves side by side, each with a path of its own.
    Null and empty texts have different leaves. An empty table gives an empty one. Other columns are not read.
    """
    hurt = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    parts = lambda text: [encoded(text if f == text_col else F.col(f"`{f}`")) for f in fields]
    text = F.col(f"`{text_col}`")
    lang = F.col(f"`{lang_col}`").cast("string")
    leaves = checkpoint(
        docs.select(
            F.coalesce(F.concat(F.lit("="), lang), F.lit("-")).alias("tree"),
            F.col(f"`{id_col}`").alias("doc_id"),
            digest(*parts(text)).alias("leaf"),
            F.when(hurt, digest(*parts(lowered(text)))).alias("hurt"),
        )
    )
    leaves = checkpoint(placed(leaves))
    found, subroots = levels(leaves.withColumnRenamed("leaf", "digest"), arity)
    # the languages are leaves of the tree above, which has no name
    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("doc_id"), F.col("digest").alias("leaf"), F.col("height").alias("own"))
    upper = checkpoint(placed(names)).withColumnRenamed("leaf", "digest")
    above, root = levels(upper, arity)
    over = with_paths(upper, above, root.select("tree", "height", F.array().cast(PATH).alias("path"), F.col("digest").alias("root")), arity)
    tops = checkpoint(over.select(F.col("doc_id").alias("tree"), F.col("own").alias("height"), "path", F.col("digest").alias("subroot"), "root"))
    return with_paths(leaves.withColumnRenamed("leaf", "digest"), found, tops, arity).select(
        "doc_id", as_hex("digest").alias("leaf"), as_hex("subroot").alias("subroot"), as_hex("root").alias("root"), "path",
        folded(F.coalesce("hurt", "digest"), F.col("path")).alias("folded_root"),
    )


def verified(made: DataFrame) -> DataFrame:
    """The manifest's digests, the digest of each proof, and whether a row's own root is the root."""
    return made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
