"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.session import checkpoint


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round over (a, b) with a > b.

    large: every node links its larger neighbours to its smallest one. small: every node links its smaller neighbours
    and itself to the smallest. The smallest neighbour is a map-side combined minimum; a hub with very many links is
    only ever one side of an equi-join, which adaptive execution can split.
    """
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        out = both.join(least, both.a == least.u).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        turned = edges.join(least, edges.a == least.u).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = turned.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the smallest node in reach.

    Rounds end when one changes nothing; only a count and a checksum reach the driver. Each round is checkpointed, so
    that a lost executor costs one round at most.
    """
    edges = checkpoint(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        edges = checkpoint(_stars(_stars(edges, True), False))
