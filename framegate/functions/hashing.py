"""Hash-keyed determinism: the same row gets the same draw on every run and cluster size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.functions.nulls import col

# 52 bits are exact both as bigint and as double.
HASH_BITS = 52


def row_hash(keys: Sequence[str], seed: int = 42, portable: bool = False) -> Column:
    """A 52-bit non-negative hash of the key columns.

    `portable` uses MD5 over the text of the keys, which other engines can reproduce; the
    default is xxhash64, an order of magnitude cheaper.
    """
    if portable:
        text = F.concat_ws("|", *[F.coalesce(col(k).cast("string"), F.lit("~")) for k in keys], F.lit(str(seed)))
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[col(k) for k in keys]), 64 - HASH_BITS)


def unit_draw(hash_col: Column) -> Column:
    """Uniform in [0, 1) from a row hash."""
    return hash_col.cast("double") / F.lit(float(1 << HASH_BITS))


def hashable(df: DataFrame, c: str) -> Column:
    """The column as something that can be hashed and compared: a map as its sorted entries."""
    return F.array_sort(F.map_entries(col(c))) if isinstance(df.schema[c].dataType, T.MapType) else col(c)
