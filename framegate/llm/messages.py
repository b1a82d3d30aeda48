"""Arrays in one compressed binary value, for sums that travel between parts of a corpus and owners of keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(*arrays: np.ndarray) -> bytes:
    import zstandard

    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), ord(a.dtype.kind), a.dtype.itemsize))], "<i8")
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


def unpacked(data: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 3 * n, 8).reshape(n, 3).tolist()
    out, at = [], 8 * (1 + 3 * n)
    for length, kind, width in head:
        out.append(np.frombuffer(raw, f"<{chr(kind)}{width}", length, at))
        at += length * width
    return out


def small(counts: np.ndarray) -> np.ndarray:
    """Counts in the smallest unsigned type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))


def steps(ascending: np.ndarray) -> np.ndarray:
    """The first of ascending numbers and the differences to the next; np.cumsum takes it back."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def sparse(counts: np.ndarray) -> bytes:
    """The cells of an array that are not zero."""
    cells = np.flatnonzero(counts)
    return packed(small(steps(cells)), small(counts[cells]))


def add_sparse(total: np.ndarray, sent: bytes) -> None:
    step, n = unpacked(sent)
    total[np.cumsum(step, dtype=np.int64)] += n.astype(total.dtype)


def added(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` (keys, width, amount, cells) with one row for each key: the sums of `amount` and, cell by cell, of the arrays.

    Arrays are added twice, first those of a 64th of the tasks, then their sums, so that no task takes in what all others
    send; a task holds one total of `width` cells at a time.
    """
    columns = [*keys, "width", "amount", "cells"]
    rows = rows.select(*columns)
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, amount = None, np.zeros(0, np.int64), 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(columns, (*key, len(total), amount, sparse(total))))], schema=made)

        made = None
        for batch in batches:
            made = pa.schema([batch.schema.field(c).with_nullable(True) for c in columns])
            for *own, width, n, sent in zip(*(batch.column(c).to_pylist() for c in columns)):
                if own != key:
                    if key is not None:
                        yield done()
                    key, total, amount = own, np.zeros(width, np.int64), 0
                amount += n
                add_sparse(total, sent)
        if key is not None:
            yield done()

    some = rows.withColumn("part_", F.spark_partition_id() % 64).repartition(*keys, "part_").sortWithinPartitions(*keys, "part_").drop("part_")
    return some.mapInArrow(run, schema).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
