"""Running a function of whole texts over the rows of a table, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one call of a text function gets, unless a single text is longer.
SLICE_BYTES = 2 << 20

#: Rows of a narrow table that may be sent to every executor; a few bytes each.
SMALL_ROWS = 1 << 20


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or the name with underscores before it that no column of `df` has (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def plain(column: pa.Array) -> pa.Array:
    """A string or binary column with 32-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_string_view(column.type):
        return column.cast(pa.string())
    return column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column one after the other as bytes, and the n + 1 offsets. A null is an empty text."""
    column = plain(column)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have `most` bytes together, or that are one row."""
    _, at = text_bytes(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column over bytes that are one text after the other."""
    return pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )


def lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.ascontiguousarray(offsets, np.int32)), values)


def filled(table: pa.Table, **kinds: pa.DataType) -> pa.Table:
    """A side of a cogroup; one without rows can come without its columns."""
    return table if set(kinds) <= set(table.column_names) else pa.table({name: pa.array([], kind) for name, kind in kinds.items()})


def give_back() -> None:
    """Hands memory that is free again to the system; workers live on between tasks of different stages."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


Computed = Callable[[pa.Array], dict[str, pa.Array]]


def with_text_columns(df: DataFrame, text: str, make: Callable[[], Computed], fields: dict[str, str], slice_bytes: int = SLICE_BYTES, keep_text: bool = True) -> DataFrame:
    """The rows of `df` as they are, without the texts if they are not to be kept, and the columns `fields` (name to SQL type) computed from the column `text`.

    `make()` runs once per task and returns the function that gets the texts of a slice. No row moves to another
    partition. A computed column of the name of another column is refused; see `fresh`.
    """
    clash = {c.lower() for c in df.columns} & {c.lower() for c in fields}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    made = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields.items()))
    own = [f for f in df.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*own, *made.fields])
    names = [f.name for f in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        compute = make()
        for batch in batches:
            texts = plain(batch.column(text))
            for i, j in slices(texts, slice_bytes):
                part = batch.slice(i, j - i)
                made = compute(texts.slice(i, j - i))
                columns = [*(part.column(name) for name in names), *(made[name] for name in fields)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *fields])
        del compute
        give_back()

    return df.mapInArrow(run, schema)


def broadcast_if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A written table of ids or names, marked for broadcast if it has `rows` rows at most; joins shuffle a larger one."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the names they have inside an operator; all others stay behind."""
    return df.select(*(F.col(f"`{c}`").alias(name) for name, c in columns.items()))
