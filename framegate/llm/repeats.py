"""Removal of repeated passages: every run of 20 words that also stands earlier in the corpus.

Texts are dealt out to parts of bounded size, and stay there. Three things travel instead of windows:

1. Each part counts its windows in a count-min sketch of two rows and sends the cells it has touched to the owners of the
   cells, which are blocks of the sketch. A block adds up the sketches of all parts and answers each part with one bit a
   cell: is its count two or more? A count-min estimate is never too low, so no repeated window is lost.
2. Windows that both rows hold for repeated go, once for each part, to groups by their 128-bit value. A group sorts its
   windows and tells each part which of them stand earlier elsewhere.
3. The part marks the words of those windows.

Cells and answers are sorted, delta-coded and compressed, about two bytes a window and row; see `messages.packed`.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.llm.frames import filled, only, slices, strings, text_bytes
from framegate.llm.messages import packed, steps, unpacked
from framegate.llm.words import NOT_SPACE, covered, run_starts, run_values, scan, word_values

WINDOW = 20
#: Bytes of text in a part, cells of a block (a power of two), cells for each window and row, windows of a group at most.
PART_BYTES = 8 << 20
BLOCK_BITS = 22
CELLS = 4
GROUP_WINDOWS = 4 << 20
#: Bytes of text for each window, about; sizes the sketch.
BYTES_A_WORD = 6

CELL_ROWS = "block long, part long, cells binary"
ANSWER_ROWS = "part long, block long, bits binary"
WINDOW_ROWS = "g long, part long, found binary, known binary"
REMOVED_ROWS = "part long, removed binary"


class Sizes(NamedTuple):
    parts: int
    #: Cells of a row of the sketch are 2 to the power of this.
    row_bits: int
    groups: int


def sizes_for(total_bytes: int, part_bytes: int = PART_BYTES, group_windows: int = GROUP_WINDOWS) -> Sizes:
    windows = max(1, total_bytes // BYTES_A_WORD)
    bits = max(BLOCK_BITS, (windows * CELLS - 1).bit_length())
    return Sizes(max(1, -(-total_bytes // part_bytes)), bits, max(1, -(-windows // group_windows)))


class Windows(NamedTuple):
    """The windows of a part: 128-bit value, row of the part, first word."""

    high: np.ndarray
    low: np.ndarray
    row: np.ndarray
    start: np.ndarray


def in_order(table: pa.Table) -> pa.Table:
    """Rows by id, then text: the same order whenever a part is put together."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")])).combine_chunks()


def windows_of(texts: pa.Array, window: int) -> Windows:
    made = []
    for i, j in slices(texts):
        data, at = text_bytes(texts.slice(i, j - i))
        words = scan(data, at, NOT_SPACE)
        begin, row = run_starts(words, window)
        high, low = run_values(word_values(data, words), begin, window, word_values(data, words, 1))
        made.append((high, low, (row + i).astype(np.int32), (begin - words.first[:-1][row]).astype(np.int32)))
    if not made:
        return Windows(*(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int32, np.int32)))
    return Windows(*(np.concatenate(x) for x in zip(*made)))


def _texts(table: pa.Table) -> pa.Array:
    return table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())


def sketch_cells(windows: Windows, row_bits: int):
    """For each row of the sketch: (its number, distinct cells, windows in each, cell of each window)."""
    for row, value in enumerate((windows.high, windows.low)):
        yield row, *np.unique(value >> np.uint64(64 - row_bits), return_inverse=True, return_counts=True)


def _by_block(row: int, cells: np.ndarray, row_bits: int):
    """(block, from, to) of sorted cells."""
    blocks = 1 << (row_bits - BLOCK_BITS)
    own = (cells >> np.uint64(BLOCK_BITS)).astype(np.int64)
    opens = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
    for a, b in zip(opens.tolist(), np.r_[opens[1:], len(own)].astype(int).tolist()):
        yield row * blocks + int(own[a]), a, b


def count_part(part: int, table: pa.Table, window: int, row_bits: int) -> pa.Table:
    """The part's own sketch, a row for each block that it touches."""
    block, cells_col = [], []
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    for row, cells, _, count in sketch_cells(windows_of(_texts(table), window), row_bits):
        for b, i, j in _by_block(row, cells, row_bits):
            offset = (cells[i:j] & mask).astype(np.uint32)
            block.append(b)
            cells_col.append(packed(steps(offset), np.packbits(count[i:j] > 1)))
    return pa.table({"block": pa.array(block, pa.int64()), "part": pa.array([part] * len(block), pa.int64()), "cells": pa.array(cells_col, pa.binary())})


def merge_block(block: int, table: pa.Table) -> pa.Table:
    """Adds up what the parts have counted in a block; for each part one bit a cell: two windows or more?"""
    total = np.zeros(1 << BLOCK_BITS, np.uint8)  # 0, 1 or 2: more than two is as good as two
    sent = [unpacked(x.as_py()) for x in table.column("cells")]
    for delta, often in sent:
        cells = np.cumsum(delta, dtype=np.int64)
        total[cells] = np.minimum(total[cells] + 1 + np.unpackbits(often, count=len(cells)), 2)
    bits = [packed(np.packbits(total[np.cumsum(delta, dtype=np.int64)] > 1)) for delta, _ in sent]
    return pa.table({"part": table.column("part"), "block": table.column("block"), "bits": pa.array(bits, pa.binary())})


def runs_of_equals(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """True where a sorted value differs from the one before."""
    return np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])] if len(high) else np.zeros(0, bool)


def candidates(part: int, table: pa.Table, answers: pa.Table, window: int, sizes: Sizes) -> pa.Table:
    """Windows estimated to be repeated, one row for each group; what the part itself can tell is known already."""
    table, answers = in_order(table), filled(answers, block=pa.int64(), bits=pa.binary())
    windows = windows_of(_texts(table), window)
    told = dict(zip(answers.column("block").to_pylist(), answers.column("bits").to_pylist()))
    maybe = np.ones(len(windows.row), bool)
    for row, cells, back, _ in sketch_cells(windows, sizes.row_bits):
        hot = np.zeros(len(cells), bool)
        for b, i, j in _by_block(row, cells, sizes.row_bits):
            hot[i:j] = np.unpackbits(unpacked(told[b])[0], count=j - i)
        maybe &= hot[back]
    high, low, row, start = (a[maybe] for a in windows)
    ids = table.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
    doc = ids[row] if len(row) else np.zeros(0, np.int64)
    order = np.lexsort((start, doc, low, high))
    high, low, row, start, doc = (a[order] for a in (high, low, row, start, doc))
    first = runs_of_equals(high, low)
    # a later window of the part is removed, whatever other parts have; of rows that share id and start none is the later
    opens = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0)) if len(first) else np.zeros(0, np.int64)
    later = (doc != doc[opens]) | (start != start[opens])
    known = packed(row[later].view(np.uint32), start[later].view(np.uint32))
    same = ~first & ~later  # copies of a row: they share the answer of the first
    twin = packed(row[same].view(np.uint32), start[same].view(np.uint32), row[opens[same]].view(np.uint32), start[opens[same]].view(np.uint32))
    high, low, row, start, doc = (a[first] for a in (high, low, row, start, doc))
    group = (high % np.uint64(sizes.groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    edge = np.searchsorted(group[order], np.arange(sizes.groups + 1))
    g, found, own = [], [], []
    for k in range(sizes.groups):
        at = order[edge[k] : edge[k + 1]]
        if len(at) or k == part % sizes.groups:
            g.append(k)
            found.append(packed(high[at], low[at], doc[at].view(np.uint64), row[at].view(np.uint32), start[at].view(np.uint32)))
            own.append(packed(np.frombuffer(known, np.uint8), np.frombuffer(twin, np.uint8)) if k == part % sizes.groups else None)
    return pa.table(
        {"g": pa.array(g, pa.int64()), "part": pa.array([part] * len(g), pa.int64()), "found": pa.array(found, pa.binary()), "known": pa.array(own, pa.binary())}
    )


def settle(g: int, table: pa.Table) -> pa.Table:
    """Of all parts' windows of a group, those that stand earlier elsewhere, told to their parts."""
    sent = [unpacked(x.as_py()) for x in table.column("found")]
    high, low, doc, row, start = (np.concatenate(x) for x in zip(*sent))
    whose = np.repeat(np.arange(len(sent)), [len(s[0]) for s in sent])
    doc = doc.view(np.int64)
    order = np.lexsort((start, doc, low, high))
    first = runs_of_equals(high[order], low[order])
    opens = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0)) if len(first) else np.zeros(0, np.int64)
    later = (doc[order] != doc[order[opens]]) | (start[order] != start[order[opens]])
    gone = order[later]
    gone = gone[np.argsort(whose[gone], kind="stable")]
    edge = np.searchsorted(whose[gone], np.arange(len(sent) + 1))
    none = packed(np.zeros(0, np.uint32))
    out = []
    for k, known in enumerate(table.column("known").to_pylist()):
        mine = gone[edge[k] : edge[k + 1]]
        out.append(packed(row[mine], start[mine], np.frombuffer(known or none, np.uint8)))
    return pa.table({"part": table.column("part"), "removed": pa.array(out, pa.binary())})


def clean_part(table: pa.Table, removed: pa.Table, window: int) -> pa.Table:
    """doc_id, text of the words that stay, n_words, n_removed."""
    table, removed = in_order(table), filled(removed, removed=pa.binary())
    rows, starts, twins = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], []
    for x in removed.column("removed"):
        row, start, known = unpacked(x.as_py())
        rows.append(row)
        starts.append(start)
        inside = unpacked(known.tobytes())
        if len(inside) == 2:
            local, twin = (unpacked(y.tobytes()) for y in inside)
            rows.append(local[0])
            starts.append(local[1])
            twins.append(twin)
    row, start = np.concatenate(rows).astype(np.int64), np.concatenate(starts).astype(np.int64)
    for mine, at, other, other_at in twins:
        if len(mine):
            shared = np.isin((other.astype(np.int64) << 32) + other_at, (row << 32) + start)
            row, start = np.r_[row, mine[shared].astype(np.int64)], np.r_[start, at[shared].astype(np.int64)]
    order = np.argsort(row, kind="stable")
    row, start = row[order], start[order]
    texts, kept, n_words, n_removed = _texts(table), [], [], []
    for i, j in slices(texts):
        data, at = text_bytes(texts.slice(i, j - i))
        words = scan(data, at, NOT_SPACE)
        a, b = np.searchsorted(row, [i, j])
        begin = words.first[:-1][row[a:b] - i] + start[a:b]
        gone = covered(begin, begin + window, len(words.start))
        text, edge = joined_words(data, words.start[~gone], words.end[~gone], np.r_[0, np.cumsum(~gone)][words.first])
        kept.append(strings(text, edge))
        n_words.append(words.counts)
        n_removed.append(np.diff(np.r_[0, np.cumsum(gone)][words.first]))
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "text": pa.chunked_array(kept, pa.string()),
            "n_words": np.concatenate([*n_words, np.zeros(0, np.int64)]),
            "n_removed": np.concatenate([*n_removed, np.zeros(0, np.int64)]),
        }
    )


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text with one space between: bytes, and offsets of the texts. first: first word of each text."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[start] += 1
    inside[end] -= 1
    # a word takes its bytes and one more for the space after it, which the last word of a text gives back
    size = end - start + 1
    total = np.r_[0, np.cumsum(size)]
    out = np.full(total[-1], 0x20, np.uint8)
    places = np.ones(total[-1], bool)
    places[total[1:] - 1] = False
    out[places] = data[np.cumsum(inside[: len(data)], dtype=np.int8).astype(bool)]
    counts = np.diff(first)
    keep = np.ones(total[-1], bool)
    keep[total[first[1:][counts > 0]] - 1] = False
    edge = total[first] - np.r_[0, np.cumsum(counts > 0)]
    return out[keep], edge


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES,
    group_windows: int = GROUP_WINDOWS, sizes: Sizes | None = None,
) -> DataFrame:
    """doc_id, text (the words that stay, one space between), n_words, n_removed of every row of `docs`.

    A word goes if it lies in a window whose word sequence also starts at a smaller id, or earlier in the same document.
    Ids are whole numbers; a null id comes after all others. Rows that share an id are one document: of two equal windows
    at the same place of it none is the earlier. A null text has no words; a text shorter than the window loses none.
    Rows are neither dropped nor merged, an empty table gives an empty one, and other columns are not read.
    """
    rows = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    if sizes is None:
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        sizes = sizes_for(total, part_bytes, group_windows)
    parts = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(sizes.parts)))
    cells = parts.groupBy("part").applyInArrow(lambda key, t: count_part(key[0].as_py(), t, window, sizes.row_bits), CELL_ROWS)
    answers = cells.groupBy("block").applyInArrow(lambda key, t: merge_block(key[0].as_py(), t), ANSWER_ROWS)
    found = parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        lambda key, t, a: candidates(key[0].as_py(), t, a, window, sizes), WINDOW_ROWS
    )
    gone = found.groupBy("g").applyInArrow(lambda key, t: settle(key[0].as_py(), t), REMOVED_ROWS)
    return parts.groupBy("part").cogroup(gone.groupBy("part")).applyInArrow(
        lambda key, t, r: clean_part(t, r, window), "doc_id long, text string, n_words long, n_removed long"
    )
