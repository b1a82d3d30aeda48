"""Words of many texts at once: where they are, and 64-bit values of words and of runs of words.

Positions are bytes in the texts of a slice put one after the other (`frames.text_bytes`).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Words of more bytes are hashed one by one.
LONG = 64
# Odd, so that powers can be taken back; any odd numbers do.
RUN_BASES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words that white space ends: all but 0x20 and 0x09 to 0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of lower-case letters, digits and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    #: Index of the first word of each text, and at last the number of words.
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def scan(data: np.ndarray, offsets: np.ndarray, of_word: np.ndarray, breaks: np.ndarray | None = None) -> Words:
    """Maximal runs of the bytes that `of_word` names, none over the end of a text or one of the places `breaks`."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = of_word[data]
    edge = inside[1:] != inside[:-1]  # edge[k]: byte k differs from byte k - 1
    begins, ends = edge & inside[1:], edge & inside[:-1]
    cuts = offsets if breaks is None else np.concatenate([offsets, breaks])
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    begins[cuts] = ends[cuts] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return Words(start, end, np.searchsorted(start, offsets))


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the power of 0 to n - 1, modulo 2 to the 64."""
    size = 1 << max(10, (n - 1).bit_length())
    for (b, have), table in list(_powers.items()):
        if b == int(base) and have >= n:
            return table[:n]
        if b == int(base):
            del _powers[b, have]
    table = np.full(size, base, np.uint64)
    table[0] = 1
    table = np.cumprod(table, dtype=np.uint64)
    if size <= 1 << 22:  # one very long text leaves no large table behind
        _powers[int(base), size] = table
    return table[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """The polynomial in `base` of values[start:end] for each run, wherever it stands."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), dtype=np.uint64, out=total[1:])
    return (total[end] - total[start]) * powers(inverse(base), len(values) + 1)[start]


def word_values(data: np.ndarray, words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes. Other seeds give independent values.

    A word of up to 8 bytes shares its value with no other one of its length. Longer ones are mixed in 8 bytes at a
    time, which unlike a polynomial leaves no pattern of letters that two words could be exchanged by.
    """
    from xxhash import xxh64_intdigest

    length = words.end - words.start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    state = mixed(length.astype(np.uint64) + np.uint64((seed + 1) * int(RUN_BASES[0]) % (1 << 64)))
    live = np.flatnonzero(length <= LONG)
    for k in range(0, LONG, 8):
        live = live[length[live] > k]
        if not len(live):
            break
        empty = np.maximum(0, 8 - (length[live] - k)).astype(np.uint64) * np.uint64(8)
        state[live] = mixed(state[live] ^ ((eight[words.start[live] + k] << empty) >> empty))
    for w in np.flatnonzero(length > LONG).tolist():
        state[w] = xxh64_intdigest(data[words.start[w] : words.end[w]].tobytes(), seed)
    return state


def distinct_words(data: np.ndarray, words: Words):
    """(distinct words as a binary column, the place in it of each word), told apart by their bytes."""
    import pyarrow as pa

    length = words.end - words.start
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.start] += 1
    inside[words.end] -= 1
    edge = np.zeros(len(length) + 1, np.int32)
    np.cumsum(length, out=edge[1:])
    every = pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(edge), pa.py_buffer(data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)])])
    coded = every.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def run_values(values: np.ndarray, start: np.ndarray, length: int, more: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit values for the `length` word values from each start on; the second is of the word values `more`, if given."""
    each = (values, values if more is None else more)
    return tuple(mixed(_runs(v, start, start + length, b) + np.uint64(length)) for v, b in zip(each, RUN_BASES))


def run_starts(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of every run of `length` words within a text, and the index of the text."""
    n = words.counts
    text = np.repeat(np.arange(len(n)), np.maximum(n - length + 1, 0))
    held = np.maximum(n - length + 1, 0)
    before = np.cumsum(held) - held
    return np.arange(len(text)) - before[text] + words.first[:-1][text], text


def covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in at least one of the ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:-1]) > 0


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1 … (count[0] numbers), start[1] …"""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - count), count)
