"""Benchmark decontamination with suffix arrays over the training texts.

Every slice of training texts is a shard with a suffix array of its own: the starts of word sequences in lexicographic
order of their words. Every suffix of every benchmark item is looked up by binary search; where at least a window of
words agrees, the match is followed to its end, so a shard reports longest verbatim matches and their places. Texts stay
where they are; the benchmark travels to them in blocks of bounded size.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.llm.frames import fresh, lists, only, text_bytes, with_text_columns
from framegate.llm.words import LETTERS, LOWER, distinct_words, ranges, scan

WINDOW = 10
#: Bytes of benchmark text that are sent to every executor at a time; a larger benchmark takes several passes.
BLOCK_BYTES = 16 << 20

MATCHES = "array<struct<item:string,item_start:int,start:int,length:int>>"


class Block(NamedTuple):
    """Benchmark items as word numbers: 1 for the first word of the vocabulary and so on, a 0 after each item."""

    vocabulary: pa.Array
    words: np.ndarray
    #: Of each suffix that can begin a match: its place in `words`, the words that must agree, and its item.
    place: np.ndarray
    least: np.ndarray
    item: np.ndarray
    names: list[str | None]
    item_begin: np.ndarray


def numbered(texts: pa.Array, vocabulary: pa.Array | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, word numbers with a 0 after each text, start of each text in them, words of each text).

    Words are compared by their bytes. A word outside a given vocabulary is 0, which equals nothing.
    """
    data, at = text_bytes(texts)
    data = LOWER[data]
    words = scan(data, at, LETTERS)
    own, back = distinct_words(data, words)
    if vocabulary is None:
        vocabulary = own
    place = pc.index_in(own, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
    number = place.astype(np.int64)[back] + 1
    count = words.counts
    begin = words.first[:-1] + np.arange(len(count))
    out = np.zeros(len(number) + len(count) + 1, np.int64)
    out[np.arange(len(number)) + np.repeat(np.arange(len(count)), count)] = number
    return vocabulary, out, begin, count


def block_of(names: list[str | None], texts: list[str | None], window: int) -> Block:
    vocabulary, words, begin, count = numbered(pa.array(texts, pa.string()))
    least = np.minimum(count, window)
    suffixes = np.where(count > 0, count - least + 1, 0)
    item = np.repeat(np.arange(len(names)), suffixes)
    return Block(vocabulary, words, ranges(begin, suffixes), least[item], item, names, begin)


def packed(numbers: np.ndarray, place: np.ndarray, words: int, per_key: int, bits: int) -> list[np.ndarray]:
    """The first `words` numbers from each place on, `per_key` of them in one integer, in lexicographic order."""
    keys = []
    for start in range(0, words, per_key):
        key = np.zeros(len(place), np.uint64)
        for k in range(start, start + per_key):
            inside = np.minimum(place + k, len(numbers) - 1)
            key = (key << np.uint64(bits)) | numbers[inside].astype(np.uint64)
        keys.append(key)
    return keys


def search(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search in a suffix array by its keys: how many suffixes are below (or not above) each wanted one."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]))
    while (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
        before, same = np.zeros(len(low), bool), np.ones(len(low), bool)
        for key, want in zip(keys, wanted):
            own = key[middle]
            before |= same & (own < want)
            same &= own == want
        if after:
            before |= same
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    return low


def matches(numbers: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix of the block, place in `numbers`, words) of all longest matches that can't be made longer to the left."""
    none = np.zeros(0, np.int64)
    if not len(block.place) or not len(numbers):
        return none, none, none
    bits = 16 if len(block.vocabulary) < 1 << 16 else 32
    per_key, reach = 64 // bits, int(block.least.max())
    # a suffix that meets a word outside of the benchmark before the shortest window is full begins no match
    stops = np.flatnonzero(numbers == 0)
    room = stops[np.minimum(np.searchsorted(stops, np.arange(len(numbers))), len(stops) - 1)] - np.arange(len(numbers))
    suffixes = np.flatnonzero(room >= block.least.min())
    if not len(suffixes):
        return none, none, none
    keys = packed(numbers, suffixes, reach, per_key, bits)
    order = np.lexsort(keys[::-1])
    suffixes, keys = suffixes[order], [k[order] for k in keys]

    # lowest and highest keys that agree with the benchmark suffix in all words that must agree
    low, high = [], []
    for start in range(0, reach, per_key):
        a, b = np.zeros((2, len(block.place)), np.uint64)
        for k in range(start, start + per_key):
            bound = k < block.least
            own = block.words[np.minimum(block.place + k, len(block.words) - 1)].astype(np.uint64)
            a = (a << np.uint64(bits)) | np.where(bound, own, np.uint64(0))
            b = (b << np.uint64(bits)) | np.where(bound, own, np.uint64((1 << bits) - 1))
        low.append(a)
        high.append(b)
    first, last = search(keys, low, False), search(keys, high, True)
    suffix = np.repeat(np.arange(len(first)), last - first)
    place = suffixes[ranges(first, last - first)]
    begin = block.place[suffix]
    inner = begin > block.item_begin[block.item[suffix]]
    longer = inner & (place > 0) & (numbers[place - 1] == block.words[begin - 1])
    suffix, place, begin = suffix[~longer], place[~longer], begin[~longer]
    length = block.least[suffix].copy()
    going = np.arange(len(length))
    while len(going):
        x, y = numbers[place[going] + length[going]], block.words[begin[going] + length[going]]
        going = going[(x == y) & (x != 0)]
        length[going] += 1
    return suffix, place, length


def with_matches(docs: DataFrame, text: str, block: Block, name: str, n_words: str | None = None) -> DataFrame:
    """`docs` with the longest matches of each text, and if asked with its number of words."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        block = sent.value
        names = pa.array(block.names, pa.string())

        def compute(texts: pa.Array) -> dict[str, pa.Array]:
            _, numbers, begin, count = numbered(texts, block.vocabulary)
            suffix, place, length = matches(numbers, block)
            order = np.lexsort((suffix, place))
            suffix, place, length = suffix[order], place[order], length[order]
            item = block.item[suffix]
            held = np.searchsorted(place, np.r_[begin, len(numbers)])
            doc = np.searchsorted(begin, place, "right") - 1
            rows = pa.StructArray.from_arrays(
                [
                    names.take(pa.array(item)),
                    pa.array((block.place[suffix] - block.item_begin[item]).astype(np.int32)),
                    pa.array((place - begin[doc]).astype(np.int32)),
                    pa.array(length.astype(np.int32)),
                ],
                names=["item", "item_start", "start", "length"],
            )
            made = {name: lists(rows, held)}
            return made | ({n_words: pa.array(count.astype(np.int64))} if n_words else {})

        return compute

    return with_text_columns(docs, text, make, {name: MATCHES} | ({n_words: "long"} if n_words else {}))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int):
    """The benchmark in blocks of about `block_bytes`, one at a time on the driver; at least one, if an empty one."""
    items = only(benchmark, item=id_col, text=text_col).filter(F.col("text").isNotNull()).withColumn("item", F.col("item").cast("string"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()
        yield block_of([r["item"] for r in rows], [r["text"] for r in rows], window)


def find_matches(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES, name: str = "matches", n_words: str | None = None,
) -> DataFrame:
    """`docs` with all longest verbatim matches of benchmark items: item, first word in the item, first word in the text, words.

    Words are runs of letters, digits and characters beyond ASCII, lower-cased from A to Z. A match has `window` words at
    least, or is a whole item of fewer. Null texts and items have no words, nor has an empty one; items of equal text
    match alike; an item without an id matches under the name null. Rows are neither dropped nor merged.
    """
    parts = []
    for k, block in enumerate(blocks(benchmark, item_col, item_text_col, window, block_bytes)):
        parts.append(fresh(docs, f"{name}_{k}"))
        docs = with_matches(docs, text_col, block, parts[-1], n_words if not k else None)
    return docs.withColumn(name, F.concat(*(F.col(p) for p in parts))).drop(*parts)


def covered_words(found):
    """Number of words of a text that lie in at least one of its matches, as a column."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["b"]).alias("upto"), (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["upto"], s["a"]))).alias("n")
        ),
        lambda acc: acc["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit (words inside a match), items (distinct, sorted as strings), contaminated, matches."""
    found = find_matches(only(docs, doc_id=id_col, text=text_col), benchmark, "text", window=window, block_bytes=block_bytes, n_words="n_words")
    items = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item"]), lambda i: i.isNotNull())))
    return found.select(
        "doc_id", "n_words", covered_words(F.col("matches")).alias("n_hit"), items.alias("items"), (F.size("matches") > 0).alias("contaminated"), "matches"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` without the rows whose text holds a window of a benchmark item; columns stay as they are."""
    found = fresh(docs, "matches")
    marked = find_matches(docs, benchmark, text_col, window=window, block_bytes=block_bytes, name=found)
    return marked.filter(F.size(found) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))
