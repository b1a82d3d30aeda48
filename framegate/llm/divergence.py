"""How the sources of a language differ from it and from each other, term by term, with exact counts of all kept terms.

The first pass counts in how many documents of its language a term occurs, exactly, and keeps those in enough of them.
Kept terms get a slot each by minimal perfect hashes, one for each language and shard of its terms. The hashes travel to
all tasks together with the terms they were made of, for a perfect hash sends an unknown term to some slot as well: the
term that is stored there must be the same. The second pass adds up occurrences in dense arrays, one slot a term, for
each (language, source) and shard; the arrays of all tasks are summed block by block.

Shares are parts of 10^9 and all arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegate.llm.frames import broadcast_if_small, only, plain, slices, strings, text_bytes
from framegate.llm.messages import add_sparse, added, packed, sparse, unpacked
from framegate.llm.words import LOWER, Words, distinct_words, mixed, scan, word_values
from framegate.session import checkpoint

#: Bytes of terms: ASCII letters and everything beyond ASCII.
TERMS = np.zeros(256, bool)
TERMS[0x41:0x5B] = TERMS[0x61:0x7B] = TERMS[0x80:] = True

#: Documents of a language that a kept term occurs in at least; ranks of terms that are reported; what shares are parts of.
LEAST_DOCUMENTS = 3
TOP = 200
WHOLE = 1_000_000_000
#: Terms of a shard, about: an array of counts has so many slots.
SHARD_TERMS = 1 << 16
#: Bytes of terms whose hashes are sent to every executor at a time; more of them take several passes.
BROADCAST_BYTES = 64 << 20
#: Slots of arrays of counts that a task of the second pass holds before it sends them on.
HELD_SLOTS = 8 << 20
#: Bits for each key on a level of a perfect hash.
LOAD = 2
#: Sources of a block; a task compares two blocks of a shard.
BLOCK_SOURCES = 32


# Perfect hashes -------------------------------------------------------------------------------


def term_values(terms: pa.Array, seed: int = 0) -> np.ndarray:
    data, at = text_bytes(terms)
    return word_values(data, Words(at[:-1], at[1:], at[:1]), seed)


class PerfectHash(NamedTuple):
    """A minimal perfect hash over its stored keys.

    On each level a key has a bit of its own if no other key that is left hashes there; those that share one go on to the
    next level. A key's slot is the number of bits set before its own.
    """

    #: Bits of all levels, and where each level begins (one more at the end).
    bits: np.ndarray
    begin: np.ndarray
    #: The key of each slot.
    keys: pa.Array | None = None

    def places(self, value: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The slot of each term by its two hashes; some slot, or -1, for a term that isn't stored."""
        out = np.full(len(value), -1, np.int64)
        words = self.bits.view("<u8")
        counts = np.bitwise_count(words)
        before = np.cumsum(counts, dtype=np.int64) - counts
        left = np.arange(len(value))
        for k in range(len(self.begin) - 1):
            place = self.begin[k] + _spot(value[left], other[left], k, self.begin[k + 1] - self.begin[k])
            word, bit = words[place >> 6], (place & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) > 0
            rank = before[place >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[here]] = rank[here]
            left = left[~here]
        return out

    def slots(self, terms: pa.Array, value: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The slot of each term, and -1 for one that is not the key stored there."""
        out = self.places(value, other)
        found = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[found])), terms.take(pa.array(found)))
        out[found[~same.to_numpy(zero_copy_only=False).astype(bool)]] = -1
        return out


def _spot(value: np.ndarray, other: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(value ^ mixed(other + np.uint64(level))) % np.uint64(size)).astype(np.int64)


def perfect_hash(terms: pa.Array) -> PerfectHash:
    """Over distinct terms, a binary column."""
    value, other = term_values(terms), term_values(terms, 1)
    left, bits, begin = np.arange(len(terms)), [np.zeros(0, np.uint8)], [0]
    while len(left):
        size = -(-len(left) * LOAD // 64) * 64
        place = _spot(value[left], other[left], len(bits) - 1, size)
        alone = np.bincount(place, minlength=size) == 1
        bits.append(np.packbits(alone, bitorder="little"))
        begin.append(begin[-1] + size)
        left = left[~alone[place]]
    made = PerfectHash(np.concatenate(bits), np.array(begin, np.int64))
    order = np.empty(len(terms), np.int64)
    order[made.places(value, other)] = np.arange(len(terms))
    return made._replace(keys=terms.take(pa.array(order)))


# Passes ---------------------------------------------------------------------------------------


def slice_terms(texts: pa.Array):
    """(distinct terms, for each occurrence its term, and its text)."""
    data, at = text_bytes(texts)
    data = LOWER[data]
    words = scan(data, at, TERMS)
    terms, back = distinct_words(data, words)
    return terms, back.astype(np.int64), np.repeat(np.arange(len(texts)), words.counts)


def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, hash, documents) of each batch of (lang, text)."""
    for batch in batches:
        made = []
        for i, j in slices(batch.column("text")):
            terms, back, text = slice_terms(batch.column("text").slice(i, j - i))
            lang = batch.column("lang").slice(i, j - i).dictionary_encode()
            n = max(1, len(terms))
            once = np.unique(text * n + back)
            key, count = np.unique(lang.indices.to_numpy().astype(np.int64)[once // n] * n + once % n, return_counts=True)
            made.append(pa.table({"lang": lang.dictionary.take(pa.array(key // n)), "term": terms.take(pa.array(key % n)), "documents": count.astype(np.int64)}))
        if made:
            summed = pa.concat_tables(made).group_by(["lang", "term"]).aggregate([("documents", "sum")])
            term = summed.column("term").combine_chunks()
            # two bits less, so that it is a positive long
            value = (term_values(term) >> np.uint64(2)).astype(np.int64)
            columns = [plain(summed.column("lang")), term.cast(pa.string()), pa.array(value), plain(summed.column("documents_sum"))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "hash", "documents"])


SHARD = "lang string, sub long, subs long, width long, bits binary, terms array<string>, places binary"


def shard_of(key: tuple, table: pa.Table) -> pa.Table:
    """The perfect hash of a shard, its terms by slot, and for each slot the place of its term among all in the order of their bytes."""
    made = perfect_hash(table.column("term").combine_chunks().cast(pa.binary()))
    order = pc.sort_indices(made.keys).to_numpy()
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()], pa.string()), "sub": pa.array([key[1].as_py()], pa.int64()), "subs": table.column("subs").slice(0, 1), "width": pa.array([len(order)], pa.int64()),
            "bits": pa.array([packed(made.bits, made.begin)], pa.binary()), "terms": pa.array([made.keys.cast(pa.string()).to_pylist()], pa.list_(pa.string())),
            "places": pa.array([packed(place)], pa.binary()),
        }
    )


class Shards:
    """The perfect hashes that have travelled to a task, and how many shards each of their languages has."""

    def __init__(self, sent: list[tuple[str, int, int, bytes, bytes]]):
        self.subs: dict[str, int] = {}
        self.made: dict[str, dict[int, PerfectHash]] = {}
        for lang, sub, subs, bits, terms in sent:
            self.subs[lang] = subs
            flat, begin = unpacked(bits)
            edge, raw = unpacked(terms)
            self.made.setdefault(lang, {})[sub] = PerfectHash(flat, begin, strings(raw, edge).cast(pa.binary()))

    def find(self, lang: str, terms: pa.Array):
        """(sub, places in `terms`, slots) of the terms that are kept in a language, shard by shard."""
        shards = self.made.get(lang)
        if not shards or not len(terms):
            return
        value, other = term_values(terms), term_values(terms, 1)
        sub = (value >> np.uint64(2)).astype(np.int64) % self.subs[lang]
        order = np.argsort(sub, kind="stable")
        edge = np.searchsorted(sub[order], np.arange(self.subs[lang] + 1))
        for k, made in shards.items():
            mine = order[edge[k] : edge[k + 1]]
            slot = made.slots(terms.take(pa.array(mine)), value[mine], other[mine])
            yield k, mine[slot >= 0], slot[slot >= 0], len(made.keys)


COUNTS = "lang string, source string, sub long, width long, amount long, cells binary"


def count_slots(batches: Iterator[pa.RecordBatch], shards: Shards, held: int = HELD_SLOTS) -> Iterator[pa.RecordBatch]:
    """Occurrences of kept terms in dense arrays for each (lang, source) and shard, over rows (lang, source, text)."""
    total: dict[tuple[str, str, int], np.ndarray] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source, sub), n in total.items():
            row = {"lang": [lang], "source": [source], "sub": [sub], "width": [len(n)], "amount": [int(n.sum())], "cells": [sparse(n)]}
            yield pa.RecordBatch.from_pydict(row)
        total.clear()

    slots = 0
    for batch in batches:
        for i, j in slices(batch.column("text")):
            terms, back, text = slice_terms(batch.column("text").slice(i, j - i))
            langs, sources = (batch.column(c).slice(i, j - i).dictionary_encode() for c in ("lang", "source"))
            lang, source = (c.indices.to_numpy().astype(np.int64)[text] for c in (langs, sources))
            n, many = max(1, len(terms)), max(1, len(sources.dictionary))
            key, count = np.unique((lang * many + source) * n + back, return_counts=True)
            group, term = key // n, key % n
            names = sources.dictionary.to_pylist()
            for code, name in enumerate(langs.dictionary.to_pylist()):
                a, b = np.searchsorted(group, [code * many, (code + 1) * many])
                asked = np.unique(term[a:b])
                for sub, places, slot, width in shards.find(name, terms.take(pa.array(asked))):
                    to = np.full(n, -1, np.int64)
                    to[asked[places]] = slot
                    own = a + np.flatnonzero(to[term[a:b]] >= 0)
                    opens = np.flatnonzero(np.r_[True, group[own][1:] != group[own][:-1]]) if len(own) else np.zeros(0, np.int64)
                    for x, y in zip(opens.tolist(), np.r_[opens[1:], len(own)].astype(int).tolist()):
                        at = (name, names[int(group[own[x]]) % many], sub)
                        if at not in total:
                            total[at] = np.zeros(width, np.uint32)
                            slots += width
                        total[at][to[term[own[x:y]]]] += count[own[x:y]].astype(np.uint32)
            if slots > held:
                yield from sent()
                slots = 0
    yield from sent()


# Shares ---------------------------------------------------------------------------------------


def shares(counts: np.ndarray, n: int, kept: int) -> np.ndarray:
    """1 + floor(WHOLE (count + 1) / (n + kept)), exact up to 9 * 10^15 occurrences: three digits at a time."""
    rest, out = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // (n + kept)
        rest = rest % (n + kept)
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _counts(width: int, cells: bytes | None) -> np.ndarray:
    total = np.zeros(width, np.int64)
    if cells is not None:
        add_sparse(total, cells)
    return total


PAIRS = "lang string, source string, item string, value long"


def compare(key: tuple, table: pa.Table) -> pa.Table:
    """What a shard adds to the values of pairs of sources, of one block or of two."""
    rows = table.to_pylist()
    p = [shares(_counts(r["width"], r["cells"]), r["n"], r["kept"]) for r in rows]
    one, two = key[2].as_py(), key[3].as_py()
    out = []
    for i, r in enumerate(rows):
        for j, s in enumerate(rows):
            if i != j and (one == two or r["block"] != s["block"]):
                out.append((r["lang"], r["source"], s["source"], int(distance(p[i], p[j]).sum())))
    columns = list(zip(*out)) or [()] * 4
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(("lang", "source", "item", "value"), columns, kinds)})


def best_slots(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """(lang, source, sub, slot, value): of each shard of a source, the `top` slots of terms that it has more of than its language."""
    for batch in batches:
        for r in batch.to_pylist():
            own, all_ = _counts(r["width"], r["cells"]), _counts(r["width"], r["lang_cells"])
            p, q = shares(own, r["n"], r["kept"]), shares(all_, r["lang_n"], r["kept"])
            slot = np.flatnonzero((own > 0) & (p > q))
            value = distance(p[slot], q[slot])
            first = np.lexsort((unpacked(r["places"])[0][slot], -value))[:top]
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["lang"]] * n, pa.string()), pa.array([r["source"]] * n, pa.string()), pa.array([r["sub"]] * n, pa.int64()), pa.array(slot[first]), pa.array(value[first])],
                names=["lang", "source", "sub", "slot", "value"],
            )


# Operator -------------------------------------------------------------------------------------


def kept_terms(rows: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, hash) of the terms in at least `least` documents of their language, counted exactly."""
    counted = rows.select("lang", "text").mapInArrow(document_counts, "lang string, term string, hash long, documents long")
    return counted.groupBy("lang", "term", "hash").agg(F.sum("documents").alias("documents")).filter(F.col("documents") >= least).drop("documents")


def slot_counts(rows: DataFrame, shards: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, held: int = HELD_SLOTS) -> DataFrame:
    """(lang, source, sub, width, amount, cells) of `rows` (lang, source, text), for all shards with at least one occurrence.

    Hashes of `broadcast_bytes` at most, and at least one shard, travel at a time; each such block is a pass over `rows`.
    """
    size = shards.agg(F.sum(F.octet_length("bits") + F.expr("aggregate(terms, 0L, (n, t) -> n + octet_length(t) + 4)"))).first()[0] or 0
    passes = max(1, -(-size // broadcast_bytes))
    out = None
    for k in range(passes):
        mine = shards.filter(F.pmod(F.xxhash64("lang", "sub"), F.lit(passes)) == k).select("lang", "sub", "subs", "bits", "terms")
        sent = rows.sparkSession.sparkContext.broadcast([(r[0], r[1], r[2], bytes(r[3]), _flat(r[4])) for r in mine.collect()])
        block = rows.select("lang", "source", "text").mapInArrow(lambda batches, sent=sent: count_slots(batches, Shards(sent.value), held), COUNTS)
        out = block if out is None else out.unionAll(block)
    return added(out, ["lang", "source", "sub"])


def _flat(terms: list[str]) -> bytes:
    data, at = text_bytes(pa.array(terms, pa.string()))
    return packed(at.astype(np.int32), data)


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP,
    shard_terms: int = SHARD_TERMS, broadcast_bytes: int = BROADCAST_BYTES, block_sources: int = BLOCK_SOURCES, held: int = HELD_SLOTS,
) -> DataFrame:
    """lang, source, part, item, value, rank for every (language, source) that occurs in `docs`.

    Terms are runs of ASCII letters and characters beyond ASCII, A to Z in lower case. A language keeps the terms in at
    least `least` of its documents. A source's or a language's share of a kept term is 1 + floor(10^9 (count + 1) / (N + V)),
    N being its occurrences of kept terms and V their number in the language; terms that a source hasn't got count as well.

    part `pair`: item is another source of the language, value the sum over all kept terms of floor((p - q)^2 / q), p and
    q being the shares of source and item; 0 without kept terms. All are ranked. part `term`: item is a term that the source
    has and whose share is greater than the language's, value the same with the language's share as q; ranks to `top`.
    Ranks begin at 1 in each source and part, greatest value first, equal ones by the bytes of item.

    Null texts, languages and sources are empty ones; each row is a document, also a repeated one. A source without kept
    terms has pairs only, the only source of a language no pairs. An empty table gives an empty one. Other columns are not read.
    """
    empty = F.lit("")
    rows = only(docs, text=text_col, lang=lang_col, source=source_col).select(*(F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")))
    kept = checkpoint(kept_terms(rows, least))
    # one row a language: sent along, so that the terms of a language need not meet under its name
    sizes = broadcast_if_small(checkpoint(kept.groupBy("lang").agg(F.count("*").alias("kept"))))
    dealt = kept.join(sizes.select("lang", F.ceil(F.col("kept") / shard_terms).alias("subs")), "lang").withColumn("sub", F.pmod("hash", "subs"))
    built = checkpoint(dealt.select("lang", "sub", "subs", "term").groupBy("lang", "sub").applyInArrow(shard_of, SHARD))
    counts = checkpoint(slot_counts(rows, built, broadcast_bytes, held))

    groups = rows.select("lang", "source").distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("amount").alias("n"))
    zero = F.lit(0).cast("long")
    info = groups.join(own, ["lang", "source"], "left").join(sizes, "lang", "left")
    info = checkpoint(info.select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("kept", zero).alias("kept")))
    of_lang = info.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.ceil(F.count("*") / block_sources).cast("int").alias("blocks"))
    k = F.col("blocks")
    grid = (
        info.join(of_lang.drop("lang_n"), "lang")
        .join(built.select("lang", "sub", "width"), "lang")
        .join(counts.select("lang", "source", "sub", "cells"), ["lang", "source", "sub"], "left")
        .withColumn("block", F.pmod(F.xxhash64("source"), k).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )
    added_up = grid.groupBy("lang", "sub", "low", "high").applyInArrow(compare, PAIRS).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    none = info.filter("kept = 0").select("lang", "source")
    without = none.join(none.select(F.col("lang").alias("l"), F.col("source").alias("item")), F.col("lang") == F.col("l")).filter("source != item")
    pairs = added_up.unionAll(without.select("lang", "source", "item", zero.alias("value")))

    whole = added(counts, ["lang", "sub"]).select("lang", "sub", F.col("cells").alias("lang_cells"))
    shard = whole.join(built.select("lang", "sub", "places"), ["lang", "sub"])
    per_row = counts.join(info, ["lang", "source"]).join(of_lang.select("lang", "lang_n"), "lang").join(shard, ["lang", "sub"])
    found = per_row.mapInArrow(lambda batches: best_slots(batches, top), "lang string, source string, sub long, slot long, value long")
    names = built.select("lang", "sub", F.posexplode("terms").alias("slot", "item"))
    terms = found.join(names.withColumn("slot", F.col("slot").cast("long")), ["lang", "sub", "slot"]).select("lang", "source", "item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionAll(ranked(terms, "term").filter(F.col("rank") <= top))
