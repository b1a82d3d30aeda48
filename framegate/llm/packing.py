"""Token sequences of a fixed length from whole documents: first-fit decreasing in randomised groups.

Documents are turned into token ids where they lie, cut into pieces of at most a sequence, and dealt out to groups by a
hash. In each group the pieces, longest first, go to the first sequence with room, which a tournament tree over the room
of the sequences finds in as many steps as the tree is high. Groups have a bounded size and don't know of each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.llm.frames import only, text_bytes, with_text_columns
from framegate.llm.words import LOWER, NOT_SPACE, distinct_words, ranges, scan

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEQUENCE = 2048
#: Bytes of text of a group, about.
GROUP_BYTES = 8 << 20
#: Texts whose words are looked up together, and words whose ids a task remembers.
SLICE_BYTES = 2 << 20
REMEMBERED = 1 << 19
#: Unknown words are encoded so many at a time, with this mark between, which no other character turns into.
TOGETHER, BETWEEN = 128, "~"
#: Such texts that the tokenizer holds at a time.
BATCH = 128

PIECES = "array<struct<start:long,length:long,ids:binary>>"


# The tokenizer splits letters and digits from these marks wherever they meet. Apostrophes can begin an ending such as 's,
# and < | > a special token, so they stay with their word, and so does everything beside a character beyond ASCII.
MARK = np.zeros(256, bool)
MARK[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True
PLAIN = np.zeros(256, bool)
PLAIN[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


class Ids:
    """Token ids of words. The tokenizer never joins characters over white space, so each word has its own ids."""

    def __init__(self, path: str | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        # ids are kept and moved in as few bytes as they need
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        #: Where the ids of a word begin in `flat`, times 2 to the 32, and their number.
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, self.kind)

    def singly(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], self.kind), np.fromiter(map(len, found), np.int64, len(found))

    def flattened(self, texts: list[str]) -> np.ndarray:
        return np.concatenate([np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words without the mark BETWEEN: many go as one text, the mark's own id between them."""
        mark = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        if len(mark) != 1:
            return self.singly(words)
        texts = [f" {BETWEEN} ".join(words[k : k + TOGETHER]) + f" {BETWEEN}" for k in range(0, len(words), TOGETHER)]
        ids = np.concatenate([self.flattened(texts[k : k + BATCH]) for k in range(0, len(texts), BATCH)])
        ends = np.flatnonzero(ids == mark[0])
        return ids[ids != mark[0]], np.diff(ends, prepend=-1) - 1

    def learn(self, words: list[bytes]) -> None:
        apart = [w for w in words if BETWEEN.encode() in w]
        for mine, encode in (([w for w in words if BETWEEN.encode() not in w], self.together), (apart, self.singly)):
            if mine:
                ids, size = encode([w.decode() for w in mine])
                begin = len(self.flat) + np.cumsum(size) - size
                self.flat = np.concatenate([self.flat, ids])
                self.known.update(zip(mine, ((begin << 32) + size).tolist()))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id after it; n + 1 offsets)."""
        data, at = text_bytes(texts)
        raw = data.tobytes()
        if b"<|" not in raw:  # else a word could become a special token
            data = LOWER[data]  # as the tokenizer does anyway
            raw = data.tobytes()
        plain, mark = PLAIN[data], MARK[data]
        words = scan(data, at, NOT_SPACE, 1 + np.flatnonzero((plain[:-1] & mark[1:]) | (mark[:-1] & plain[1:])))
        distinct, back = distinct_words(data, words)
        distinct = distinct.to_pylist()
        if len(self.known) > REMEMBERED:
            self.forget()
        self.learn([w for w in distinct if w not in self.known])
        place = np.fromiter((self.known[w] for w in distinct), np.int64, len(distinct))[back]
        begin, size = place >> 32, place & ((1 << 32) - 1)
        # one more place after each text for the end id
        n = len(texts)
        slot = np.arange(len(back)) + np.repeat(np.arange(n), words.counts)
        starts, sizes = np.full(len(back) + n, len(self.flat)), np.ones(len(back) + n, np.int64)
        starts[slot], sizes[slot] = begin, size
        ids = np.append(self.flat, self.kind(END_ID))[ranges(starts, sizes)]
        total = np.r_[0, np.cumsum(sizes)]
        return ids, total[np.r_[0, words.first[1:] + np.arange(1, n + 1)]]


def with_pieces(docs: DataFrame, text: str, name: str, n_tokens: str, tokenizer: str | None, length: int) -> DataFrame:
    """`docs` without the texts, with the pieces of each text's ids, little-endian in 2 bytes an id (4 for vocabularies over 65,536)."""

    def make():
        coder = Ids(tokenizer)
        wide = np.dtype(coder.kind).itemsize

        def compute(texts: pa.Array) -> dict[str, pa.Array]:
            ids, at = coder.of(texts)
            count = np.diff(at)
            pieces = -(-count // length)
            held = np.r_[0, np.cumsum(pieces)]
            start = length * (np.arange(held[-1]) - np.repeat(held[:-1], pieces))
            size = np.minimum(length, np.repeat(count, pieces) - start)
            edge = np.r_[0, np.cumsum(size)] * wide
            raw = pa.BinaryArray.from_buffers(
                pa.binary(), len(size), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(ids.astype(ids.dtype.newbyteorder("<")))]
            )
            rows = pa.StructArray.from_arrays([pa.array(start), pa.array(size), raw], names=["start", "length", "ids"])
            return {name: pa.ListArray.from_arrays(pa.array(held.astype(np.int32)), rows), n_tokens: pa.array(count)}

        return compute

    return with_text_columns(docs, text, make, {name: PIECES, n_tokens: "long"}, SLICE_BYTES, keep_text=False)


def first_fit(sizes: list[int], room: int) -> list[int]:
    """The bin of each size, given in decreasing order: the first with room for it.

    A winner tree over bins, all empty at first: each node has the most room below it.
    """
    n = 1
    while n < len(sizes):
        n *= 2
    tree = [room] * (2 * n)
    out = []
    for size in sizes:
        k = 1
        while k < n:
            k *= 2
            if tree[k] < size:
                k += 1
        out.append(k - n)
        left = tree[k] - size
        tree[k] = left
        k //= 2
        while k:
            most = tree[2 * k] if tree[2 * k] >= tree[2 * k + 1] else tree[2 * k + 1]
            if tree[k] == most:
                break
            tree[k] = most
            k //= 2
    return out


def pack_group(group: int, size: np.ndarray, tie: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the pieces, sequence id, offset in the sequence): first-fit decreasing, equal sizes in the order of `tie`."""
    order = np.lexsort((tie, -size))
    size = size[order]
    whole = int((size == room).sum())  # these fill a sequence on their own
    bins = np.r_[np.arange(whole), whole + np.array(first_fit(size[whole:].tolist(), room), np.int64)].astype(np.int64)
    by_bin = np.argsort(bins, kind="stable")
    total = np.cumsum(size[by_bin]) - size[by_bin]
    opens = np.r_[True, bins[by_bin][1:] != bins[by_bin][:-1]] if len(bins) else np.zeros(0, bool)
    offset = total - np.repeat(total[opens], np.diff(np.r_[np.flatnonzero(opens), len(bins)]))
    return order[by_bin], (np.int64(group) << 32) + bins[by_bin], offset


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, length: int = SEQUENCE,
    group_bytes: int = GROUP_BYTES, seed: int = 42,
) -> DataFrame:
    """Pieces of all documents, each with its place: doc_id, start, length, ids, doc_tokens, sequence_id, offset, padded.

    ids is binary, little-endian unsigned 32-bit. A document's ids end with id 1; a null or empty text has that one only.
    `padded` is the length that the sequence is padded to: `length`, or its own length if that is a power of two. A
    document of more than `length` ids is cut into whole sequences and a rest; rests are packed with other documents.
    Repeated rows are packed as often as they are there; a null id is carried through. An empty table has no pieces.
    Columns other than the two named ones are not read. `tokenizer` is a path that every executor can open.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    # a task that is run again has the number it had, so rows of one id and text are dealt out as well
    salt = F.xxhash64(F.lit(seed), "doc_id", "text", F.spark_partition_id())
    pieces = (
        with_pieces(rows.withColumn("salt", salt), "text", "pieces", "doc_tokens", tokenizer, length)
        .select("doc_id", "salt", "doc_tokens", F.explode("pieces").alias("p"))
        .select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", F.xxhash64("salt", "p.start").alias("tie"))
        .withColumn("group", F.pmod("tie", F.lit(groups)))
    )

    def place(key: tuple, table: pa.Table) -> pa.Table:
        size = table.column("length").to_numpy()
        order, sequence, offset = pack_group(key[0].as_py(), size, table.column("tie").to_numpy(), length)
        table = table.take(pa.array(order))
        filled = np.bincount(np.unique(sequence, return_inverse=True)[1], weights=size[order]).astype(np.int64)
        own = filled[np.unique(sequence, return_inverse=True)[1]]
        padded = np.where(own & (own - 1) == 0, own, length)
        narrow = pc.sum(pc.binary_length(table.column("ids"))).as_py() == 2 * int(size.sum())
        ids = table.column("ids")
        if narrow:
            flat = np.frombuffer(b"".join(ids.to_pylist()), "<u2").astype("<u4")
            edge = np.r_[0, np.cumsum(size[order])] * 4
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(flat)])
        return pa.table(
            {
                "doc_id": table.column("doc_id"), "start": table.column("start"), "length": table.column("length"), "ids": ids,
                "doc_tokens": table.column("doc_tokens"), "sequence_id": sequence, "offset": offset, "padded": padded,
            }
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return pieces.groupBy("group").applyInArrow(
        place, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded long"
    )
