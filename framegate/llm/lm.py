"""Cross-entropy difference: how much better a model of wanted text predicts a document than one of all other text.

Two bigram models of the same vocabulary, order and smoothing are counted, one on target documents and one on the others.
The vocabulary is every word of every document. Texts are dealt out to parts of bounded size; a part sends each owner of a
range of keys, hashes of words and of word pairs, one compressed message with its counts, the owner adds up what all parts
have sent, and answers each part with the sums of the keys that it has. Parts belong to one of two folds by their text, and
are answered from the counts of the other fold: no document is scored by a model that has seen it or a copy of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framegate.llm.frames import filled, only, slices, text_bytes
from framegate.llm.messages import packed, small, steps, unpacked
from framegate.llm.words import LOWER, NOT_SPACE, mixed, scan, word_values

#: Weight of the model of single words in that of pairs, in observations.
SMOOTHING = 50.0
PART_BYTES = 8 << 20
#: Messages of an owner hold about so many different words and pairs.
OWNER_KEYS = 2 << 20
BYTES_A_WORD = 6

DOCS = {"doc_id": pa.int64(), "text": pa.string()}
MESSAGE = "owner long, part long, counts binary"
#: An answer to a part, or with part -1 what an owner's words add up to: their number, and their occurrences by fold and class.
ANSWER = "part long, owner long, counts binary, words long, n0 long, n1 long, n2 long, n3 long"
#: The key of the edge of a text. Keys of words are even, those of pairs odd.
EDGE = np.uint64(0x9E3779B97F4A7C14)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _targets(docs: pa.Table, labels: pa.Table) -> np.ndarray:
    """Which rows have an id that is labelled as wanted."""
    import pyarrow.compute as pc

    wanted = filled(labels, doc_id=pa.int64()).column("doc_id").drop_null()
    return pc.is_in(docs.column("doc_id"), value_set=wanted.combine_chunks() if len(wanted) else pa.array([], pa.int64())).to_numpy(zero_copy_only=False)


def _texts(table: pa.Table) -> pa.Array:
    return table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())


def _values(texts: pa.Array):
    """Word values of all texts, and the words of each text."""
    values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in slices(texts):
        data, at = text_bytes(texts.slice(i, j - i))
        data = LOWER[data]
        words = scan(data, at, NOT_SPACE)
        values.append(word_values(data, words))
        counts.append(words.counts)
    return np.concatenate(values), np.concatenate(counts)


class PartKeys:
    """The words and pairs of a part's texts; an event is a word or the end of a text.

    words and pairs are distinct keys, `word` the word of each event, `pair` its pair with the word before, before and
    after the words of each distinct pair, events their number in each text.
    """

    def __init__(self, texts: pa.Array):
        values, count = _values(texts)
        n = len(count)
        self.events = count + 1
        # a text is its words with an edge after them; the word before the first one is the edge of the text before
        line = np.full(len(values) + n, EDGE, np.uint64)
        line[np.arange(len(values)) + np.repeat(np.arange(n), count)] = values & ~np.uint64(1)
        self.words, self.word = np.unique(line, return_inverse=True)
        size = max(1, len(self.words))
        edge = np.searchsorted(self.words, EDGE)
        number = np.r_[edge, self.word[:-1]].astype(np.int64)[: len(line)] * size + self.word
        both, self.pair = np.unique(number, return_inverse=True)
        self.before, self.after = np.divmod(both, size)
        self.pairs = mixed(self.words[self.before] * _ODD + mixed(self.words[self.after])) | np.uint64(1)
        self.order = np.argsort(np.concatenate([self.words, self.pairs]), kind="stable")

    def keys(self) -> np.ndarray:
        return np.concatenate([self.words, self.pairs])[self.order]

    def counts(self, among: np.ndarray) -> np.ndarray:
        """How often each key is there in the events `among`, in the order of `keys`."""
        word = np.bincount(self.word[among], minlength=len(self.words))
        return np.concatenate([word, np.bincount(self.pair[among], minlength=len(self.pairs))])[self.order]

    def told(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums in the order of `keys` as those of words and those of pairs."""
        back = np.zeros(len(self.order))
        back[self.order] = sums
        return back[: len(self.words)], back[len(self.words) :]


def key_messages(part: int, docs: pa.Table, labels: pa.Table, bits: int) -> pa.Table:
    """One row for each owner with the keys of its range, ascending, and their counts in the background and the target."""
    docs = filled(docs, **DOCS)
    own = PartKeys(_texts(docs))
    target = np.repeat(_targets(docs, labels), own.events)
    keys, counts = own.keys(), (own.counts(~target), own.counts(target))
    owner = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    opens = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    ends = np.r_[opens[1:], len(owner)].astype(int)
    sent = [packed(steps(keys[a:b]), *(small(c[a:b]) for c in counts)) for a, b in zip(opens, ends)]
    return pa.table(
        {"owner": pa.array(owner[opens], pa.int64()), "part": pa.array(np.full(len(opens), part), pa.int64()), "counts": pa.array(sent, pa.binary())}
    )


def answer_keys(table: pa.Table) -> pa.Table:
    """Each message's keys with their sums in the other fold, by class, and a row for what the words add up to."""
    parts = table.column("part").to_numpy()
    sent = [unpacked(x.as_py()) for x in table.column("counts")]
    keys = [np.cumsum(s[0], dtype=np.uint64) for s in sent]
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    places = np.split(back, np.cumsum([len(k) for k in keys])[:-1])
    total = np.zeros((2, 2, len(every)), np.int64)
    for part, (_, *counts), place in zip(parts.tolist(), sent, places):
        for which in (0, 1):
            np.add.at(total[part % 2, which], place, counts[which].astype(np.int64))
    answers = [packed(*(small(total[1 - part % 2, which, place]) for which in (0, 1))) for part, place in zip(parts.tolist(), places)]
    word = every & np.uint64(1) == 0
    n = len(answers)
    sums = {"words": int(word.sum())} | {f"n{k}": int(total[k // 2, k % 2, word].sum()) for k in range(4)}
    return pa.table(
        {
            "part": pa.array([*parts.tolist(), -1], pa.int64()),
            "owner": pa.array([*table.column("owner").to_pylist(), None], pa.int64()),
            "counts": pa.array([*answers, None], pa.binary()),
            **{c: pa.array([None] * n + [v], pa.int64()) for c, v in sums.items()},
        }
    )


def score_part(part: int, docs: pa.Table, answers: pa.Table, smoothing: float) -> pa.Table:
    """log P(word | word before) of the target less that of the background, meant over the events of each text.

    Each answer also has the number of words, the edge among them, and all events by fold and class.
    """
    answers = filled(answers, owner=pa.int64(), counts=pa.binary())
    own = PartKeys(_texts(docs))
    # every text has an edge, so a part with rows has an answer; one word that was never seen is counted in
    size = answers.column("words")[0].as_py() + 1 if answers.num_rows else 1
    events = [answers.column(f"n{k}")[0].as_py() if answers.num_rows else 0 for k in range(4)]
    order = np.argsort(answers.column("owner").to_numpy(), kind="stable")
    told = [unpacked(answers.column("counts")[int(k)].as_py()) for k in order]
    logs = []
    for which in (0, 1):
        one, n = own.told(np.concatenate([np.zeros(0), *(t[which] for t in told)]))
        alone = (one[own.after] + 1) / (events[2 * (1 - part % 2) + which] + size)
        logs.append(np.log((n + smoothing * alone) / (one[own.before] + smoothing)))
    total = np.r_[0.0, np.cumsum((logs[1] - logs[0])[own.pair])]
    end = np.cumsum(own.events)
    return pa.table({"doc_id": docs.column("doc_id"), "n_events": pa.array(own.events), "score": (total[end] - total[end - own.events]) / own.events})


def cross_entropy_difference(
    docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text", wanted_id: str = "doc_id",
    smoothing: float = SMOOTHING, part_bytes: int = PART_BYTES, owner_keys: int = OWNER_KEYS,
) -> DataFrame:
    """doc_id, n_events (words and the end of the text) and score of every row of `docs`.

    score is the loss of the background model less that of the target model, per event: above 0, the text is more like
    the documents whose ids `wanted` lists. Ids are whole numbers; ids that `wanted` repeats count once, null ones not at
    all. A document without id is background. A null or empty text is scored by its end alone. Rows are neither dropped
    nor merged (repeated ones count as often as they are there), an empty table gives an empty one, an empty `wanted`
    leaves an even target model. Other columns are not read. Words and pairs are told apart by 63 bits of a hash.
    """
    rows = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lanes, owners = max(1, -(-size // (2 * part_bytes))), max(1, size // BYTES_A_WORD // owner_keys)
    bits = (owners - 1).bit_length()
    # equal texts are of one fold; of a fold, rows are dealt out by their ids, so that copies are spread
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit("fold")), F.lit(2))
    lane = F.pmod(F.xxhash64("doc_id"), F.lit(lanes))
    dealt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(lanes))).otherwise(lane)
    rows = rows.withColumn("part", 2 * dealt + fold)
    ids = only(wanted, doc_id=wanted_id).select(F.col("doc_id").cast("long")).dropna().distinct()
    labels = ids.withColumn("part", F.explode(F.array(2 * lane, 2 * lane + 1)))
    sent = rows.groupBy("part").cogroup(labels.groupBy("part")).applyInArrow(
        lambda key, d, w: key_messages(key[0].as_py(), d, w, bits), MESSAGE
    )
    answers = sent.groupBy("owner").applyInArrow(answer_keys, ANSWER)
    columns = ("words", "n0", "n1", "n2", "n3")
    # One row, which goes with every answer; the messages are exchanged once for both.
    sums = answers.filter("part < 0").agg(F.struct(*(F.sum(c).alias(c) for c in columns)).alias("sums")).scalar()
    told = answers.filter("part >= 0").select("part", "owner", "counts", sums.alias("sums")).select("part", "owner", "counts", "sums.*")
    return rows.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(
        lambda key, d, a: score_part(key[0].as_py(), d, a, smoothing), "doc_id long, n_events long, score double"
    )
