"""Language identification by compression: the language whose sample text helps most to encode a text.

Each language gets a zstandard raw-content dictionary: pieces of labelled texts one after the other. A text is encoded
once with each of them and the smallest encoding wins. Long texts are encoded in pieces, so that the dictionary helps all
the way through, and short ones repeated, so that they have an encoding to measure at all.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framegate.llm.frames import fresh, only, with_text_columns

#: Labelled rows per language that make its dictionary, and characters taken of each: the bounds of the training sample.
SAMPLE_ROWS = 64
SAMPLE_CHARS = 2_000
LEVEL = 6
PIECE_BYTES = 4_096
SHORT_BYTES = 256
#: A text is rejected if the runner-up needs less than this share of bytes more.
NARROW = 0.005
UNKNOWN = "und"

NOT_LETTERS = re.compile(r"[\W\d_]+")


class Languages(NamedTuple):
    """Languages, those with more labelled rows first, and their dictionaries."""

    names: list[str]
    dictionaries: list[bytes]


def letters(text: str) -> str:
    """Lower-case words without digits, marks and line ends."""
    return NOT_LETTERS.sub(" ", text.lower()).strip()


def held_out(id_col: str = "doc_id", folds: int = 5):
    """Is the row kept from training? A row without an id is not held out, but not learned from either."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS
) -> Languages:
    """Dictionaries from at most `rows` labelled rows of each language, chosen by a hash of the id.

    Of a longer text, `chars` characters from a place that the hash names, anywhere in it. Every language is learned.
    Rows without id, text or language teach nothing; repeated ids count once. Without any labelled row there are no
    languages. What reaches the driver is at most rows x chars characters of each language.
    """
    labelled = only(docs, doc_id=id_col, text=text_col, lang=lang_col).dropna().filter(~held_out("doc_id"))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.approx_count_distinct("doc_id").alias("ids")).collect()
    sizes.sort(key=lambda r: (-r["count"], r["lang"]))
    if not sizes:
        return Languages([], [])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # twice the rows that are wanted of each language, about; a language's place in the hash range is a literal
    reach = F.create_map(*(x for r in sizes for x in (F.lit(r["lang"]), F.lit(int(min(1.0, 2 * rows / r["ids"]) * (1 << 40))))))
    some = labelled.withColumn("place", place).filter(F.col("place") < F.element_at(reach, F.col("lang")))
    at = 1 + F.pmod(F.xxhash64("doc_id", F.lit("at")), F.greatest(F.lit(1), F.length("text") - chars + 1))
    piece = F.substring("text", at.cast("int"), F.lit(chars))
    once = some.groupBy("lang", "place", "doc_id").agg(F.min(piece).alias("text"))
    first = once.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))).filter(F.col("k") <= rows)
    found: dict[str, list[tuple[int, str]]] = {}
    for r in first.select("lang", "k", "text").collect():
        found.setdefault(r["lang"], []).append((r["k"], letters(r["text"])))
    names = [r["lang"] for r in sizes if r["lang"] in found]
    return Languages(names, ["\n".join(t for _, t in sorted(found[n])).encode() for n in names])


def with_language(docs: DataFrame, languages: Languages, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the language of each text and a score from 0 to 1: the share of bytes the runner-up needs more.

    A null text, and one without any letter, is `und` with score 0, and so is every text if no language was learned.
    Of languages that encode a text equally well, the one with more labelled rows wins, at score 0. With a single
    learned language every other text has it with score 1.
    """
    names = languages.names

    def make():
        import zstandard

        coders = [
            zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for d in languages.dictionaries
        ]

        def one(text: str | None) -> tuple[str, float]:
            words = letters(text or "")
            if not coders or not any(c.isalpha() for c in words):
                return UNKNOWN, 0.0
            data = words.encode()
            if len(data) < SHORT_BYTES:
                data = (data + b" ") * (1 + SHORT_BYTES // (len(data) + 1))
            pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
            sizes = [sum(len(c.compress(p)) for p in pieces) for c in coders]
            best = min(range(len(sizes)), key=lambda k: (sizes[k], k))
            if len(sizes) == 1:
                return names[0], 1.0
            second = min(s for k, s in enumerate(sizes) if k != best)
            return names[best], (second - sizes[best]) / second

        def compute(texts: pa.Array) -> dict[str, pa.Array]:
            got = [one(t) for t in texts.to_pylist()]
            return {pred: pa.array([g[0] for g in got], pa.string()), score: pa.array([g[1] for g in got], pa.float64())}

        return compute

    return with_text_columns(docs, text_col, make, {pred: "string", score: "double"})


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected (unknown or a narrow margin) of every row of `docs`.

    Languages are learned from the labelled rows that are not held out; prediction sees the text alone. Rows are
    neither dropped nor merged, other columns are not read, an empty table gives an empty one.
    """
    found = with_language(only(docs, doc_id=id_col, text=text_col), train(docs, id_col, text_col, lang_col))
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", rejected(F.col("lang_pred"), F.col("score")).alias("rejected")
    )


def rejected(pred, score, narrow: float = NARROW):
    return (pred == UNKNOWN) | (score < narrow)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", narrow: float = NARROW) -> DataFrame:
    """`docs` without the rows whose language is unknown or told by a narrow margin only; columns stay as they are."""
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    found = with_language(docs, train(docs, id_col, text_col, lang_col), text_col, pred, score)
    return found.filter(~rejected(F.col(pred), F.col(score), narrow)).select(*(F.col(f"`{c}`") for c in docs.columns))
