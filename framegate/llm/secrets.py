"""Secrets in texts: fixed patterns, and random-looking strings by two character Markov models.

Expressions of Spark SQL only. A pattern's places come from cutting the text at its matches: the lengths of pieces and
matches add up to positions. For the Markov part, transitions between characters are counted in labelled samples: values
that the patterns found are random strings, plain words, names and numbers are ordinary identifiers. A candidate's mean log-likelihood
ratio per transition decides, of the whole candidate or else of its best stretches: a key behind a path or a name is one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegate.llm.frames import fresh, only

# What the three kinds of known secrets look like, and the least length of the part that counts.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # maximal runs, so the least length can stand in the pattern
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "markov")

#: Characters of candidates, and the least length of one.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
#: Labelled as ordinary: words, names in capitals and numbers, also several joined by _ or -.
ORDINARY = r"^([A-Za-z][a-z]*|[A-Z]+|[0-9]+)([_-]([A-Za-z][a-z]*|[A-Z]+|[0-9]+))*$"
#: Documents that the models are trained on: about as many, chosen by a hash of the id.
SAMPLE_DOCUMENTS = 2_000
#: A candidate is random-looking if its mean log-likelihood ratio per transition is above this.
LEAST_RATIO = 0.7
#: Least characters of a stretch of a candidate, and how far its sum of ratios may fall below its highest before another stretch begins.
LEAST_STRETCH, MOST_FALL = 16, 10.0
#: Characters of candidates that join parts; a stretch is widened to the next ones.
JOINTS = "/=_+-"
#: Weight of the model of single characters in that of transitions, in observations.
SMOOTHING = 10.0
PLACEHOLDER = "[secret]"


def matched(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def places(text: Column, found: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches of a pattern, in code points."""
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, pair):
        a = acc["at"] + F.length(pair["gap"])
        b = a + F.length(pair["value"])
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(F.struct(a.alias("start"), b.alias("end"), pair["value"].alias("value")))).alias("out"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.when(F.size(found) == 0, start["out"]).otherwise(F.aggregate(pairs, start, step, lambda acc: acc["out"]))


def with_base_spans(docs: DataFrame, text: str, name: str) -> DataFrame:
    """`docs` with array<struct<start, kind, end, value>> of the three known kinds, by start, then kind."""
    found = {k: fresh(docs, f"found_{k}") for k in KINDS[:3]}
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # matches first: places are only worked out where there are any
    docs = docs.select("*", *(matched(value, p).alias(found[k]) for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX))))
    kept = {
        "assign": F.filter(places(value, F.col(found["assign"]), ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= ASSIGN_LEAST),
        "access": F.filter(places(value, F.col(found["access"]), ACCESS), lambda m: F.length(m["value"]) >= ACCESS_LEAST),
        "hex": places(value, F.col(found["hex"]), HEX),
    }

    def of_kind(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["value"].alias("value")))

    rows = [of_kind(k, spans) for k, spans in enumerate(kept.values())]
    return docs.withColumn(name, F.array_sort(F.concat(*rows))).drop(*found.values())


# Models ---------------------------------------------------------------------------------------


def codes(value: Column) -> Column:
    """The number of each character in ALPHABET."""
    return F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def transitions(strings: DataFrame, value: str) -> DataFrame:
    """(label, a, b, n): how often character b follows character a, for rows (label, value) of ALPHABET characters."""
    pair = F.arrays_zip(F.slice("codes", 1, F.size("codes") - 1).alias("a"), F.slice("codes", 2, F.size("codes") - 1).alias("b"))
    return (
        strings.filter(F.length(value) > 1)
        .withColumn("codes", codes(F.col(value)))
        .select("label", F.explode(pair).alias("p"))
        .groupBy("label", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
        .agg(F.count("*").alias("n"))
    )


def ratios(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCUMENTS) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) for all pairs of ALPHABET characters, one a after the other.

    Counts come from about `sample` documents. A model falls back on single characters, of which each has one count more;
    without any sample of a label its model is even.
    At most two counts a pair of characters reach the driver.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    n = rows.count()
    if n > sample:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(sample / n * (1 << 40)))
    spans = with_base_spans(rows, "text", "spans")
    secret = F.transform("spans", lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"]))
    random = spans.select(F.lit(1).alias("label"), F.explode(secret).alias("value")).withColumn("value", F.translate("value", ".", ""))
    words = spans.filter(F.size("spans") == 0).select(F.lit(0).alias("label"), F.explode(matched(F.col("text"), IDENTIFIER)).alias("value"))
    ordinary = words.filter(F.col("value").rlike(ORDINARY))
    size = len(ALPHABET)
    counts = [[[0] * size for _ in range(size)] for _ in range(2)]
    for r in transitions(random.unionAll(ordinary), "value").collect():
        counts[r["label"]][r["a"]][r["b"]] += r["n"]
    logs = []
    for own in counts:
        single = [1 + sum(row[b] for row in own) for b in range(size)]
        alone = [n / sum(single) for n in single]
        logs.append([math.log((row[b] + SMOOTHING * alone[b]) / (sum(row) + SMOOTHING)) for row in own for b in range(size)])
    return [a - b for a, b in zip(logs[1], logs[0])]


def cells(table: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")  # folded into one constant


def mean_ratio(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of a string of two or more ALPHABET characters."""

    def over(own: Column) -> Column:
        total = F.aggregate(
            own,
            F.struct(F.lit(-1).alias("before"), F.lit(0.0).alias("sum")),
            lambda acc, c: F.struct(
                c.alias("before"),
                (acc["sum"] + F.when(acc["before"] < 0, 0.0).otherwise(F.get(cells(table), acc["before"] * len(ALPHABET) + c))).alias("sum"),
            ),
            lambda acc: acc["sum"],
        )
        return total / (F.size(own) - 1)

    return over(codes(value))


RANGES = "array<struct<start:int,end:int>>"


def best_stretches(value: Column, table: list[float], least: float) -> Column:
    """Stretches of a string, of LEAST_STRETCH characters or more, whose mean ratio is above `least`, as array<struct<start, end>>.

    One pass with a running sum of ratios less `least`. The sum begins anew where it falls to 0, or MOST_FALL below its
    highest value; the stretch up to that highest value is one of the result.
    JOINTS say nothing here (ratio 0): ordinary samples hold words, so a path or a dash between words would look random.
    """
    table = [0.0 if {a, b} & set(JOINTS) else table[i * len(ALPHABET) + j] for i, a in enumerate(ALPHABET) for j, b in enumerate(ALPHABET)]
    none = F.array().cast(RANGES)
    add = lambda out, start, end: F.concat(out, F.array(F.struct(start.alias("start"), end.alias("end"))))
    state = lambda **x: F.struct(*(v.alias(k) for k, v in x.items()))
    zero = state(at=F.lit(0), before=F.lit(-1), start=F.lit(0), sum=F.lit(0.0), best=F.lit(0.0), end=F.lit(0), out=none)

    def step(acc, c):
        total = acc["sum"] + F.get(cells(table), acc["before"] * len(ALPHABET) + c) - least
        ends = (acc["before"] < 0) | (total <= 0) | ((acc["best"] > 0) & (total < acc["best"] - MOST_FALL))
        higher = (acc["at"] + 1 - acc["start"] >= LEAST_STRETCH) & (total > acc["best"])
        return state(
            at=acc["at"] + 1,
            before=c,
            start=F.when(ends, acc["at"]).otherwise(acc["start"]),
            sum=F.when(ends, 0.0).otherwise(total),
            best=F.when(ends, 0.0).when(higher, total).otherwise(acc["best"]),
            end=F.when(higher & ~ends, acc["at"] + 1).otherwise(acc["end"]),
            out=F.when(ends & (acc["best"] > 0), add(acc["out"], acc["start"], acc["end"])).otherwise(acc["out"]),
        )

    finish = lambda acc: F.when(acc["best"] > 0, add(acc["out"], acc["start"], acc["end"])).otherwise(acc["out"])
    return F.aggregate(codes(value), zero, step, finish)


def random_parts(value: Column, table: list[float], least: float) -> Column:
    """What is random-looking in a candidate, as array<struct<start, end>>: all of it if that is above `least`.

    Otherwise its parts between JOINTS that have LEAST_STRETCH characters and are above `least`, which finds a key as well
    as if it stood alone, and for keys that hold JOINTS the best stretches, widened to the next ones. Overlapping ones become one.
    """
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length(value).alias("end")))
    joined = F.translate(value, JOINTS, JOINTS[0] * len(JOINTS))

    def wide(s):
        before = F.substring_index(F.substring(joined, F.lit(1), s["start"]), JOINTS[0], -1)
        after = F.substring_index(F.substring(joined, s["end"] + 1, F.length(value)), JOINTS[0], 1)
        return F.struct((s["start"] - F.length(before)).alias("start"), (s["end"] + F.length(after)).alias("end"))

    def part(acc, p):
        end = acc["at"] + F.length(p)
        own = F.when(F.length(p) >= LEAST_STRETCH, mean_ratio(p, table)) > least
        out = F.when(own, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"))))).otherwise(acc["out"])
        return F.struct((end + 1).alias("at"), out.alias("out"))

    pieces = F.split(value, f"[{JOINTS[:-1]}\\{JOINTS[-1]}]", -1)
    parts = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast(RANGES).alias("out")), part, lambda acc: acc["out"])

    def merge(out, s):
        last = F.element_at(out, -1)
        longer = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(F.size(out) == 0, F.array(s)).when(s["start"] < last["end"], longer).otherwise(F.concat(out, F.array(s)))

    every = F.array_sort(F.concat(parts, F.transform(best_stretches(value, table, least), wide)))
    return F.when(mean_ratio(value, table) > least, whole).otherwise(F.aggregate(every, F.array().cast(RANGES), merge))


# Operators ------------------------------------------------------------------------------------


def with_spans(docs: DataFrame, table: list[float], text_col: str = "text", name: str = "spans", least: float = LEAST_RATIO) -> DataFrame:
    """`docs` with array<struct<start, kind, end>> of all secrets, by start, then kind (its place in KINDS).

    The known kinds stay as they are; the models add candidates, or parts of them, that overlap none of them.
    """
    base, found, places_col = (fresh(docs, x) for x in ("base_spans", "found_candidates", "candidate_places"))
    value = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = with_base_spans(docs, text_col, base)
    docs = docs.withColumn(found, matched(value, CANDIDATE))
    # the models read matches, which is cheap, before places are worked out
    docs = docs.withColumn(
        places_col,
        F.when(F.exists(found, lambda v: F.size(random_parts(v, table, least)) > 0), places(value, F.col(found), CANDIDATE)),
    )
    apart = lambda m: ~F.exists(F.col(base), lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    moved = lambda m: lambda p: F.struct((m["start"] + p["start"]).alias("start"), (m["start"] + p["end"]).alias("end"))
    parts = F.flatten(F.transform(F.coalesce(F.col(places_col), F.array()), lambda m: F.transform(random_parts(m["value"], table, least), moved(m))))
    own = F.filter(parts, apart)
    span = lambda kind: lambda m: F.struct(m["start"].alias("start"), kind(m).alias("kind"), m["end"].alias("end"))
    both = F.concat(F.transform(base, span(lambda m: m["kind"])), F.transform(own, span(lambda m: F.lit(3))))
    return docs.withColumn(name, F.array_sort(both)).drop(base, found, places_col)


def of_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """doc_id and spans (start, kind, end in code points) of every row of `docs`; other columns are not read.

    A null text is empty and has no spans. Equal texts have equal spans; rows are neither dropped nor merged. In an
    empty table the models are even, and the result is empty.
    """
    return with_spans(only(docs, doc_id=id_col, text=text_col), ratios(docs, id_col, text_col, sample)).select("doc_id", "spans")


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """`docs` with a placeholder for each secret in the text (overlapping ones become one); all rows and columns stay.

    A column `length_col`, if there is one, gets the new number of characters where a text has changed.
    """
    spans = fresh(docs, "secret_spans")
    found = with_spans(docs, ratios(docs, id_col, text_col, sample), text_col, spans)
    text = F.col(f"`{text_col}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        apart = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, F.concat(acc["out"], before, F.lit(PLACEHOLDER))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(F.col(spans), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    hit = F.size(spans) > 0
    new = fresh(found, "clean_text")
    found = found.withColumn(new, F.when(hit, clean).otherwise(text))

    def column(c: str) -> Column:
        if c == text_col:
            return F.col(new).alias(c)
        if c == length_col:
            return F.when(hit, F.length(new)).otherwise(F.col(f"`{c}`")).cast(docs.schema[c].dataType).alias(c)
        return F.col(f"`{c}`")

    return found.select(*(column(c) for c in docs.columns))
