from __future__ import annotations

import math
from collections import Counter

import pytest
from corpora import docs_of, empty, odd  # noqa: F401
from pyspark.sql import functions as F

from framegate.llm import lm


def events(text):
    words = (text or "").encode().lower().split()
    return list(zip(["edge", *words], [*words, "edge"]))


def brute(rows, wanted, folds, smoothing):
    """rows: (id, text); folds: the fold of each row."""
    count = Counter(w for _, t in rows for w in (t or "").encode().lower().split())
    single = {(f, c): Counter() for f in (0, 1) for c in (0, 1)}
    pair = {(f, c): Counter() for f in (0, 1) for c in (0, 1)}
    for (i, t), f in zip(rows, folds):
        for a, b in events(t):
            single[f, int(i in wanted)][b] += 1
            pair[f, int(i in wanted)][a, b] += 1
    size = len(count) + 2

    def log_p(f, c, a, b):
        alone = (single[f, c][b] + 1) / (sum(single[f, c].values()) + size)
        return math.log((pair[f, c][a, b] + smoothing * alone) / (single[f, c][a] + smoothing))

    out = []
    for (i, t), f in zip(rows, folds):
        own = events(t)
        out.append((i, len(own), round(sum(log_p(1 - f, 1, a, b) - log_p(1 - f, 0, a, b) for a, b in own) / len(own), 5)))
    return sorted(out, key=str)


def folds_of(docs):
    return [r[0] for r in docs.select(F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit("fold")), F.lit(2))).collect()]


def check(spark, docs, ids, **sizes):
    wanted = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, part int")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], set(ids) - {None}, folds_of(docs), 50.0)
    got = lm.cross_entropy_difference(docs, wanted, **sizes).collect()
    assert sorted([(r.doc_id, r.n_events, round(r.score, 5)) for r in got], key=str) == want


@pytest.mark.parametrize("part_bytes,owner_keys", [(1 << 20, 1 << 20), (4000, 50)])
def test_against_brute_force(spark, odd, part_bytes, owner_keys):
    check(spark, odd, [*range(100, 140, 3), 8, 100, None, 77777], part_bytes=part_bytes, owner_keys=owner_keys)


def test_every_word_of_a_large_vocabulary_counts(spark):
    """More words than any fixed table of some ten thousand; copies of a text under other ids share its fold."""
    texts = [" ".join(f"w{(37 * i + k) % 45_000}" for k in range(400)) for i in range(300)]
    docs = docs_of(spark, list(enumerate([*texts, *texts[:50]])))
    check(spark, docs, list(range(0, 350, 3)), part_bytes=100_000, owner_keys=20_000)


def test_long_words(spark):
    docs = docs_of(spark, [(i, " ".join(("ab" * 512, "ba" * 512)[(i >> k) & 1] for k in range(6))) for i in range(40)])
    check(spark, docs, list(range(0, 40, 3)), part_bytes=20_000, owner_keys=3)


def test_scores_tell_the_target_apart(spark):
    good = "the model learns from the data and the data is clean {0}"
    bad = "buy now cheap pills buy cheap now click here {0}"
    docs = docs_of(spark, [(i, (good if i % 2 else bad).format(i % 7)) for i in range(200)])
    wanted = spark.createDataFrame([(i,) for i in range(1, 120, 2)], "doc_id long")
    got = {r.doc_id: r.score for r in lm.cross_entropy_difference(docs, wanted).collect()}
    assert min(v for i, v in got.items() if i % 2) > max(v for i, v in got.items() if not i % 2)


def test_no_target_and_no_rows(spark, odd, empty):
    none = odd.select("doc_id").limit(0)
    assert lm.cross_entropy_difference(odd, none).count() == odd.count()
    assert lm.cross_entropy_difference(empty, none).collect() == []
