from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpora import alike, empty, odd_rows  # noqa: F401

from framegate.llm import divergence, messages

SCHEMA = "doc_id long, text string, lang string, source string, n int, sub string, value string, rank string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "s", "v", "r") for i, t, lang, source in rows], SCHEMA)


def corpus(seed=3, n=120, sources=7):
    rng = random.Random(seed)
    words = ["the", "The", "naïve", "É", "漢字", "a1b", "x", "zz", "rare-word", *(f"t{chr(97 + k)}" for k in range(20))]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words[: rng.randrange(3, len(words))]) for _ in range(rng.randrange(0, 40)))
        rows.append((i, text, rng.choice(["en", "de", None, ""]), rng.choice([*(f"s{k}" for k in range(sources)), None])))
    rows += [(i, t, "zz", "odd") for i, t in odd_rows()] + [(1, "only once", "one", "a"), (1, "", "one", "b"), (2, None, "one", "c"), (3, "x y", "alone", "a")]
    return [*rows, rows[0], rows[0]]


def brute(rows, top=200):
    docs = [(lang or "", source or "", [w.decode() for w in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())]) for _, text, lang, source in rows]
    docs = [(lang, source, ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in ws]) for lang, source, ws in docs]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(w for d in docs if d[0] == lang for w in set(d[2]))
        kept = sorted(w for w, n in df.items() if n >= 3)
        counts = {s: Counter(w for d in docs if d[:2] == (lang, s) for w in d[2] if df[w] >= 3) for s in {d[1] for d in docs if d[0] == lang}}
        whole = sum(counts.values(), Counter())
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        far = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(t, sum(far(p[s][w], p[t][w]) for w in kept)) for t in counts if t != s]
            terms = [(w, far(p[s][w], q[w])) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"shard_terms": 4, "broadcast_bytes": 300, "block_sources": 2, "held": 10, "top": 3}])
def test_equal_to_plain_counts(spark, limits):
    rows = corpus()
    got = sorted(tuple(r) for r in divergence.audit(docs_of(spark, rows).repartition(3), **limits).collect())
    assert got == brute(rows, limits.get("top", 200))


def test_no_terms_and_empty(spark, empty):
    rows = [(1, None, "en", "a"), (2, "12 !", "en", "b"), (3, "x", "de", "a")]
    got = sorted(tuple(r) for r in divergence.audit(docs_of(spark, rows)).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == brute(rows)
    assert divergence.audit(empty).collect() == []


def test_perfect_hash():
    x, y = alike()
    for n in (0, 1, 2, 70, 5000):
        terms = pa.array([f"t{k}".encode() for k in range(n)] + ([x.encode(), y.encode()] if n else []), pa.binary())
        made = divergence.perfect_hash(terms)
        hashes = divergence.term_values(terms), divergence.term_values(terms, 1)
        slots = made.slots(terms, *hashes)
        assert sorted(slots.tolist()) == list(range(len(terms))) and made.keys.take(pa.array(slots)).equals(terms)
        others = pa.array([f"u{k}".encode() for k in range(500)], pa.binary())
        assert (made.slots(others, divergence.term_values(others), divergence.term_values(others, 1)) == -1).all()


def test_shares_are_exact():
    for count, n, kept in ((0, 0, 1), (5, 17, 4), (10**12, 10**13 + 7, 10**6), (3 * 10**15, 8 * 10**15 + 1, 3)):
        assert divergence.shares(np.array([count]), n, kept)[0] == 1 + 10**9 * (count + 1) // (n + kept)


def test_added_arrays(spark):
    rng = np.random.default_rng(0)
    arrays = [(k % 3, rng.integers(0, 3, 50)) for k in range(40)]
    rows = spark.createDataFrame([(int(k), 50, int(a.sum()), messages.sparse(a)) for k, a in arrays], "k long, width long, amount long, cells binary").repartition(7)
    for r in messages.added(rows, ["k"]).collect():
        total = np.zeros(50, np.int64)
        messages.add_sparse(total, r.cells)
        want = sum(a for k, a in arrays if k == r.k)
        assert (total == want).all() and r.amount == want.sum()
