from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from corpora import alike, docs_of, empty, odd  # noqa: F401

from framegate.llm import jaccard


def brute_set(text, n=3):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, n=3, least=(9, 10)):
    """Rows (doc_id, n_shingles, component_id)."""
    sets = [brute_set(t, n) for _, t in rows]
    label = list(range(len(sets)))
    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a], sets[b]
        if label[a] != label[b] and x and len(x & y) * least[1] >= len(x | y) * least[0]:
            old, new = label[b], label[a]
            label = [new if k == old else k for k in label]
    first = {}
    for (i, _), k in zip(rows, label):
        if i is not None:
            first[k] = min(first.get(k, i), i)
    return sorted(((i, len(s), first.get(k)) for (i, _), s, k in zip(rows, sets, label)), key=str)


def planted(seed=5, groups=40, hot=100):
    """Chains of copies around the threshold, and a large group of near copies of one text, some of them linked by others only."""
    rng = random.Random(seed)
    line = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for k in range(groups):
        words = line(rng.choice((9, 11, 12, 40, 200)))
        rows.append(" ".join(words))
        for _ in range(1 + k % 4):
            words = list(words)
            for _ in range(rng.randrange(1, 1 + max(1, len(words) // 40))):
                words[rng.choice((0, -1, rng.randrange(len(words))))] = f"n{rng.randrange(5000)}"
            rows.append(" ".join(words))
    base = line(150)
    for _ in range(hot):
        other = list(base)
        for _ in range(rng.randrange(6)):
            other[rng.randrange(150)] = f"n{rng.randrange(5000)}"
        rows.append(" ".join(other))
    rows += rows[:20]
    rng.shuffle(rows)
    return list(enumerate(rows))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"bucket_rows": 10, "piece": 500, "cell_bits": 8}])
def test_equal_to_all_pairs(spark, limits):
    rows = planted()
    want = brute(rows)
    assert 60 < len({r[2] for r in want}) < len(rows) - 60
    assert found(jaccard.linked(docs_of(spark, rows), **limits)) == want


def test_other_thresholds(spark):
    rows = planted(seed=6, groups=25, hot=40)
    assert found(jaccard.linked(docs_of(spark, rows), words=2, least=(7, 10))) == brute(rows, 2, (7, 10))


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(jaccard.linked(odd)) == brute(rows)
    assert jaccard.linked(empty).collect() == []
    x, y = alike()
    rest = " ".join(f"w{k}" for k in range(60))
    assert [r[2] for r in found(jaccard.linked(docs_of(spark, [(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, x), (4, y)])))] == [1, 1, 3, 4]


def test_many_copies_under_no_id(spark):
    rows = [(None, "a b c d e f g h i j k l"), *[(None, "a b c d e f g h i j k l m")] * 50, (5, "A b c d e f g h i j k l m")]
    assert found(jaccard.linked(docs_of(spark, rows))) == brute(rows)


def test_no_filter_loses_a_similar_pair():
    """At the first shared n-gram of their prefixes, a similar pair passes; the bounds are never over what they bound."""
    rng, at = np.random.default_rng(1), 0
    base = [" ".join(rng.choice(400, 60).astype(str)) for _ in range(20)]
    texts = base + [" ".join([*t.split()[:-1], str(k)]) for k, t in enumerate(base)] + [" ".join(t.split()[:56]) for t in base]
    sets = jaccard.sets_of(pa.array(texts))
    front = jaccard.prefixes(sets, rng.integers(0, 5, 256).astype(np.uint8))
    size = np.diff(sets.at)
    counts = jaccard.counted(sets.value, np.repeat(np.arange(len(size)), size), len(size))
    batch = pa.RecordBatch.from_pydict(
        {"node": list(range(len(size))), "size": size.tolist(), "keys": [front.value[a:b].view(np.int64).tolist() for a, b in zip(front.at[:-1], front.at[1:])], "counts": pa.array(counts.tolist(), pa.list_(pa.int32()))}
    )
    bits = jaccard.parities(sets.value, np.repeat(np.arange(len(size)), size), len(size))
    assert (jaccard.from_binary(jaccard.as_binary(bits)) == bits).all()
    rows = next(jaccard.entries(iter([batch]))).to_pylist()
    for r in rows:
        r["left"] = jaccard.from_bytes(np.array([r["left"]]))[0]
    own = {(r["node"], r["key"]): r for r in rows}
    keys = [list(front.value[a:b].view(np.int64).tolist()) for a, b in zip(front.at[:-1], front.at[1:])]
    for i, j in combinations(range(len(texts)), 2):
        x, y = brute_set(texts[i]), brute_set(texts[j])
        assert np.bitwise_count(bits[i] ^ bits[j]).sum() <= len(x ^ y)
        if len(x & y) * 10 < len(x | y) * 9:
            continue
        at += 1
        a, b = (i, j) if size[i] <= size[j] else (j, i)
        key = next(k for k in keys[a] if k in keys[b])
        two = [own[a, key], own[b, key]]
        bucket = jaccard.Bucket(*(np.array([r[c] for r in two]) for c in ("node", "size", "place", "left")))
        assert bucket.passes(0, np.array([1])).all() and jaccard.passing(bucket, jaccard.LEAST)[0, 1]
        assert two[0]["place"] + two[1]["place"] + np.abs(bucket.left[0] - bucket.left[1]).sum() <= len(x ^ y)
    assert at > 20
