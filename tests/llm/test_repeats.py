from __future__ import annotations

from corpora import alike, empty, odd  # noqa: F401

from framegate.llm import repeats


def brute(rows, window):
    place = lambda i: (1 << 63) - 1 if i is None else i
    texts = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), words in zip(rows, texts):
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, (place(i), k)), (place(i), k))
    out = []
    for (i, _), words in zip(rows, texts):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < (place(i), k):
                gone.update(range(k, k + window))
        out.append((i, b" ".join(w for k, w in enumerate(words) if k not in gone).decode(), len(words), len(gone)))
    return sorted(out, key=str)


def test_against_brute_force(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for window, sizes in ((20, None), (3, repeats.Sizes(4, 23, 3)), (1, repeats.Sizes(3, 22, 2))):
        got = repeats.remove_repeats(odd, window=window, sizes=sizes)
        assert got.columns == ["doc_id", "text", "n_words", "n_removed"]
        assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows, window)


def test_a_full_sketch_loses_nothing(spark, odd, monkeypatch):
    # a sketch so small that every window is estimated to be repeated
    monkeypatch.setattr(repeats, "BLOCK_BITS", 2)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = repeats.remove_repeats(odd, window=4, sizes=repeats.Sizes(2, 2, 2))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows, 4)


def test_empty(empty):
    assert repeats.remove_repeats(empty).collect() == []


def test_words_that_a_polynomial_confuses(spark):
    x, y = alike()
    rest = " ".join(f"w{k}" for k in range(19))
    docs = spark.createDataFrame([(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, f"{x} {rest}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 20}
