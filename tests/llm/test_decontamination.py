from __future__ import annotations

import re

from corpora import alike, docs_of, empty, odd_rows  # noqa: F401

from framegate.llm import decontamination

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window):
    windows = {}
    for name, text in items:
        w = words_of(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1) if size else ():
            windows.setdefault(tuple(w[k : k + size]), set()).add(None if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, found = words_of(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                names = windows.get(tuple(w[k : k + size]))
                if names:
                    found |= names
                    hit.update(range(k, k + size))
        out.append((i, len(w), len(hit), sorted(x for x in found if x is not None), bool(found)))
    return sorted(out, key=str)


def setting(spark):
    rows = odd_rows()
    texts = [t for _, t in rows if t]
    items = [(1, " ".join(texts[0].split()[3:20])), (11, texts[5][:60]), (2, "ONE"), (3, None), (4, ""), (4, "one"), (None, " ".join(texts[2].split()[:12])), (9, "x1 a bb")]
    bench = spark.createDataFrame([(i, t, "m") for i, t in items], "item_id long, text string, matches string")
    return docs_of(spark, [*rows, (900, "They say: ONE, two")]), bench, items


def test_against_brute_force(spark):
    docs, bench, items = setting(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for window, block_bytes in ((10, 1 << 20), (3, 40), (25, 1 << 20)):
        got = decontamination.contamination(docs, bench, window=window, block_bytes=block_bytes)
        assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got.collect()], key=str) == brute(rows, items, window)


def test_longest_matches(spark):
    docs = docs_of(spark, [(1, "zero A b c d e f, g? tail b c d")])
    bench = spark.createDataFrame([(7, "x a b c d e f g y")], "item_id long, text string")
    got = decontamination.contamination(docs, bench, window=3).first()
    assert [tuple(m) for m in got.matches] == [("7", 1, 1, 7), ("7", 2, 9, 3)]


def test_contaminated_rows_go(spark, empty):
    docs, bench, items = setting(spark)
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    bad = {(i, t) for (i, t) in rows if brute([(i, t)], items, 10)[0][4]}
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted([r for r in rows if r not in bad], key=str)
    assert decontamination.drop_contaminated(empty, bench).collect() == []
    assert decontamination.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_many_numbers_in_a_key(spark):
    """More benchmark words than fit in 16 bits."""
    texts = [" ".join(f"w{k}" for k in range(a, a + 30)) for a in range(0, 66_000, 30)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = docs_of(spark, [(1, f"a {texts[3]} b {texts[2000]}"), (2, "w1 w2")])
    got = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontamination.contamination(docs, bench).collect()}
    assert got == {1: (60, ["2000", "3"]), 2: (0, [])}


def test_words_that_a_polynomial_confuses(spark):
    x, y = alike()
    docs = spark.createDataFrame([(1, f"{x} a b c d e f g h i"), (2, f"{y} a b c d e f g h i")], "doc_id long, text string")
    items = spark.createDataFrame([("k", f"{x} a b c d e f g h i")], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontamination.contamination(docs, items).collect()} == {1: 10, 2: 0}
