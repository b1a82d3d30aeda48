"""Tables with everything that can be odd about them."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, print long, part long, spans string, matches string, kept_id long"


def docs_of(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang). Columns that operators use inside are there as well, with other content."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] is not None else None, 7, 8, "s", "m", 9) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows(seed=0, n=40):
    """Nulls in id and text, empty texts, one long text, ties, repeated rows, copies, near copies and shared passages."""
    rng = random.Random(seed)
    words = ["the", "und", "Wort", "é", "naïve", "x1", "a", "bb", "ccc", "token"]
    line = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passage = line(25)
    rows = [(None, line(30)), (None, None), (None, passage), (5, None), (6, ""), (7, " \t\n "), (8, line(4000)), (9, "one"), (10, "one")]
    for i in range(n):
        text = line(rng.randrange(1, 60))
        if i % 4 == 0:
            text += "\n" + passage
        if i % 5 == 0 and len(rows) > 12:
            text = rows[-2][1] or ""
        rows.append((100 + i, text))
    return [*rows, rows[-1], rows[-1], (120, "another text of an id that is there already")]


@pytest.fixture()
def odd(spark):
    return docs_of(spark, odd_rows())


@pytest.fixture()
def empty(spark):
    return docs_of(spark, []).limit(0)


def alike(n=10):
    """Two words of 2 to the n letters that any polynomial in an odd base gives the same value modulo 2 to the 64."""
    x, y = "a", "b"
    for _ in range(n):
        x, y = x + y, y + x
    return x, y
