from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from corpora import alike
from hypothesis import given, settings
from hypothesis import strategies as st

from framegate.llm import frames, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\x0b1-ß漢  ", max_size=30)), max_size=6)


@settings(deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    data, at = frames.text_bytes(column)
    for table, pattern in ((words.NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (words.LETTERS, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        own = words.LOWER[data] if table is words.LETTERS else data
        found = words.scan(own, at, table)
        raw = own.tobytes()
        want = [re.findall(pattern, (t or "").encode().lower() if table is words.LETTERS else (t or "").encode()) for t in texts]
        got = [raw[a:b] for a, b in zip(found.start, found.end)]
        assert got == [w for ws in want for w in ws]
        assert found.counts.tolist() == [len(w) for w in want]
        values = words.word_values(own, found)
        assert all((got[i] == got[j]) == (values[i] == values[j]) for i in range(len(got)) for j in range(i))
        begin, text = words.run_starts(found, 2)
        high, _ = words.run_values(values, begin, 2)
        runs = [(k, tuple(w[i : i + 2])) for k, w in enumerate(want) for i in range(len(w) - 1)]
        assert text.tolist() == [k for k, _ in runs]
        assert all((runs[i][1] == runs[j][1]) == (high[i] == high[j]) for i in range(len(runs)) for j in range(i))


@settings(deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_slices_hold_every_row_once(texts, most):
    column = pa.array(["x", *texts], pa.string()).slice(1)
    got = list(frames.slices(column, most))
    assert [i for a, b in got for i in range(a, b)] == list(range(len(texts)))


def test_runs_of_numbers():
    assert words.ranges(np.array([5, 1, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]
    assert words.covered(np.array([1, 2]), np.array([3, 4]), 6).tolist() == [False, True, True, True, False, False]


def test_fresh_name_and_refused_clash(spark):
    df = spark.createDataFrame([(1, "a")], "x long, X_ string")
    assert frames.fresh(df, "X") == "_X"
    import pytest

    with pytest.raises(ValueError):
        frames.with_text_columns(df, "X_", lambda: None, {"x": "long"})


def test_words_that_a_polynomial_confuses():
    x, y = alike()
    data, at = frames.text_bytes(pa.array([f"{x} {y} {x}", y]))
    found = words.scan(data, at, words.NOT_SPACE)
    for seed in (0, 1):
        values = words.word_values(data, found, seed)
        assert values[0] == values[2] != values[1] == values[3]
    own, back = words.distinct_words(data, found)
    assert own.to_pylist() == [x.encode(), y.encode()] and back.tolist() == [0, 1, 0, 1]


@settings(deadline=None)
@given(TEXTS)
def test_distinct_words_are_the_words(texts):
    data, at = frames.text_bytes(pa.array(texts, pa.string()))
    found = words.scan(data, at, words.NOT_SPACE, np.flatnonzero(data == ord("1")))
    own, back = words.distinct_words(data, found)
    assert [own[int(k)].as_py() for k in back] == [data.tobytes()[a:b] for a, b in zip(found.start, found.end)]
    assert len(set(own.to_pylist())) == len(own)
