from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from corpora import alike, docs_of, empty, odd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from framegate.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
CODER = packing.Ids(None)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text(alphabet="aZé ß'st.,!-_<|>&~#12̣̈ Σς漢\n\x1c👍ﬁİ;`;`", max_size=30)), min_size=1, max_size=5))
def test_ids_are_those_of_the_whole_text(texts):
    ids, at = CODER.of(pa.array(texts, pa.string()))
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids + [packing.END_ID] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_special_tokens_and_endings():
    texts = ["a<|endoftext|>b <|ENDOFTEXT|> don't!'s ~x~ x~'t", "", "~"]
    ids, at = CODER.of(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [TOKENIZER.encode(t, add_special_tokens=False).ids + [1] for t in texts]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    coder = packing.Ids(None)
    for texts in (["one two three four"], ["two five six"], ["one two"]):
        ids, _ = coder.of(pa.array(texts))
        assert ids.tolist() == TOKENIZER.encode(texts[0], add_special_tokens=False).ids + [1]


@given(st.lists(st.integers(1, 20), max_size=60))
def test_first_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    room, want = [], []
    for s in sizes:
        k = next((k for k, r in enumerate(room) if r >= s), len(room))
        if k == len(room):
            room.append(20)
        room[k] -= s
        want.append(k)
    assert packing.first_fit(sizes, 20) == want


def test_every_id_lies_in_one_place(spark, odd):
    docs = odd.filter("doc_id is not null").unionAll(docs_of(spark, [(3000, None), (3000, "same"), (3000, "same")]))
    for length, group_bytes in ((64, 2000), (2048, 8 << 20)):
        rows = packing.pack(docs, length=length, group_bytes=group_bytes).collect()
        by, sequences = {}, {}
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4")
            assert len(ids) == r.length <= length
            by.setdefault(r.doc_id, []).append((r.start, tuple(ids.tolist()), r.doc_tokens))
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.padded))
        want = {}
        for d in docs.collect():
            ids = TOKENIZER.encode(d.text or "", add_special_tokens=False).ids + [1]
            want.setdefault(d.doc_id, []).extend((a, tuple(ids[a : a + length]), len(ids)) for a in range(0, len(ids), length))
        assert {i: sorted(p) for i, p in by.items()} == {i: sorted(p) for i, p in want.items()}
        for pieces in sequences.values():
            end = 0
            for offset, n, padded in sorted(pieces):
                assert offset == end
                end += n
            assert end <= length and padded == (end if end & (end - 1) == 0 else length)


def test_null_ids_and_empty_table(spark, odd, empty):
    rows = packing.pack(odd).collect()
    assert sum(r.doc_id is None for r in rows) == 3
    assert packing.pack(empty).collect() == []


def test_words_that_a_polynomial_confuses(spark):
    coder = packing.Ids(None)
    for text in alike():
        assert coder.of(pa.array([text]))[0].tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 1]
