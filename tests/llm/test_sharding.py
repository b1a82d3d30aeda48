from __future__ import annotations

import zlib

from corpora import docs_of, empty, odd  # noqa: F401
from hypothesis import given
from hypothesis import strategies as st

from framegate.llm import sharding


@given(st.lists(st.tuples(st.booleans(), st.integers(0, 15), st.integers(0, 5)), max_size=60), st.integers(0, 16))
def test_tree_finds_the_tightest(steps, size):
    tree, held = sharding.RoomTree(), set()
    for add, room, k in steps:
        if add and (room, k) not in held:
            tree.add((room, k))
            held.add((room, k))
        elif not add and (room, k) in held:
            tree.remove((room, k))
            held.discard((room, k))
    assert tree.tightest(size) == min((x for x in held if x[0] >= size), default=None)


@given(st.lists(st.integers(1, 50), max_size=50))
def test_best_fit_against_lists(sizes):
    sizes = sorted(sizes, reverse=True)
    room, want = [], []
    for s in sizes:
        fits = [(r, k) for k, r in enumerate(room) if r >= s]
        if fits:
            k = min(fits)[1]
        elif len(room) < 4 and s <= 60:
            room.append(60)
            k = len(room) - 1
        else:
            want = None
            break
        room[k] -= s
        want.append(k)
    assert sharding.best_fit(sizes, 60, 4) == want


def checked(rows, texts, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r.slot)
        assert 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == want


def test_equal_texts_share_a_shard(spark, odd, empty):
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    for shards in (1, 3, 40):
        rows = sharding.shard(odd, shards=shards).collect()
        checked(rows, texts, shards)
        if shards == 3:
            place = {}
            for r in rows:
                place.setdefault((r.text_crc32, r["size"]), set()).add(r["shard"])
            assert all(len(s) == 1 for s in place.values())
    assert sharding.shard(empty).collect() == []


def test_sizes_are_near_equal_with_a_hot_text(spark):
    texts = [(i, "hot " * 40 if i % 3 == 0 else f"text {i} " * (1 + i % 17)) for i in range(3000)]
    rows = sharding.shard(docs_of(spark, texts), shards=8).collect()
    checked(rows, texts, 8)
    size = [0] * 8
    for r in rows:
        size[r["shard"]] += r["size"]
    assert max(size) - min(size) <= 0.02 * sum(size) / 8
