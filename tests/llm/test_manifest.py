from __future__ import annotations

from hashlib import sha256

import pytest
from corpora import SCHEMA, docs_of, empty, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from framegate.llm import manifest


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    each = (None if v is None else str(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text))
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in each))


def tree(leaves, arity=8):
    """(root, for each leaf its siblings before and after, level by level)."""
    paths, nodes, own = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
        for run in runs:
            for k in run:
                for i in own[k]:
                    paths[i].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
        nodes, own = [H(*(nodes[j] for j in run)) for run in runs], [[i for j in run for i in own[j]] for run in runs]
    return nodes[0], paths


def brute(rows, hurt, arity=8):
    """Rows (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    made = []
    for lang in langs:
        group = sorted(by_lang[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        made.append((group, *tree([leaf(r, r.text) for r in group], arity)))
    root, upper = tree([m[1] for m in made], arity)
    out = []
    for (group, sub, paths), top in zip(made, upper):
        for r, path in zip(group, paths):
            low = r.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
            own = leaf(r, low if hurt(r) else r.text)
            for a, b in path + top:
                own = H(a, own, b)
            out.append((r.doc_id, leaf(r, r.text), sub, root, H(*(a + b for a, b in path + top)), own, own == root))
    return sorted(out, key=str)


ODD = [(i, t, ["en", "de", None, "", "É", "-"][i % 6 if i else 0] if i is not None else "en") for i, t in odd_rows(n=90)]


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_trees_and_proofs(spark, arity):
    docs = docs_of(spark, [*ODD, (3000, "ALONE", "zz"), (3001, "Ünder A", "é"), (3001, "Ünder A", "é")])
    hurt = F.col("doc_id") % 2 == 0
    got = manifest.verified(manifest.manifest(docs, tampered=hurt, arity=arity)).collect()
    want = brute(docs.collect(), lambda r: r.doc_id is not None and r.doc_id % 2 == 0, arity)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert {r[-1] for r in want} == {True, False}


def test_one_language_and_one_row(spark):
    docs = docs_of(spark, [(7, "Abc", "en")])
    r = manifest.verified(manifest.manifest(docs)).first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == H()
    docs = docs_of(spark, [(i, "x", "en") for i in range(9)])
    got = manifest.verified(manifest.manifest(docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs.collect(), lambda r: False)


def test_ranges_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(manifest, "RANGE_ROWS", 10)
    docs = docs_of(spark, [*ODD, *[(None, "copy", "en")] * 60])
    got = manifest.verified(manifest.manifest(docs)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs.collect(), lambda r: False)


def test_empty(spark, empty):
    assert manifest.manifest(empty).collect() == []
