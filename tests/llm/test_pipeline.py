"""The stages on a small corpus with planted cases, each against a plain account of what it should keep."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from framegate.llm import packing, queries, secrets, simhash

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(2)
    vocabulary = {
        "en": "the of and to in that was with for this from have not by are which one had they were".split(),
        "de": "der die und das nicht ein ist mit auf für sich dem auch als nach wird bei einer aus noch".split(),
    }
    syllables = {"en": "th er on an re he in ed nd ha at en es of or nt".split(), "de": "en er ch ei te in de ge un ie sch ng st be".split()}

    def text(lang, n):
        word = lambda: rng.choice(vocabulary[lang]) if rng.random() < 0.4 else "".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(2, 5)))
        return " ".join(word() for _ in range(n))

    rows = [(i, text(lang, 120), lang) for i, lang in enumerate(["en", "de"] * 60)]
    passage = text("en", 30)
    own = simhash.fingerprint(rows[4][1].encode())
    copies = (f"{rows[4][1]} word{k}" for k in range(1000))
    near = next(t for t in copies if (simhash.fingerprint(t.encode()) ^ own).bit_count() <= simhash.MOST_BITS)
    rows += [(1000, rows[3][1], "de"), (1001, rows[3][1], "de"), (1002, near, "en")]
    rows += [(1003, f"{rows[6][1]} {passage.upper()} {text('en', 40)}", "en")]
    rows += [(1004, f"{text('en', 50)} password = hunter2hunter2 {text('en', 50)}", "en")]
    rows += [(1005, "1234 5678", "en"), (1006, None, None), (1007, "", "de"), (None, text("de", 90), "de"), (None, text("de", 90), None)]
    folder = tmp_path_factory.mktemp("corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long, _matches int"
    spark.createDataFrame([(i, t, lang, "s", len(t) if t is not None else None, 1) for i, t, lang in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, "never seen anywhere at all in any text of this corpus")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    start, ids = docs.columns, lambda df: sorted(r.doc_id for r in df.select("doc_id").collect() if r.doc_id is not None)
    before = ids(docs)
    gone = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus)
        assert out.columns == start, name
        gone.append(sorted(set(before) - set(ids(out))))
        out.write.parquet(f"{corpus}/{name}")
        docs, before = spark.read.parquet(f"{corpus}/{name}"), ids(out)
        assert docs.filter("doc_id is null").count() == 2
    assert gone == [[1005, 1006, 1007], [1000, 1001, 1002], [1003], []]
    secret = docs.filter("doc_id = 1004").first()
    assert secrets.PLACEHOLDER in secret.text and "hunter2" not in secret.text and secret.n_chars == len(secret.text)
    assert docs.filter(f"contains(text, '{secrets.PLACEHOLDER}')").count() == 1

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    coder = packing.Ids(None)
    import pyarrow as pa

    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(coder.of(pa.array([r.text]))[0].tolist())
    got = {}
    for r in packed:
        assert r.start == 0 and r.doc_tokens == r.length
        got.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4").tolist())
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}


def test_run_is_the_stages(spark, corpus):
    got = corpus_pipeline.run(spark, corpus)
    assert got.count() == 120 + 1 + 2
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]


def test_empty_corpus(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, corpus)
    assert docs.collect() == [] and corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect() == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not there")
@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_queries(spark, name):
    import __spark_entry__

    out = __spark_entry__.queries()[name](spark, FOLDER)
    assert out.count() > 0
