from __future__ import annotations

import os
import zlib

import pytest
from corpora import docs_of, empty  # noqa: F401
from pyspark.sql import functions as F

from framegate.llm import langid

FOLDER = "/root/testdata/sf0.01"


def two_languages(spark, n=60):
    english = "the cat and the dog were walking through the old town when it began to rain again {0}"
    german = "die Katze und der Hund gingen durch die alte Stadt als es wieder zu regnen begann {0}"
    rows = [(i, (english if i % 2 else german).format(i), "en" if i % 2 else "de") for i in range(n)]
    odd = [(None, "the cat", "en"), (500, None, "en"), (501, "", "en"), (502, "12 34 --- ²", "en"), (503, "the cat and the dog", None), (503, "the cat and the dog", None)]
    return docs_of(spark, [*rows, *odd, (504, "und der Hund " * 20_000, "de")])


def test_predictions(spark):
    got = langid.identify(two_languages(spark)).collect()
    assert len(got) == 67
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert all(by[i][0].lang_pred == ("en" if i % 2 else "de") for i in range(60))
    assert [by[i][0].lang_pred for i in (500, 501, 502)] == ["und"] * 3
    assert [r.lang_pred for r in by[503]] == ["en", "en"] and by[504][0].lang_pred == "de"


def test_prediction_sees_the_text_only(spark):
    docs = two_languages(spark)
    model = langid.train(docs)
    one = langid.with_language(docs.select("text"), model).select("lang_pred", "score").collect()
    other = langid.with_language(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.lit(1)), model).select("lang_pred", "score").collect()
    assert sorted(one) == sorted(other)


def test_rejected_rows_go(spark, empty):
    docs = two_languages(spark)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {500, 501, 502}
    assert langid.keep_identified(empty).collect() == [] and langid.identify(empty).collect() == []


def test_nothing_or_one_language_learned(spark):
    docs = two_languages(spark)
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    only = langid.identify(docs.withColumn("lang", F.lit("en"))).filter("doc_id < 60").collect()
    assert {(r.lang_pred, r.score) for r in only} == {("en", 1.0)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not there")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_every_language_is_learned(spark):
    """More languages than any table of some hundred, and one whose rows are copies of few ids."""
    texts = lambda k: f"{'qwrtzpsdfg'[k % 10]}{'aeiou'[k % 5]}{k} "
    rows = [(i, texts(i % 300) * 20, f"l{i % 300:03}") for i in range(3_000)] + [(-1 - i % 6, "once again " * 9, "copied") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.train(docs).names) == {r[2] for r in rows}


def test_samples_come_from_all_of_a_text(spark):
    rows = [(i, "a" * 4_000 + "z" * 4_000, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.train(docs).dictionaries[0].decode().split("\n")
    assert len(learned) == langid.SAMPLE_ROWS and all(len(t) == langid.SAMPLE_CHARS for t in learned)
    assert any(set(t) == {"a"} for t in learned) and any(set(t) == {"z"} for t in learned)
