"""Events that appear once, and fingerprints that grow by files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from framegate.sources import event_store, fingerprints, writers

EVENTS = "request_id string, status string, batch_ string, latency_ms double"


def events(spark, *rows):
    return spark.createDataFrame([(i, s, "own", 1.5) for i, s in rows], EVENTS)


def ids(spark, root, log="events"):
    return sorted(r["request_id"] for r in event_store.read_published(spark, root, log).collect())


def test_a_batch_appears_once(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = events(spark, ("1", "success"), ("2", "failed"))
    assert event_store.publish_events(batch, root, "007")
    assert not event_store.publish_events(batch, root, "007")
    assert event_store.publish_events(events(spark, ("3", "success")), root, "7")
    assert ids(spark, root) == ["1", "2", "3"] and ids(spark, root, "failures") == ["2"]


def test_a_lost_attempt_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = events(spark, ("1", "failed"), ("2", "success"))
    event_store.write_attempt(batch, root, "a/b=c d", "lost")
    assert ids(spark, root) == []
    event_store.publish_events(batch, root, "a/b=c d")
    assert ids(spark, root) == ["1", "2"] and ids(spark, root, "failures") == ["1"]


def test_attempts_that_raced_count_once(spark, tmp_path):
    root = str(tmp_path / "store")
    batch = events(spark, ("1", "failed"))
    for k, attempt in enumerate(("x", "y")):
        event_store.write_attempt(batch, root, "b", attempt)
        spark.createDataFrame([("b", attempt, 5 - k)], "batch_ string, attempt_ string, at_ long").write.mode("append").json(f"{root}/published")
    assert ids(spark, root) == ["1"] and ids(spark, root, "failures") == ["1"]


def test_empty_batches_and_unknown_logs(spark, tmp_path):
    root = str(tmp_path / "store")
    assert event_store.publish_events(events(spark, ("1", "success")).limit(0), root, "none")
    assert not event_store.publish_events(events(spark), root, "none")
    assert ids(spark, root) == [] and ids(spark, root, "failures") == []
    with pytest.raises(ValueError):
        event_store.read_published(spark, root, "other")


def prints(df):
    return sorted(tuple(r[c] for c in ("column", "type", "rows", "non_null", "hash_sum")) for r in df.collect())


def test_only_new_files_are_read(spark, tmp_path):
    path, state = str(tmp_path / "t 1%"), str(tmp_path / "state")
    rows = lambda a, b: spark.range(a, b, numPartitions=2).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("a b"), F.create_map(F.lit("k"), F.col("id")).alias("m")
    )
    rows(0, 40).write.parquet(path)
    assert prints(fingerprints.table_fingerprint(spark, path, state)) == prints(writers.fingerprint(rows(0, 40)))
    seen = spark.read.parquet(state).select("file_path").distinct().count()
    rows(40, 70).write.mode("append").parquet(path)
    assert prints(fingerprints.table_fingerprint(spark, path, state)) == prints(writers.fingerprint(rows(0, 70)))
    assert spark.read.parquet(state).count() == 3 * (seen + 2)
    fingerprints.table_fingerprint(spark, path, state)
    assert spark.read.parquet(state).count() == 3 * (seen + 2)


def test_removed_files_and_new_columns(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    for k in range(2):
        spark.range(k * 10, k * 10 + 10, numPartitions=1).write.mode("append").parquet(path)
        fingerprints.table_fingerprint(spark, path, state)
    spark.range(5).write.mode("overwrite").parquet(path)
    assert prints(fingerprints.table_fingerprint(spark, path, state)) == prints(writers.fingerprint(spark.range(5)))
    spark.range(5).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(path)
    assert len(prints(fingerprints.table_fingerprint(spark, path, state))) == 2
    spark.range(0).write.mode("overwrite").parquet(path)
    assert [r[2:4] for r in prints(fingerprints.table_fingerprint(spark, path, state))] == [(0, 0)]
    assert os.path.isdir(state)
