"""Inference events that appear once, however often their batch is written.

A batch is written to both logs under its id and a new attempt; then one line that names the attempt is added to the
published ones. Readers take the files of one published attempt for each batch. An attempt that was lost on the way is
named nowhere, and two that raced hold the same batch, of which readers agree on the first.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from framegate.sources.readers import EVENT_SCHEMA, parse_events

_KEYS = ("batch_", "attempt_")
_PUBLISHED = "batch_ string, attempt_ string, at_ long"
# Folder names start with it, so that they are read back as text whatever an id looks like.
_NAME = "n-"
LOGS = ("events", "failures")


def write_attempt(events: DataFrame, root: str, batch_id: str, attempt: str) -> None:
    """The events as JSON lines and, apart, those that failed: the same lines, so the events are evaluated once."""
    spark = events.sparkSession
    place = {"batch_": F.lit(_name(batch_id)), "attempt_": F.lit(_name(attempt))}
    # as text beside its keys, so columns of the events may have any names
    lines = events.select(F.to_json(F.struct("*")).alias("value"))
    lines.withColumns(place).write.mode("append").partitionBy(*_KEYS).text(f"{root}/events")
    mine = _lines(spark, root, "events").filter((F.col("batch_") == _name(batch_id)) & (F.col("attempt_") == _name(attempt)))
    failed = mine.filter(F.get_json_object("value", "$.status") == "failed")
    failed.write.mode("append").partitionBy(*_KEYS).text(f"{root}/failures")


def publish_events(events: DataFrame, root: str, batch_id: str) -> bool:
    """Adds a batch to both logs unless it is there; tells whether it was added. An empty batch is published as well.

    The id must name the same rows whenever it is used. Files of lost attempts stay; no reader sees them.
    """
    spark = events.sparkSession
    if not published(spark, root).filter(F.col("batch_") == batch_id).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    write_attempt(events, root, batch_id, attempt)
    line = spark.createDataFrame([(batch_id, attempt, time.time_ns())], _PUBLISHED).coalesce(1)
    line.write.mode("append").json(f"{root}/published")
    return True


def published(spark: SparkSession, root: str) -> DataFrame:
    """(batch_, attempt_) of every batch that is there; of attempts that raced, the first."""
    try:
        lines = spark.read.schema(_PUBLISHED).json(f"{root}/published")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        lines = spark.createDataFrame([], _PUBLISHED)
    return lines.groupBy("batch_").agg(F.min_by("attempt_", F.struct("at_", "attempt_")).alias("attempt_"))


def read_published(spark: SparkSession, root: str, log: str = "events", schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The published events of a log, or its failures; lines that do not parse are skipped.

    Batches are folders, so the join with the published ones decides which folders are read.
    """
    if log not in LOGS:
        raise ValueError(f"Unknown log: {log}")
    there = published(spark, root).select(*[F.concat(F.lit(_NAME), k).alias(k) for k in _KEYS])
    return parse_events(_lines(spark, root, log).join(there, list(_KEYS), "left_semi").select("value"), schema)


def _name(key: str) -> str:
    return _NAME + key


def _lines(spark: SparkSession, root: str, log: str) -> DataFrame:
    """(value, batch_, attempt_); a log in which no batch had a line has no folders yet, and no rows."""
    lines = spark.read.text(f"{root}/{log}")
    return lines if set(_KEYS) <= set(lines.columns) else lines.withColumns({k: F.lit(None).cast("string") for k in _KEYS})
