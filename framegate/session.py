"""Session settings shared by the tests, the bench and the job entry points."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "framegate", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Where the setting is empty, a folder beside the warehouse tables, which all executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: survives lost executors, unlike cached or local blocks."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=eager)


def saved(df: DataFrame, folder: str) -> DataFrame:
    """The rows written under a new name in `folder` and read again; they go when the folder goes."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder that all executors share, removed with everything in it at the end."""
    folder = f"{shared_dir(spark)}/framegate/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
