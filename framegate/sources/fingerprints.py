"""Fingerprints of growing tables: the sums of every file are kept, and only files that are new or changed are read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.functions.hashing import hashable
from framegate.functions.longform import MAX_AGGREGATES, rows_from, text
from framegate.functions.nulls import col

_FILE = ("file_path", "file_size", "file_modification_time")
_KNOWN = "columns_ long, file_path string, file_size long, file_modification_time timestamp, `column` string, rows long, non_null long, hash_sum decimal(38,0)"


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size, file_modification_time) of a folder of Parquet files; no content is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(*[F.col(f"_metadata.{c}").alias(c) for c in _FILE])


def table_fingerprint(spark: SparkSession, path: str, state: str) -> DataFrame:
    """`writers.fingerprint` of the Parquet folder `path`; what is known of its files is kept in the folder `state`.

    A file counts as known by its path, size and time, as long as the table's columns are the same. Removed files no
    longer count. Names of new files pass through the driver, as those of every scan do. An empty table has no files and
    gives counts of 0 and null sums.
    """
    schema = spark.read.parquet(path).schema
    columns = spark.range(1).select(F.xxhash64(F.lit(schema.json()))).first()[0]
    files = table_files(spark, path)
    mine = _known(spark, state).filter(F.col("columns_") == columns)
    new = [r["file_path"] for r in files.join(mine.select(*_FILE).distinct(), list(_FILE), "left_anti").collect()]
    if new:
        read = spark.read.schema(schema).option("basePath", path).parquet(*[_readable(f) for f in new])
        _file_sums(read, schema, columns).write.mode("append").parquet(state)
        mine = _known(spark, state).filter(F.col("columns_") == columns)
    # two runs at a time may have added the same file; their rows are equal
    once = mine.join(files, list(_FILE), "left_semi").distinct()
    sums = once.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"), F.sum("hash_sum").cast("string").alias("hash_sum")
    )
    named = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema.fields], "`column` string, type string")
    none = F.lit(0).cast("long")
    # One row per column.
    return named.join(F.broadcast(sums), "column", "left").select(
        "column", "type", F.coalesce("rows", none).alias("rows"), F.coalesce("non_null", none).alias("non_null"), "hash_sum"
    )


def _readable(path: str) -> str:
    """The path of a file as its metadata has it (percent-encoded), as a reader takes it, its special letters escaped."""
    from urllib.parse import unquote

    plain = unquote(path)
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in plain)


def _known(spark: SparkSession, state: str) -> DataFrame:
    try:
        return spark.read.schema(_KNOWN).parquet(state)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _KNOWN)


def _file_sums(read: DataFrame, schema: T.StructType, columns: int) -> DataFrame:
    """A row for each file and column, from one scan of the files (of wide tables, one for some hundred columns)."""
    with_file = read.select("*", F.col("_metadata").alias("file_"))
    step, out = MAX_AGGREGATES // 2, None
    for at in range(0, len(schema.fields), step):
        names = [f.name for f in schema.fields[at : at + step]]
        wide = with_file.groupBy(*[F.col(f"file_.{c}").alias(c) for c in _FILE]).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(col(c)).alias(f"n{k}") for k, c in enumerate(names)],
            *[F.sum(F.xxhash64(hashable(read, c)).cast("decimal(38,0)")).alias(f"h{k}") for k, c in enumerate(names)],
        )
        shared = {"columns_": f"{columns}L", **{c: c for c in _FILE}}
        part = rows_from(wide, [shared | {"column": text(c), "rows": "rows", "non_null": f"n{k}", "hash_sum": f"h{k}"} for k, c in enumerate(names)])
        out = part if out is None else out.unionByName(part)
    return out
