"""CSV, Parquet and JSON-lines scans with their presence contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framegate.functions.nulls import nan_to_null, require_columns


class SourceError(ValueError):
    """The source breaks its contract: empty, or without a required column."""


# Inference log lines; single and batch events share one schema.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp_utc", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("package_id", T.StringType()),
        T.StructField("threshold_used", T.DoubleType()),
        T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("n_rows", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def read_csv_contract(
    spark: SparkSession, path: str, required: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """CSV with header; raises for an absent path, an empty file, no rows or missing columns.

    The header is read first, so a schema given by name can be laid over the columns in file
    order; columns outside the schema stay strings. Without a schema types are inferred,
    which costs a second pass over the file.
    """
    try:
        names = spark.read.csv(path, header=True).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"Source not found: {path}") from e
        raise
    if not names:
        raise SourceError("Source is empty")
    missing = [n for n in required if n not in names]
    if missing:
        raise SourceError(f"Missing required columns: {missing}")
    if schema is None:
        df = spark.read.csv(path, header=True, inferSchema=True)
    else:
        types = {f.name: f.dataType for f in schema.fields}
        laid = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        df = spark.read.csv(path, header=True, schema=laid)
    if df.isEmpty():
        raise SourceError("Source is empty")
    return nan_to_null(df)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, strict: bool = False) -> DataFrame:
    """Parquet or CSV by suffix; with `strict` any other suffix is an error, else it is read as CSV."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "parquet":
        return nan_to_null(spark.read.parquet(path))
    if strict and suffix != "csv":
        raise SourceError(f"Unsupported table format: {path}")
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("inferSchema", True)
    return nan_to_null(reader.csv(path, header=True))


def read_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON-lines event log; lines that do not parse are skipped, timestamps become `ts`."""
    return parse_events(spark.read.text(path), schema)


def parse_events(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Batch or streaming text lines (column `value`) to event rows.

    Parsing by expression rather than by the JSON source lets a query select any subset of
    columns, also none, and still skip the same lines.
    """
    corrupt = "_corrupt_record"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = lines.select(F.from_json("value", full, options).alias("e")).filter(
        F.col("e").isNotNull() & F.col(f"e.{corrupt}").isNull()
    )
    return with_event_time(parsed.select(*[F.col(f"e.{f.name}").alias(f.name) for f in schema.fields]))


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.try_to_timestamp(F.col("timestamp_utc")))


def project(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exactly the listed columns in their order; a missing one raises."""
    require_columns(df, features, "features")
    return df.select(*[F.col("`" + f.replace("`", "``") + "`") for f in features])


def drop_unlabelled(df: DataFrame, target: str) -> DataFrame:
    require_columns(df, [target], "target")
    return df.dropna(subset=[target])


def feature_set(
    mode: str, base: Sequence[str], engineered: Sequence[str], explicit: Sequence[str] = ()
) -> list[str]:
    """Input columns for training: `all`, `base`, `engineered` or `explicit`."""
    modes = {
        "all": [*base, *engineered],
        "base": list(base),
        "engineered": list(engineered),
        "explicit": list(explicit),
    }
    if mode not in modes:
        raise ValueError(f"Unknown feature set: {mode}")
    if not modes[mode]:
        raise ValueError("No feature columns selected")
    return modes[mode]
