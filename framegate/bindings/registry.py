from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because engines add them up in different orders."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in doubles}) if doubles else df


def joined(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as comma-separated text."""
    return df.withColumns({c: F.array_join(c, ",") for c in columns})


# Columns and rows used by many bindings ------------------------------------------------------

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

GAPS = """gaps AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus,
         l_quantity, l_extendedprice, NULLIF(l_discount, 0.0::DOUBLE) AS l_discount, NULLIF(l_tax, 0.0::DOUBLE) AS l_tax
  FROM lineitem)"""


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with zero discounts and taxes read as missing."""
    li = table(spark, sf_dir, "lineitem")
    return li.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in ("l_discount", "l_tax")})


FLAGGED = """flagged AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem)"""


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of lineitem with a 0/1 label: was the item returned."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*MEASURES, (F.col("l_returnflag") == "R").cast("int").alias("y"))


SCORED = """scored AS (
  SELECT event_id, ts, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, value / (value + 50) AS p,
         CAST(value / (value + 50) >= 0.45::DOUBLE AS INTEGER) AS yhat, CAST(user_id % 5 AS INTEGER) AS fold
  FROM events)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored rows: label, probability, hard prediction and fold."""
    p = F.col("value") / (F.col("value") + 50)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("event_type").isin("purchase", "signup").cast("int").alias("y"),
        p.alias("p"),
        (p >= 0.45).cast("int").alias("yhat"),
        (F.col("user_id") % 5).cast("int").alias("fold"),
    )


INFERENCES = """inferences AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS request_id, ts,
         CASE WHEN event_type = 'view' THEN 'batch_inference' ELSE 'single_inference' END AS event_type,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN event_type = 'error' THEN -1 ELSE CAST(value / (value + 50) >= 0.5::DOUBLE AS INTEGER) END AS prediction,
         CASE WHEN event_type = 'error' THEN -1.0::DOUBLE
              WHEN event_type = 'signup' AND value > 200 THEN 1.2::DOUBLE
              ELSE value / (value + 50) END AS probability,
         value AS latency_ms, CAST(user_id % 7 + 1 AS INTEGER) AS n_rows
  FROM events)"""


def as_inferences(events: DataFrame) -> DataFrame:
    """Any event rows (batch or stream) as inference events; some of them broken on purpose."""
    p, failed = F.col("value") / (F.col("value") + 50), F.col("event_type") == "error"
    k = F.from_json("props", "map<string,double>")
    extra = (
        F.when(F.col("event_type") == "click", F.create_map(F.lit("x"), F.col("value")))
        .when(F.col("event_type") == "purchase", F.create_map(F.lit("m"), F.when(F.col("value") < 20, F.col("value"))))
        .otherwise(F.create_map().cast("map<string,double>"))
    )
    return events.select(
        "event_id",
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "view", "batch_inference").otherwise("single_inference").alias("event_type"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, -1).otherwise((p >= 0.5).cast("int")).alias("prediction"),
        F.when(failed, -1.0)
        .when((F.col("event_type") == "signup") & (F.col("value") > 200), 1.2)
        .otherwise(p)
        .alias("probability"),
        F.col("value").alias("latency_ms"),
        (F.col("user_id") % 7 + 1).cast("int").alias("n_rows"),
        F.map_concat(k, extra).alias("features"),
    )


def inferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_inferences(table(spark, sf_dir, "events"))
