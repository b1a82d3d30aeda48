"""Batch scoring and the validation of payloads and outputs."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framegate.functions.nulls import col, holds, require_columns
from framegate.sources.readers import read_table

ROUND_DIGITS = 6


@dataclass(frozen=True)
class ModelPackage:
    """A fitted pipeline with the numbers serving needs."""

    model: PipelineModel
    features: tuple[str, ...]
    threshold: float
    target: str
    package_id: str = ""

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        manifest = {
            "features": list(self.features), "threshold": self.threshold, "target": self.target, "package_id": self.package_id
        }
        line = spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1)
        line.write.mode("overwrite").text(f"{path}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ModelPackage:
        m = json.loads(spark.read.text(f"{path}/manifest").first()[0])
        return ModelPackage(
            PipelineModel.load(f"{path}/model"), tuple(m["features"]), m["threshold"], m["target"], m["package_id"]
        )


def score_batch(df: DataFrame, package: ModelPackage) -> DataFrame:
    """All input columns plus `prediction_proba`, `prediction` and `threshold_used`."""
    require_columns(df, package.features, "features")
    scored = package.model.transform(df)
    proba = vector_to_array("probability")[1]
    return scored.select(*[col(c) for c in df.columns], proba.alias("prediction_proba")).transform(
        lambda d: decide(d, "prediction_proba", package.threshold)
    )


def decide(df: DataFrame, proba: str, threshold: float) -> DataFrame:
    """Label and threshold for a probability column; the comparison uses the unrounded value."""
    return df.withColumns(
        {"prediction": (col(proba) >= F.lit(float(threshold))).cast("int"), "threshold_used": F.lit(float(threshold))}
    )


def serve_rows(df: DataFrame, proba: str, threshold: float) -> DataFrame:
    """Row response: the probability is rounded only after the decision."""
    decided = decide(df, proba, threshold)
    return decided.withColumn("probability", F.round(col(proba), ROUND_DIGITS)).drop(proba)


def run_batch_scoring(spark: SparkSession, package: ModelPackage, source: str, sink: str) -> DataFrame:
    out = score_batch(read_table(spark, source), package)
    if sink.endswith(".parquet"):
        out.write.mode("overwrite").parquet(sink)
    else:
        out.write.mode("overwrite").csv(sink, header=True)
    return out


# -- payload and output validation ----------------------------------------------------------


def not_finite(v: Column) -> Column:
    return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))


def payload_columns(features: Column, expected: Sequence[str]) -> dict[str, Column]:
    """Missing, unexpected and non-finite entries of a name-to-value map, as counts, flag and message."""
    want = F.array(*[F.lit(e) for e in sorted(set(expected))]).cast("array<string>")
    present = F.coalesce(features, F.create_map().cast("map<string,double>"))
    names = F.map_keys(present)
    missing = F.array_sort(F.array_except(want, names))
    unexpected = F.array_sort(F.array_except(names, want))
    invalid = F.map_keys(F.map_filter(present, lambda _, v: not_finite(v)))
    counts = {
        "missing_count": F.size(missing),
        "unexpected_count": F.size(unexpected),
        "invalid_value_count": F.size(invalid),
    }
    # The texts of payload and prediction errors, which logs and their readers share.
    said = lambda text, a: F.when(F.size(a) > 0, F.concat(F.lit(f"{text}: ["), F.array_join(a, ", "), F.lit("]")))
    message = F.concat_ws(
        " | ",
        said("Missing features", missing),
        said("Unexpected features", unexpected),
        said("Invalid numeric values for", invalid),
    )
    valid = sum(counts.values(), F.lit(0)) == 0
    return {**counts, "payload_valid": valid, "payload_error": F.when(~valid, message)}


def validate_payloads(df: DataFrame, expected: Sequence[str], features: str = "features") -> DataFrame:
    return df.withColumns(payload_columns(col(features), expected))


def prediction_columns(prediction: Column, probability: Column) -> dict[str, Column]:
    """Label in {0, 1}, probability finite and in [0, 1]; the first reason that applies is given."""
    p = probability.cast("double")
    label_ok = holds(prediction.isin(0, 1))
    reason = (
        F.when(~label_ok, F.concat(F.lit("Invalid prediction value: "), F.coalesce(prediction.cast("string"), F.lit("null"))))
        .when(probability.isNull(), F.lit("Probability is not numeric"))
        .when(not_finite(p), F.lit("Probability is not finite"))
        .when((p < 0) | (p > 1), F.concat(F.lit("Probability out of range [0,1]: "), p.cast("string")))
    )
    return {"prediction_valid": reason.isNull(), "prediction_error": reason}


def validate_predictions(df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    return df.withColumns(prediction_columns(col(prediction), col(probability)))


# -- inference events -----------------------------------------------------------------------

FAILED_PREDICTION, FAILED_PROBABILITY = -1, -1.0


def single_events(
    df: DataFrame,
    package_id: str,
    threshold: float,
    *,
    request_id: Column,
    at: Column,
    features: str = "features",
    probability: str = "probability",
    latency_ms: Column | None = None,
) -> DataFrame:
    """One inference event per scored payload; rejected payloads become failed events with -1 marks."""
    ok, p = F.col("payload_valid"), col(probability)
    latency = latency_ms if latency_ms is not None else F.lit(None).cast("double")
    return df.select(
        F.lit("single_inference").alias("event_type"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp_utc"),
        request_id.cast("string").alias("request_id"),
        F.lit(package_id).alias("package_id"),
        F.lit(float(threshold)).alias("threshold_used"),
        col(features).alias("features"),
        F.when(ok, (p >= F.lit(float(threshold))).cast("int")).otherwise(F.lit(FAILED_PREDICTION)).alias("prediction"),
        F.when(ok, F.round(p, ROUND_DIGITS)).otherwise(F.lit(FAILED_PROBABILITY)).alias("probability"),
        F.round(latency, 3).alias("latency_ms"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.col("payload_error").alias("error_message"),
    )
