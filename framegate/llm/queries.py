"""The operators bound to the driver tables: one query per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framegate.llm import decontamination, divergence, html, jaccard, langid, lm, manifest, oracles, packing, repeats, search, secrets, sharding, simhash

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


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_search", oracles.SEARCH)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth document as a query over all documents."""
    docs = table(spark, sf_dir, "documents")
    queries = docs.filter(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search.search(docs, queries).withColumn("score", F.round("score", 6))


@query("op3_lm_scores")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good against all others."""
    wanted = table(spark, sf_dir, "labels").filter("quality = 1")
    return lm.cross_entropy_difference(table(spark, sf_dir, "documents"), wanted)


@query("op4_repeats", oracles.REPEATS)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_decontamination", oracles.DECONTAMINATION)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op7_main_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("*", F.length("text").cast("long").alias("n_chars"))


@query("op8_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law is `bytes`: near equal sizes."""
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_secrets")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [F.size(secrets.of_kind("spans", k)).cast("long").alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded")


@query("op11_divergence", oracles.DIVERGENCE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op12_jaccard", oracles.JACCARD)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"))


@query("op13_manifest", oracles.MANIFEST)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row by the checksum of its id is tampered with."""
    docs = table(spark, sf_dir, "documents")
    return manifest.verified(manifest.manifest(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 3 == 0))
