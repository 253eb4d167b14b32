"""Queries of the operators over the documents' tables, and their SQL where SQL can say it."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from airshed.llm import (
    divergence, fingerprints, lines, minhash, mixing, neighbours, packing, pii, quality, ranking, repeats, toxicity,
    vectors)
from airshed.llm.sql import ORACLES
from airshed.session import ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, folder, "labels")))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.classify(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.link_vectors(table(spark, folder, "embeddings"))


def op6_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup(table(spark, folder, "documents"))
    return kept.select(
        "doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents")).drop("spans")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    # A real run takes its key from a secret store.
    docs = pii.pseudonymise(table(spark, folder, "documents"), key="pseudonyms-of-the-registered-query", any_area=True)
    return docs.select("doc_id", F.col("_numbers").alias("n_numbers"), F.col("_dates").alias("n_dates"), "text")


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.link_documents(table(spark, folder, "documents"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_ranking(spark: SparkSession, folder: str) -> DataFrame:
    index = ranking.build(table(spark, folder, "documents"))
    return ranking.search(index, table(spark, folder, "benchmark"))


def op13_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def _shipped(query):
    """The query, with the package sent to the executors first."""
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_fingerprints, op2_quality, op3_toxicity, op4_mixing, op5_vectors, op6_lines, op7_packing, op8_repeats,
    op9_pii, op10_minhash, op11_divergence, op12_ranking, op13_neighbours)}

__all__ = ["ORACLES", "QUERIES"]
