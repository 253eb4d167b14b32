"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but
the last return the columns of documents.  ``run`` writes each stage's rows to the shared
folder and reads them again, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from airshed.llm import lines, minhash, mixing, packing, toxicity
from airshed.session import scratch_path, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score >= 0.7) go; the rest stay unchanged."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; a document goes only if lines were taken from it and none but
    blank ones are left, that is, if all it says stands in earlier documents."""
    kept = lines.dedup(docs)
    kept = kept.filter((F.col("_removed") == 0) | ~F.coalesce(lines.all_blank(F.col("text")), F.lit(True)))
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.col("_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Rows that share an id are one document; rows without an id stay.
    """
    ship_package(spark)
    gone = minhash.link_documents(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often, and in such parts, as the mix takes of it."""
    return mixing.apply(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids and their places in sequences."""
    ship_package(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Compression lengths, word hashes and token ids are beyond SQL; tests/llm holds every
#: stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
