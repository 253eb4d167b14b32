"""Raw reading files: one dataset per pollutant and verification level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# Level in `<pollutant>_<level>.parquet`, a single file or a folder of part files.
LEVEL_IN_PATH = r"_([^_/]+)\.parquet(?:/|$)"
NAME_IN_PATH = r"([^/=]+\.parquet)(?:/|$)"


def with_level(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "verification_level", F.regexp_extract("_metadata.file_path", LEVEL_IN_PATH, 1)
    )


def load_readings(spark: SparkSession, folder: str,
                  schema: T.StructType | None = None) -> DataFrame:
    """Every reading below a folder, in one scan; columns missing in some files are null.

    Without a schema the footers of all files are read first to merge theirs; with
    very many files, give one.
    """
    if schema is None:
        reader = spark.read.option("mergeSchema", True)
    else:
        reader = spark.read.schema(schema)
    return with_level(reader.parquet(f"{folder}/*.parquet"))


def load_readings_as_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """For files whose types disagree: each listed file as text, united by column name."""
    def one(path: str) -> DataFrame:
        df = with_level(spark.read.parquet(path))
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, paths))
