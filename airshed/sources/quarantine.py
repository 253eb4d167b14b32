"""Reading a folder in which some files may be broken: bad files are named and left out.

Spark can pass over what it cannot read, but then says nothing of it, and the rows in front
of a broken page stay.  Here every file is counted twice, by its footer and by decoding the
declared columns; a file whose counts differ, or that has no readable footer, is bad as a
whole.
"""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from airshed.session import kept
from airshed.sources.manifest import name_below

FOOTER, ROWS = "no readable footer", "rows are not as declared"


def _path() -> Column:
    return F.col("_metadata.file_path")


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except (PySparkException, Py4JError):
        return False
    return True


def file_report(spark: SparkSession, folder: str, schema: T.StructType,
                pattern: str = "*.parquet") -> DataFrame:
    """One row (path, file_name, size_bytes, n_footer, n_read, reason) per file below
    ``folder``; ``reason`` is null for a sound file.

    A file may lack declared columns (they are null) and may have others (they are not
    read).  A file of no rows is sound; one of no
    bytes is not listed by Spark and has no row here.  Counts and decoding are one Spark pass each; the
    driver itself opens only the files of which neither pass gave a row.
    """
    def scan() -> DataFrame:
        return (spark.read.schema(schema).option("recursiveFileLookup", True)
                .option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).parquet(folder))

    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).load(folder).select(_path().alias("path"), F.col("length").alias("size_bytes"))
    )
    footers = scan().groupBy(_path().alias("path")).agg(F.count(F.lit(1)).alias("n_footer"))
    # The hash makes the scan decode every declared column.
    decoded = scan().groupBy(_path().alias("path")).agg(
        F.count(F.lit(1)).alias("n_read"), F.bit_xor(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema])).alias("digest"))
    counted = kept(
        files.join(footers, "path", "left").join(decoded, "path", "left").select(
            "path", "size_bytes", "n_footer", "n_read", "digest"), "files")
    silent = [r["path"] for r in counted.filter("n_footer is null and n_read is null").select("path").collect()]
    broken = spark.createDataFrame([(p,) for p in silent if not _readable(spark, p)], "path string")
    reason = (
        F.when(F.col("bad").isNotNull(), FOOTER)
        .when(F.coalesce("n_footer", F.lit(0)) != F.coalesce("n_read", F.lit(0)), ROWS)
    )
    return counted.join(broken.withColumn("bad", F.lit(True)), "path", "left").select(
        "path", name_below(folder, F.col("path")).alias("file_name"), "size_bytes",
        F.coalesce("n_footer", F.lit(0)).alias("n_footer"), F.coalesce("n_read", F.lit(0)).alias("n_read"),
        reason.alias("reason"))


def sound_rows(spark: SparkSession, folder: str, schema: T.StructType, report: DataFrame,
               pattern: str = "*.parquet") -> DataFrame:
    """The rows of the files that ``report`` (of ``file_report``) found sound, and of no other;
    what landed after the report waits for the next one."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if not report.filter("reason is not null").isEmpty():
        reader = reader.option("ignoreCorruptFiles", True)
    sound = report.filter("reason is null").select(F.col("path").alias("_path"))
    return reader.parquet(folder).withColumn("_path", _path()).join(sound, "_path", "left_semi").drop("_path")
